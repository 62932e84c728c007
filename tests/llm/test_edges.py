"""Nulls, empty and repeated rows, ties, very long texts, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from panelcast.llm import decontam, fingerprints, jaccard, langid, packing, pii, quality, sharding, token_counts, warc
from panelcast.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "ab cd " * 40_000
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog again and again", "en", "a", 59),
    (1, "the quick brown fox jumps over the lazy dog again and again", "en", "a", 59),
    (1, "another text under the same id, much like no other text here", "en", None, 60),
    (None, "the quick brown fox jumps over the lazy dog again and again", None, "a", 59),
    (None, None, None, None, None),
    (2, None, "en", "b", 0),
    (3, "", "de", "b", 0),
    (4, " \t\n ", None, "b", 4),
    (5, "1234 5678", "en", "b", 9),
    (6, "x", "de", "b", 1),
    (7, LONG, "de", "c", len(LONG)),
    (8, "é" * 5000, "fr", "c", 5000),
    (9, "der die das und ein \U0001f600 zu <|endoftext|>", "de", "c", 30),
    (10, "mail a@b.co or +1 (234) 555-1234", "en", "c", 32),
]
# Names that the operators use inside.
CLASHING = ["id", "label", "entry", "key", "h", "copies", "n", "digest", "shard", "slot", "bucket", "edits", "chars", "node", "a", "b"]


def wide(df):
    return df.select("*", *(F.lit("clash").alias(c) for c in CLASHING))


@pytest.fixture(scope="module")
def field():
    return pii.fit_rows(pii.examples(80))


@pytest.fixture(scope="module")
def operators(spark, field):
    benchmark = spark.createDataFrame([(1, "ab cd ab cd ab"), (None, "x"), (2, None), (3, "")], "item_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (9, 1, 0), (7, 0, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    return {
        "jaccard": lambda d: jaccard.similar_groups(d, jaccard.Rule()),
        "fingerprints": fingerprints.against_edits,
        "personal data": lambda d: pii.detect(d, field),
        "decontamination": lambda d: decontam.report(decontam.contamination(d, benchmark, window=5)),
        "quality": lambda d: quality.classify(d, labels),
        "sharding": lambda d: sharding.place(d, sharding.tree(24)),
        "language": langid.learn_and_identify,
        "token counts": token_counts.count_through_edits,
    }


NAMES = ["jaccard", "fingerprints", "personal data", "decontamination", "quality", "sharding", "language", "token counts"]


@pytest.mark.parametrize("name", NAMES)
def test_one_row_per_row(name, spark, operators):
    docs = spark.createDataFrame(ROWS, DOCS)
    plain = sorted(map(str, operators[name](docs).collect()))
    assert len(plain) == len(ROWS)
    assert sorted(map(str, operators[name](wide(docs)).collect())) == plain


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(name, spark, operators):
    assert operators[name](spark.createDataFrame([], DOCS)).collect() == []


def test_packing_of_odd_rows(spark):
    docs = spark.createDataFrame(ROWS, DOCS)
    rows = packing.pack_documents(wide(docs)).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] == 2) == 1
    assert sum(r["length"] for r in rows) == sum(len(packing.encoding().encode_ordinary(t or "")) + 1 for _, t, *_ in ROWS)
    assert packing.pack_documents(spark.createDataFrame([], DOCS)).collect() == []


def test_pages(spark):
    rows = [(1, None, None), (None, "http://a.example/x", "<p>t</p>"), (2, "no address", "<a href='y'>z</a>"), (2, "no address", "")]
    schema = "page_id long, url string, html string"
    pages = spark.createDataFrame(rows, schema)
    found = warc.derivatives(warc.responses(wide(pages))).collect()
    assert len(found) == 2 * len(rows)
    assert all(r["block"] is not None and r["refers_to"] for r in found)
    assert warc.derivatives(warc.responses(spark.createDataFrame([], schema))).collect() == []


def test_defined_results(spark, operators):
    docs = spark.createDataFrame(ROWS, DOCS)
    groups = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in operators["jaccard"](docs).collect()}
    assert groups[2, 0] == 2 and groups[3, 0] == 3 and groups[None, 0] is None
    langs = {r["doc_id"]: r for r in operators["language"](docs).collect()}
    assert all(langs[i]["lang_pred"] == "und" and langs[i]["score"] == 0 for i in (2, 3, 4, 5))
    kept = {r["doc_id"]: r for r in operators["quality"](docs).collect()}
    assert kept[2]["perplexity"] is None and not kept[2]["keep"]


@pytest.mark.parametrize("rows", [[], ROWS])
def test_stages(spark, rows, sf_dir):
    docs = wide(spark.createDataFrame(rows, DOCS))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        if name != "packing":
            assert out.columns == corpus_pipeline.COLUMNS
        docs = spark.createDataFrame(out.collect(), out.schema)
    assert (docs.count() > 0) == bool(rows)


def test_queries_are_named():
    names = [n.split("_")[0] for n in QUERIES]
    assert names == [f"op{i}" for i in range(1, 14)]
