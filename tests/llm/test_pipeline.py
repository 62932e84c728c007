"""The pipeline's rows against a plain version of every stage."""

import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from panelcast.llm import packing, pii

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(tmp_path_factory, spark):
    rng = random.Random(11)
    words = {"en": ["the", "of", "thing", "ation", "ingly", "whether"], "de": ["der", "und", "lich", "keit", "schaft", "zu"]}

    def body(lang, n):
        return [rng.choice(words[lang]) + rng.choice(["", "er", "est", "ul", "ka", "mo", "ri"]) for _ in range(n)]

    item = body("en", 30)
    rows, k = [], 0
    for lang in ("en", "de"):
        for _ in range(30):
            text = body(lang, rng.choice([8, 40, 150]))
            rows.append((k, text, lang))
            k += 1
            if rng.random() < 0.4:
                near = list(text)
                near[-1] = "changed"
                rows.append((k, near, lang))
                k += 1
    rows.append((k, body("en", 40) + item[3:25] + body("en", 10), "en"))  # contaminated
    rows.append((k + 1, body("en", 900) + item[3:25], "en"))  # a small share only
    rows.append((k + 2, ["1234", "..."], "en"))  # no letter
    rows.append((k + 3, body("en", 12) + ["joe@mail.example.com", "or", "+1 (234) 555-1234"] + body("en", 5), "en"))
    table = [(i, " ".join(w), lang, "s", len(" ".join(w))) for i, w, lang in rows] + [(k + 4, None, "en", "s", 0)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(table, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, {i: t for i, t, *_ in table}, item


def grams(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def plain(texts, item):
    """Texts by id after the first four stages."""
    kept = {i: t for i, t in texts.items() if t and any(c.isalpha() for c in t)}
    group = {i: i for i in kept}
    for a in sorted(kept):
        for b in sorted(kept):
            x, y = grams(kept[a]), grams(kept[b])
            if a < b and len(x & y) * 100 >= len(x | y) * 80:
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = {k: new if v == old else v for k, v in group.items()}
    kept = {i: t for i, t in kept.items() if group[i] == i}
    windows = {tuple(item[i : i + 13]) for i in range(len(item) - 12)}
    out = {}
    for i, t in kept.items():
        w, hit = t.split(), set()
        for j in range(len(w) - 12):
            if tuple(w[j : j + 13]) in windows:
                hit.update(range(j, j + 13))
        if not hit or 20 * len(hit) < len(w):
            out[i] = t
    field = pii.fit_rows(pii.examples())
    return {i: pii.redacted(t, pii.find([t], field)[0][1]) for i, t in out.items()}


def test_stages_against_plain_version(spark, corpus):
    folder, texts, item = corpus
    want = plain(texts, item)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == corpus_pipeline.COLUMNS, name
    got = {r["doc_id"]: r for r in docs.collect()}
    assert {i: r["text"] for i, r in got.items()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert len(want) < len(texts) - 5 and any("<email>" in t for t in want.values())
    encoder, rows = packing.encoding(), corpus_pipeline.run(spark, folder).collect()
    for i, text in want.items():
        ids = np.array([*encoder.encode_ordinary(text), 1], "<u4")
        pieces = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["start"])
        at = 0
        for r in pieces:
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    assert {r["doc_id"] for r in rows} == set(want)


def test_first_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "personal_data", "packing"]


A = "a text of some ten words that many others will never share with it at all"
B = "something else entirely stands in this second text and no word of it is close"


def kept(spark, rows):
    docs = spark.createDataFrame([(i, t, s, None, 1) for i, t, s in rows], DOCS)
    return sorted((r["doc_id"], r["text"], r["lang"]) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())


def test_no_text_of_an_id_is_lost(spark):
    assert kept(spark, [(5, A, "x"), (5, B, "x"), (1, A, "x")]) == [(1, A, "x"), (5, B, "x")]
    assert kept(spark, [(5, A, "x"), (5, B, "x")]) == sorted([(5, A, "x"), (5, B, "x")])
    found = kept(spark, [(5, A, "x"), (5, B, "x"), (9, A, "x"), (9, B, "x"), (9, B, "x"), (7, "c d e f g h i", "x")])
    assert sorted(t for _, t, _ in found) == sorted([A, B, "c d e f g h i"]) and (7, "c d e f g h i", "x") in found


def test_of_equal_rows_the_least_stays(spark):
    assert kept(spark, [(2, A, "b"), (2, A, "a"), (2, A, "c"), (3, B, "z")]) == [(2, A, "a"), (3, B, "z")]


def test_nodes_keep_plain_ids(spark):
    docs = spark.createDataFrame([(4, A), (4, B), (4, B), (8, A), (8, None)], "doc_id long, text string")
    rows = [tuple(r) for r in corpus_pipeline.nodes(docs).select("doc_id", "text", "node").collect()]
    by_text = {}
    for i, t, n in rows:
        by_text.setdefault((i, t), set()).add(n)
    assert all(len(n) == 1 for n in by_text.values()) and len({min(n) for n in by_text.values()}) == 4
    assert {n for (i, _), ns in by_text.items() for n in ns if n == i} == {4, 8}
