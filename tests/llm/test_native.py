"""Fingerprints, placement and WARC records: exact definitions, round trips and plans."""

import collections
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from panelcast.llm import fingerprints, sharding, warc
from panelcast.llm.queries import QUERIES, SQL
from tests.oracle import connect, differences

PYTHON = ("Python", "Pandas", "Arrow")


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_rows_match_sql(name, spark, sf_dir, con):
    assert differences(QUERIES[name](spark, sf_dir), con, SQL[name]) == []


@pytest.mark.parametrize("name", ["op2_warc_derivatives", "op4_closed_syncmers", "op9_hash_tree"])
def test_no_python_in_native_plans(name, spark, sf_dir):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in (*PYTHON, "CartesianProduct", "BroadcastNestedLoopJoin") if f"{x}" in plan.replace("PythonUDF", "")]


# --- fingerprints ------------------------------------------------------------------------


def word_hashes(spark, words):
    rows = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i long, w string").select("i", F.xxhash64("w").alias("h"))
    return [r["h"] for r in sorted(rows.collect(), key=lambda r: r["i"])]


def anchors_by_hand(spark, text):
    k, s = fingerprints.K, fingerprints.S
    h = word_hashes(spark, text.lower().split())
    pairs = spark.createDataFrame([(i, *h[i : i + s]) for i in range(len(h) - s + 1)], "i long, " + ", ".join(f"c{j} long" for j in range(s)))
    g = [r["g"] for r in sorted(pairs.select("i", F.xxhash64(*(f"c{j}" for j in range(s))).alias("g")).collect(), key=lambda r: r["i"])]
    out = []
    for i in range(len(h) - k + 1):
        inner = g[i : i + k - s + 1]
        if min(inner) in (inner[0], inner[-1]):
            out.append(i)
    return out


def test_anchors_are_closed_syncmers(spark):
    text = " ".join(f"Word{(i * i) % 37}" for i in range(120)) + "\n end"
    got = fingerprints.fingerprints(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()[0]
    assert [int(x.split(":")[0], 16) for x in got["fingerprint"].split()] == anchors_by_hand(spark, text)


def test_anchors_do_not_depend_on_context(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(1, passage), (2, "a b c " + passage), (3, passage + " x y z"), (4, "one two"), (5, "One  two\n"), (6, "")]
    found = {r["doc_id"]: set(r["anchors"]) for r in fingerprints.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[1] <= found[2] and found[1] <= found[3] and len(found[1]) > 15
    assert found[4] == found[5] and len(found[4]) == 1 and found[6] == set()


def test_only_texts_without_words_have_no_anchor(spark):
    rows = [(i, " ".join(f"v{i}x{j}" for j in range(n))) for i, n in enumerate([1, 4, 5, 6, 7] * 40)] + [(-1, ""), (-2, None), (-3, " \t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprints(docs).collect()}
    assert all((found[i] == "") == (i < 0) for i in found)
    for i in (2, 3, 7, 8, 12, 13):
        hand = anchors_by_hand(spark, dict(rows)[i])
        assert [int(x.split(":")[0], 16) for x in found[i].split()] == (hand or [0])
    apart = [r for r in fingerprints.against_edits(docs).collect() if r["doc_id"] >= 0]
    assert all(r["near_next"] == 0 for r in apart)  # no two of these texts share a word
    assert all(r["near_edited"] == 0 for r in apart if r["doc_id"] % 5 == 2)  # an edit changes the only run of five words


def test_edited_texts(spark):
    texts = {3: "é" * 9, 7: "next text here", 12: "", 40: "the last of them all", 41: None}
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r for r in fingerprints.against_edits(rows).collect()}
    ids = sorted(texts)
    for i, following in zip(ids, [*ids[1:], ids[0]], strict=True):
        text, other = texts[i] or "", texts[following] or ""
        n = len(text) // 4
        edited = text[: len(text) - n] + other[:n]
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i]["next_id"] == following and got[i]["n_chars"] == len(text)
        assert 0 <= got[i]["near_edited"] <= 1 and 0 <= got[i]["near_next"] <= 1


def test_edits_stay_nearer_than_neighbours(spark, sf_dir):
    rows = QUERIES["op4_closed_syncmers"](spark, sf_dir).collect()
    long = [r for r in rows if r["n_chars"] > 400]
    assert sum(r["near_edited"] for r in long) / len(long) > 0.55
    assert sum(r["near_edited"] > r["near_next"] for r in long) > 0.98 * len(long)


def test_positional_matches(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    a = spark.createDataFrame([(1, passage)], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b c " + passage)], "doc_id long, text string")
    best = fingerprints.positional_matches(a, b).orderBy(F.desc("n")).first()
    assert best["shift"] == 3 and best["n"] > 15


# --- placement ---------------------------------------------------------------------------


def test_growth_moves_rows_only_to_the_new_shard(spark):
    leaves = sharding.tree(24)
    keys = spark.range(40_000).select(F.col("id").cast("string").alias("k"))
    bigger = sharding.grown(leaves)
    rows = keys.select(
        sharding.shard_of(leaves, F.col("k")).alias("a"),
        sharding.shard_of(bigger, F.col("k")).alias("b"),
        sharding.shard_of(sharding.grown(bigger), F.col("k")).alias("c"),
    ).collect()
    assert all(r["b"] in (r["a"], 24) and r["c"] in (r["b"], 25) for r in rows)
    moved = sum(r["b"] == 24 for r in rows)
    assert abs(moved - 40_000 / 25) < 250
    counts = collections.Counter(r["a"] for r in rows)
    assert len(counts) == 24 and max(counts.values()) < 1.15 * 40_000 / 24


def test_changed_weight_moves_rows_of_its_subtree_only(spark):
    leaves = [sharding.Leaf(0, "r0", "k0"), sharding.Leaf(1, "r0", "k0"), sharding.Leaf(2, "r0", "k1", 2.0), sharding.Leaf(3, "r1", "k2", 3.0)]
    heavier = [*leaves[:3], sharding.Leaf(3, "r1", "k2", 5.0)]
    keys = spark.range(20_000).select(F.col("id").cast("string").alias("k"))
    rows = keys.select(sharding.shard_of(leaves, F.col("k")).alias("a"), sharding.shard_of(heavier, F.col("k")).alias("b")).collect()
    assert all(r["b"] in (r["a"], 3) for r in rows)
    counts = collections.Counter(r["a"] for r in rows)
    assert counts[2] == pytest.approx(2 * counts[0], rel=0.1) and counts[3] == pytest.approx(3 * counts[0], rel=0.1)


def test_slots_are_gapless(spark):
    rows = [(i % 700, f"text {i % 700}") for i in range(3000)] + [(None, None)] * 3
    found = sharding.place(spark.createDataFrame(rows, "doc_id long, text string"), sharding.tree(5)).collect()
    slots = collections.defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
        text = "" if r["doc_id"] is None else f"text {r['doc_id']}"
        assert r["size"] == len(text) + 8 and r["text_crc32"] == zlib.crc32(text.encode())
    assert len(found) == len(rows) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert len({(r["doc_id"], r["shard"]) for r in found}) == 701


# --- WARC --------------------------------------------------------------------------------


def test_warc_files_round_trip(spark, sf_dir, tmp_path):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").limit(40)
    found = warc.responses(pages)
    warc.write_warc(warc.response_text(found), f"{tmp_path}/responses")
    read = warc.read_warc(spark, f"{tmp_path}/responses")
    columns = ["record_type", "record_id", "target_uri", "warc_date", "content_type", "http_headers", "payload", "payload_digest"]
    assert sorted(map(tuple, read.select(columns).collect())) == sorted(map(tuple, found.select(columns).collect()))
    made = warc.derivatives(found)
    warc.write_warc(warc.derivative_text(made), f"{tmp_path}/derivatives")
    columns = ["record_type", "record_id", "refers_to", "target_uri", "content_type", "block"]
    read = warc.read_warc(spark, f"{tmp_path}/derivatives")
    assert sorted(map(tuple, read.select(columns).collect())) == sorted(map(tuple, made.select(columns).collect()))
    again = warc.derivatives(warc.read_warc(spark, f"{tmp_path}/responses").withColumn("page_id", F.lit(None).cast("long")))
    assert {r["record_id"] for r in again.collect()} == {r["record_id"] for r in made.collect()}


def test_records_are_linked(spark):
    html = "<title>A &amp; B</title><p>One <b>two</b></p><script>x</script><!-- no --><a href='/r'>r</a><a href=\"s?t\">s</a><img src='//h/i'>"
    pages = spark.createDataFrame([(1, "http://x.example/d/p?q#f", html)], "page_id long, url string, html string")
    response = warc.responses(pages).first()
    rows = {r["record_type"]: r for r in warc.derivatives(warc.responses(pages)).collect()}
    meta, text = rows["metadata"], rows["conversion"]
    assert meta["refers_to"] == text["refers_to"] == response["record_id"]
    assert meta["concurrent_to"] == text["record_id"] and text["concurrent_to"] == meta["record_id"]
    assert meta["source_digest"] == "sha256:" + hashlib.sha256(html.encode()).hexdigest()
    assert text["block"] == "A & B\nOne two\nr\ns".replace("\nr\ns", "\nrs")
    lines = meta["block"].split("\r\n")
    assert f"source-header: Content-Length: {len(html)}" in lines and "title: A & B" in lines
    assert [x for x in lines if x.startswith("outlink")] == [
        "outlink: http://x.example/r", "outlink: http://x.example/d/s?t", "outlink: http://h/i"
    ]
    assert text["block_digest"] == "sha256:" + hashlib.sha256(text["block"].encode()).hexdigest()
