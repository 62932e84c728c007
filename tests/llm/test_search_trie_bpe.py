"""Ranked search, conversation trie and prefix BPE against brute force and the library they must agree with."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelcast.llm import bpe, prefix_trie, ranked_search

# --- prefix BPE ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def coder():
    return bpe.Coder()


@pytest.fixture(scope="module")
def library(coder):
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.words.ranks, special_tokens={})


TEXT = st.text(st.sampled_from("aabt heréß漢 \n\t'sl09.,\U0001f600"), max_size=80) | st.text(max_size=40)


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_ids_are_the_library_s(coder, library, text):
    ids = coder.encode(text)
    assert ids == library.encode_ordinary(text)
    assert coder.words.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["x" * 50_000, "ab" * 30_000, " " * 20_000, "漢字" * 9000, "'" * 999, "0" * 9999, "<|endoftext|>"])
def test_very_long_pieces(coder, library, text):
    assert coder.encode(text) == library.encode_ordinary(text)


def test_code_points(coder, library):
    for start in range(0, 0x30000, 16):
        text = " ".join(f"a{chr(c)}{chr(c)}1" for c in range(start, start + 16) if not 0xD800 <= c < 0xE000)
        assert coder.encode(text) == library.encode_ordinary(text)


def test_each_prefix_has_one_last_token(coder):
    words, data = coder.words, "thereinafter".encode()
    last = words.last_tokens(data)
    for n in range(1, len(data) + 1):
        assert words.merged(data[:n])[-1] == last[n]
        ends = [t for t in range(n) if data[t:n] in words.ranks]
        fits = [t for t in ends if words.merged(data[:t]) + [words.ranks[data[t:n]]] == words.merged(data[:n])]
        assert len(fits) == 1


@settings(max_examples=200, deadline=None)
@given(st.text("abcth", min_size=1, max_size=150), st.integers(0, 150), st.integers(0, 150), st.text("abcth", max_size=12))
def test_replaced_table(coder, text, start, length, insertion):
    old, new = text.encode(), (text[:start] + insertion + text[start + length :]).encode()
    table, _ = coder.words.replaced(old, coder.words.last_tokens(old), new)
    assert table == coder.words.last_tokens(new)


def test_an_edit_works_near_itself(coder):
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefgh") for _ in range(20_000))
    new = text[:10_000] + "zz" + text[10_001:]
    table, worked = coder.words.replaced(text.encode(), coder.words.last_tokens(text.encode()), new.encode())
    assert table == coder.words.last_tokens(new.encode()) and worked < 500
    held = bpe.Stored.of_text(coder, "some words here " * 2000)
    assert held.edit(16_000, 16_004, "other") < 100
    assert held.edit(10**9, 10**9, " and an end") < 100
    assert held.ids() == coder.encode(held.text)


@settings(max_examples=200, deadline=None)
@given(TEXT, st.lists(st.tuples(st.integers(-2, 90), st.integers(-2, 90), TEXT), max_size=4))
def test_stored_edits(coder, text, edits):
    held = bpe.Stored.of_text(coder, text)
    for start, end, insertion in edits:
        start = min(max(start, 0), len(text))
        end = min(max(end, start), len(text))
        text = text[:start] + insertion + text[end:]
        held.edit(start, end, insertion)
        assert held.text == text and held.ids() == coder.encode(text)
        assert held.pieces == bpe.Stored.of_text(coder, text).pieces


def test_vocabulary_with_unordered_merges():
    # "abc" comes before "bc", of which it is made; a token no merge reaches is one only as a whole piece.
    words = bpe.Vocabulary({b"a": 0, b"b": 1, b"c": 2, b"abc": 3, b"bc": 4, b"xyz": 5, b"x": 6, b"y": 7, b"z": 8})
    for n in range(1, 6):
        for data in {bytes(random.Random(i).choices(b"abcxyz", k=n)) for i in range(400)}:
            if data not in words.ranks:
                assert words.read_off(data, words.last_tokens(data)) == words.merged(data)
    assert words.read_off(b"xyz", words.last_tokens(b"xyz")) == [5]


def test_bpe_tables(spark, library):
    rows = [(1, "ab cd", 0), (1, "ab cd", 1), (None, None, 2), (2, "", 3), (3, "éé " * 3000, 4), (4, "the <|endoftext|> end", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    found = sorted(map(tuple, bpe.round_trip(df).collect()), key=repr)
    coded = [np.array(library.encode_ordinary(t or ""), "<u4") for _, t, _ in rows]
    expected = [
        (i, len(x), hashlib.sha256(x.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for (i, t, _), x in zip(rows, coded, strict=True)
    ]
    assert found == sorted(expected, key=repr)
    decoded = bpe.decode(bpe.encode(df)).select("doc_id", F.col("body").cast("string")).collect()
    assert sorted(map(tuple, decoded), key=repr) == sorted(((i, t or "") for i, t, _ in rows), key=repr)
    assert bpe.round_trip(df.limit(0)).count() == 0


def test_stored_table_follows_edits(spark, library):
    df = spark.createDataFrame([(1, "one two three"), (2, "four"), (None, "five"), (3, None)], "doc_id long, text string")
    edits = [(1, 2, 0, 0, "zero "), (1, 1, 4, 7, "2"), (3, 1, 0, 0, "new"), (2, 1, None, 3, "x"), (9, 1, 0, 0, "lost")]
    edits = spark.createDataFrame(edits, "doc_id long, seq int, start int, end int, insertion string")
    found = {r["doc_id"]: r for r in bpe.apply_edits(bpe.store(df), edits).collect()}
    assert {k: r["text"] for k, r in found.items()} == {1: "zero one 2 three", 2: "four", None: "five", 3: "new"}
    assert all(r["ids"] == library.encode_ordinary(r["text"]) for r in found.values())
    assert found[2]["worked"] == 0 < found[1]["worked"]
    again = bpe.apply_edits(spark.createDataFrame(list(found.values())), edits.filter("doc_id = 3")).filter("doc_id = 3").first()
    assert again["text"] == "newnew" and again["ids"] == library.encode_ordinary("newnew")


# --- conversation trie -----------------------------------------------------------------------


def trie_by_hand(rows, every=20, most=4):
    """Every prefix of every rebuilt conversation in dictionaries."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append(((turn is not None, turn or 0, digest), (role, text)))
    own = {c: [x for _, x in sorted(v, key=lambda x: x[0])] for c, v in own.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % most
        base = c - int(math.fmod(c, every))
        whole[c] = own.get(base, [])[:h] + own[c][h:]
    members = {}
    for c, path in whole.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
    out = []
    for path, convs in members.items():
        under = [p for p in members if p[: len(path)] == path]
        children = [p for p in under if len(p) == len(path) + 1]
        leaves = [p for p in under if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in under)]
        saved = sum((len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in under if p)
        ends = ",".join(str(c) for c in sorted(convs) if len(whole[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(convs), len(path), parent, len(convs), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
CONVS = "conv_id long, turn long, role string, text string"


def trie_rows(df, width):
    placed = prefix_trie.rebuilt(prefix_trie.turns(df))
    return sorted((tuple(r) for r in prefix_trie.nodes(placed, width).select(COLUMNS).collect()), key=repr)


@pytest.mark.parametrize("width", [1, 3, 8])
def test_trie_against_prefixes(spark, monkeypatch, width):
    monkeypatch.setattr(prefix_trie, "TURNS", 4)
    monkeypatch.setattr(prefix_trie, "BLOCKS", 2)
    monkeypatch.setattr(prefix_trie, "IDS", 8)
    rng = random.Random(width)
    rows = []
    for c in [*range(60), -7, -20, -21, 1000, 1001]:
        kind = rng.randrange(4)
        for t in range(rng.choice([1, 2, 5, 9, 23])):
            rows.append((c, t, rng.choice(["user", "user", None]), f"say {'x ' * (t % 3)}{kind if kind < 3 else rng.randrange(3)}"))
    rows += [(70, None, None, None), (70, None, "user", None), (70, 0, "user", "a"), (70, 0, "user", "a"), (70, 0, "user", "b"), (None, 0, "user", "lost")]
    rng.shuffle(rows)
    assert trie_rows(spark.createDataFrame(rows, CONVS), width) == trie_by_hand(rows)


def test_trie_edges(spark):
    assert trie_rows(spark.createDataFrame([], CONVS), 8) == []
    # 1 has no turns of its own beyond its first h and no base to take any from.
    alone = [(c, 0, "user", "a b") for c in range(1, 19)]
    found = trie_rows(spark.createDataFrame(alone, CONVS), 8)
    assert found == trie_by_hand(alone) and len(found) == 2 and found[0][3] == 18
    copies = [(c, t, "user", f"turn {t}") for c in range(20, 400, 20) for t in range(40)]
    assert trie_rows(spark.createDataFrame(copies, CONVS), 8) == trie_by_hand(copies)
    wide = spark.createDataFrame(alone, CONVS).selectExpr("*", "1 AS pos", "'x' AS id", "2 AS block", "3 AS words")
    assert prefix_trie.rebuilt_trie(wide).columns == COLUMNS
    longest = [(1, 0, "user", "w " * 200_000), (21, 0, "user", "w " * 200_000)]
    assert trie_rows(spark.createDataFrame(longest, CONVS), 8) == trie_by_hand(longest)


# --- ranked search ---------------------------------------------------------------------------


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def ranked_by_hand(docs, items, k):
    found = [(i, Counter(terms(t))) for i, t in docs if i is not None and terms(t)]
    n_docs, total = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, wanted in asked.items():
        scores = []
        for doc, counts in found:
            m = 50 + (50 * sum(counts.values()) * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * counts[t]) // (1000 * counts[t] + 20 * m)) for t in wanted if t in counts
            )
            if score > 0:
                scores.append((-score, doc))
        out += [(item, rank, doc, -score) for rank, (score, doc) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def corpus(rng, n):
    words = [f"w{i}" for i in range(60)] + ["Éa", "éa", "X9", "x9"]
    docs = []
    for i in range(n):
        theme = rng.sample(words, 6)
        docs.append((i, " ".join(rng.choice(theme if rng.random() < 0.7 else words) + rng.choice(["", "-", ".\n"]) for _ in range(rng.choice([0, 1, 5, 30, 80])))))
    docs += [(n + j, docs[1 + j % 3][1]) for j in range(12)]  # ties
    return docs, [(i, " ".join(rng.sample(words, rng.choice([1, 4, 12])))) for i in range(15)]


@pytest.mark.parametrize("shard", [7, 50, 4096])
def test_search_against_all_scores(spark, monkeypatch, shard):
    monkeypatch.setattr(ranked_search, "DOCS", shard)
    docs, items = corpus(random.Random(shard), 300)
    docs += [(5, "w1 w2"), (5, "w1 w2"), (None, "w1"), (900, None), (901, ""), (902, "-- .")]
    items += [(3, "w59 more"), (None, "w1"), (50, None), (51, "unknownterm")]
    frames = spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")
    for k in (1, 5, 50):
        found = ranked_search.search(*frames, k=k, block=4)
        assert sorted(tuple(r) for r in found.collect()) == ranked_by_hand(docs, items, k)


def test_blocks_of_queries_give_equal_rows(spark, monkeypatch):
    docs, items = corpus(random.Random(1), 80)
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(tuple(r) for r in ranked_search.search(*frames, k=4).collect())
    monkeypatch.setattr(ranked_search, "QUERIES", 4)
    assert [len(b) for b in ranked_search.query_blocks(frames[1], 4, 8192)] == [4, 4, 4, 3]
    assert len(list(ranked_search.query_blocks(frames[1], 99, 13))) > 3
    blocks = list(ranked_search.query_blocks(frames[1], 4, 8192))
    monkeypatch.setattr(ranked_search, "query_blocks", lambda items: iter(blocks))
    assert sorted(tuple(r) for r in ranked_search.search(*frames, k=4).collect()) == whole == ranked_by_hand(docs, items, 4)


def test_bounds_skip_blocks():
    rng = np.random.default_rng(0)
    impacts = np.where(rng.random((2000, 40)) < 0.3, rng.integers(1, 1000, (2000, 40)), 0).astype(np.int32)
    impacts[:200, :5] += 5000  # a theme of its own
    weights = rng.integers(1, 50, 40)
    everything = np.arange(40)
    index = ranked_search.Shard(impacts, weights, [everything] * 40, 16)
    for query in (np.arange(5), np.arange(3, 12), np.array([7])):
        best = ranked_search.Best(10)
        scored, blocks = index.search(query, weights[query], np.arange(2000), best)
        scores = impacts[:, query].astype(np.int64) @ weights[query]
        order = np.lexsort((np.arange(2000), -scores))[:10]
        assert best.ids.tolist() == order.tolist() and best.scores.tolist() == scores[order].tolist()
        assert scored < blocks
    for t, (docs, starts, columns, summary) in index.lists.items():
        assert sorted(docs.tolist()) == np.flatnonzero(impacts[:, t]).tolist() and np.diff(starts).max() <= 16
        for b in range(len(starts) - 1):
            assert np.array_equal(summary[b], impacts[docs[starts[b] : starts[b + 1]]][:, columns].max(axis=0))


def test_search_edges(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked_search.search(docs, items.limit(0)).collect() == []
    assert ranked_search.search(docs.limit(0), items).collect() == []
    assert ranked_search.search(docs.withColumn("text", F.lit(None).cast("string")), items).collect() == []
    clashing = docs.selectExpr("*", "1 AS n", "2 AS terms", "3 AS score", "4 AS rank", "5 AS item_id")
    assert [tuple(r)[:3] for r in ranked_search.search(clashing, items).collect()] == [(1, 1, 1)]
    body = "a " * 700_000 + "b" * 3_000_000
    rows = [w for part in ranked_search.words(body) for w in part]
    assert len(rows) == 700_001 and len(rows[-1]) == 3_000_000
