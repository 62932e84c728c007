"""The methods behind the operators against brute force, exact round trips and direct definitions."""

import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions

from panelcast.llm import common, components, decontam, jaccard, langid, packing, pii, quality, queries, token_counts
from panelcast.llm.common import Blocks
from panelcast.llm.lookup import Lookup

# --- n-gram Jaccard join ----------------------------------------------------------------


@pytest.mark.parametrize("rule", [jaccard.Rule(4, 85, 100), jaccard.Rule(5, 80, 100), jaccard.Rule(3, 60, 100)])
def test_linked_sets_share_an_entry(rule):
    rng, linked = np.random.default_rng(3), 0
    for trial in range(1500):
        n = int(rng.integers(1, 30)) if trial % 3 else int(rng.integers(30, 900))
        whole = rng.integers(0, 2**62, n + n // 3 + 2).astype(np.uint64)
        cut = int(rng.integers(0, max(2, n // 4)))
        a, b = np.unique(whole[:n]), np.unique(np.concatenate([whole[cut:n], whole[n : n + int(rng.integers(0, max(1, n // 6) + 1))]]))
        both = len(np.intersect1d(a, b))
        if len(b) and both * rule.den >= (len(a) + len(b) - both) * rule.num and not np.array_equal(a, b):
            linked += 1
            assert len(np.intersect1d(jaccard.entries(a, rule), jaccard.entries(b, rule)))
    assert linked > 200


def test_a_set_has_no_more_entries_than_its_size_needs():
    rng = np.random.default_rng(4)
    for rule in (jaccard.Rule(4, 85, 100), jaccard.Rule(5, 80, 100)):
        for n in (200, 300, 450, 600, 850):
            grams = np.unique(rng.integers(0, 2**62, n).astype(np.uint64))
            needs = []
            for lo, hi in itertools.takewhile(lambda band: band[0] <= rule.partner(n), jaccard.band_tops()):
                if hi >= n:
                    assert jaccard.layout(rule, lo, hi)[1] == 1
                    needs.append(rule.difference(n + min(hi, rule.partner(n))) + 1)
            assert 0 < len(jaccard.entries(grams, rule)) <= sum(needs)


def test_odd_parts_rule_out_only_unlinked_pairs(spark):
    rng, rule = np.random.default_rng(6), jaccard.Rule(4, 85, 100)
    sets, linked, apart = [], set(), set()
    for i in range(120):
        n = int(rng.integers(1, 900))
        whole = np.unique(rng.integers(0, 2**62, 2 * n + 2).astype(np.uint64))
        rng.shuffle(whole)
        cut = int(rng.integers(0, n // 2 + 1)) if i % 2 else int(n * 0.08)
        a, b = np.sort(whole[:n]), np.sort(whole[cut : n + cut])
        both = len(np.intersect1d(a, b))
        assert sum(int(x).bit_count() for x in (jaccard.odd_parts(a) ^ jaccard.odd_parts(b)).view(np.uint64)) <= len(a) + len(b) - 2 * both
        (linked if both * rule.den >= (2 * n - both) * rule.num else apart).add((2 * i, 2 * i + 1))
        sets += [(2 * i, n, jaccard.odd_parts(a).tolist()), (2 * i + 1, n, jaccard.odd_parts(b).tolist())]
    pairs = spark.createDataFrame(sorted(linked | apart), "a long, b long")
    kept = {tuple(r) for r in jaccard.few_differences(pairs, spark.createDataFrame(sets, "id long, n long, odd array<long>"), rule).collect()}
    assert len(linked) > 20 and linked <= kept
    assert len(apart - kept) > 0.6 * len(apart)


def test_the_exchange_of_entries_moves_nothing_else(spark):
    rows = spark.createDataFrame([(1, [256, 512]), (2, [512]), (3, [512]), (4, [768]), (5, [768])], "doc_id long, entries array<long>")
    labels = spark.createDataFrame([(1, 1), (2, 1)], "node long, label long")
    moved = jaccard.moved_entries(rows, labels)
    found = {(r["entry"], r["id"]): r["label"] for r in moved.collect()}
    assert found == {(256, 1): None, (512, 1): None, (512, 2): 1, (512, 3): None, (768, 4): None, (768, 5): None}
    shared = jaccard.shared_entries(rows, labels)
    assert {(r["pivot"], r["id"]) for r in shared.collect()} == {(1, 1), (1, 2), (1, 3), (4, 4), (4, 5)}
    plan = shared._jdf.queryExecution().optimizedPlan().toString()
    dealt = re.search(r"RepartitionByExpression \[entry.*\n[ :+-]*(.*)", plan)
    assert dealt and "xxhash64" not in plan[dealt.start() :] and re.match(r"Project \[entry[^,]*, doc_id[^,]*, (if|CASE|label)", dealt[1]), plan
    assert plan.index("xxhash64") < dealt.start()  # computed where the rows have arrived
    sets = [np.unique(np.random.default_rng(9).integers(0, 2**62, 300).astype(np.uint64))]
    assert not (jaccard.entries(sets[0], jaccard.Rule()) & np.uint64(0xFFFF)).any()


def test_workers_give_memory_back_around_a_task(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "give_back", lambda keep=common.give_back: calls.append(len(seen)) or keep())
    seen = []
    for x in common.lean(lambda batches: (2 * x for x in batches))(iter([1, 2, 3])):
        seen.append(x)
    assert seen == [2, 4, 6] and calls == [0, 3]
    for run in (jaccard.index_batches(jaccard.Rule()), jaccard.set_batches(jaccard.Rule()), jaccard.level_batches(jaccard.Rule(), 1), components.star_batches(9)):
        calls.clear()
        assert not list(run(iter([]))) and len(calls) == 2


def test_labelled_rows_need_no_python_workers(spark, monkeypatch):
    monkeypatch.setattr(pii, "fit", lambda labelled: labelled)
    rows = queries.personal_data_field(spark)
    assert rows.schema.simpleString() == "struct<text:string,spans:array<struct<kind:string,start:int,end:int>>>"
    assert "LocalTableScan" in rows._jdf.queryExecution().executedPlan().toString()
    assert [(r["text"], [tuple(x) for x in r["spans"]]) for r in rows.collect()] == pii.examples()


def test_components_against_a_walk(spark, monkeypatch):
    made = []
    monkeypatch.setattr(components, "stored", lambda df, label, keep=components.stored: made.append(label) or keep(df, label))
    rng = random.Random(8)
    for block in (components.BLOCK, 7):
        monkeypatch.setattr(components, "BLOCK", block)
        edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(90)] + [(i, i + 1) for i in range(300, 340)] + [(5, 5), (400, 400), (7, 6), (6, 7)]
        near = {}
        for a, b in edges:
            if a != b:
                near.setdefault(a, set()).add(b)
                near.setdefault(b, set()).add(a)
        least = {}
        for i in sorted(near):
            todo = [i] if i not in least else []
            while todo:
                at = todo.pop()
                if at not in least:
                    least[at] = i
                    todo += near[at]
        made.clear()
        found = components.components(spark.createDataFrame(edges, "a long, b long").repartition(5))
        assert sorted((r["node"], r["label"]) for r in found.collect()) == sorted(least.items())
        assert made == ["edges", "stars", "labels"] if block > 7 else "large" in made  # one block needs no passes
    text = components.components(spark.createDataFrame([("é", "z"), ("z", "\U0001f600")], "a string, b string"))
    assert {(r["node"], r["label"]) for r in text.collect()} == {("z", "z"), ("é", "z"), ("\U0001f600", "z")}
    assert components.components(spark.createDataFrame([], "a long, b long")).isEmpty()


def test_difference_bounds_linked_pairs():
    rule = jaccard.Rule(4, 85, 100)
    for a, b in itertools.product(range(1, 60), repeat=2):
        for both in range(min(a, b) + 1):
            if both * 100 >= (a + b - both) * 85:
                assert a + b - 2 * both <= rule.difference(a + b) and b <= rule.partner(a)


def test_sets_of_words():
    same, lower, short, none = jaccard.gram_sets(["A b\tc d e", "a B c d  e\n", "A b", " \t"], 4)
    assert np.array_equal(same, lower) and len(same) == 2 and len(short) == 1 and len(none) == 0
    assert len(jaccard.gram_sets(["É b c d", "é b c d"], 4)[0]) == 1
    assert not np.array_equal(*jaccard.gram_sets(["É b c d", "é b c d"], 4))  # only A-Z are lower-cased


def test_groups_against_all_pairs(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(25):
        body = [rng.choice(words) for _ in range(rng.choice([3, 8, 20, 60, 200]))]
        for _ in range(rng.choice([1, 2, 12])):
            copy = list(body)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    rows = [(1000 - i, t) for i, t in enumerate(texts)]
    for rule in (jaccard.Rule(4, 85, 100), jaccard.Rule()):
        sets = {i: frozenset(tuple(w[j : j + rule.words]) for j in range(max(1, len(w) - rule.words + 1))) for i, t in rows if (w := t.split())}
        group = {i: i for i in sets}

        def top(x, group=group):
            while group[x] != x:
                x = group[x]
            return x

        for a, b in itertools.combinations(sorted(sets), 2):
            if len(sets[a] & sets[b]) * rule.den >= len(sets[a] | sets[b]) * rule.num and top(a) != top(b):
                group[max(top(a), top(b))] = min(top(a), top(b))
        found = jaccard.similar_groups(spark.createDataFrame(rows, "doc_id long, text string"), rule).collect()
        assert {r["doc_id"]: r["component_id"] for r in found} == {i: top(i) for i in sets}
        assert {r["doc_id"]: r["n_shingles"] for r in found} == {i: len(s) for i, s in sets.items()}


def test_small_tables_take_few_tasks(spark, monkeypatch):
    rng, files = random.Random(12), {}

    def counted(df, label, keep=common.stored):
        out = keep(df, label)
        files[label] = max(files.get(label, 0), len(out.inputFiles()))
        return out

    for module in (common, components):
        monkeypatch.setattr(module, "stored", counted)
    monkeypatch.setattr(jaccard, "CROWD", 4)
    rows = []
    for group in range(30):
        body = [f"w{rng.randrange(5000)}" for _ in range(80)]
        rows += [(100 * group + i, " ".join([*body[:i], f"x{group}-{i}", *body[i + 1 :]])) for i in range(8)]
        rows += [(100 * group + 50 + i, " ".join([*body[:66], *(f"y{group}-{i}-{j}" for j in range(14))])) for i in range(6)]  # just short of similar
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "23")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        found = {r["doc_id"]: r["component_id"] for r in jaccard.similar_groups(docs, jaccard.Rule(4, 85, 100)).collect()}
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert found == {i: i - i % 100 if i % 100 < 50 else i for i, _ in rows}
    few = {"near", "ids", "plausible", "close", "tried", "linked", "labels", "sizes", "rows", "crowded", "again"}
    assert few <= files.keys() and {k: n for k, n in files.items() if k in few and n > 1} == {}
    assert [common.fitted(spark.range(90).repartition(9), n, 10).rdd.getNumPartitions() for n in (0, 10, 11, 900)] == [1, 1, 2, 9]


def test_no_pair_is_tried_twice(spark, monkeypatch):
    tried = []
    monkeypatch.setattr(jaccard, "plausible", lambda pairs, *_: pairs)
    monkeypatch.setattr(jaccard, "few_differences", lambda pairs, *_: pairs)
    monkeypatch.setattr(jaccard, "verified", lambda pairs, *_: tried.extend(map(tuple, pairs.collect())) or pairs.filter("a = 1"))
    pairs = spark.createDataFrame([(1, 2), (1, 3), (2, 3), (4, 6), (5, 6)], "a long, b long")
    sets, none = spark.createDataFrame([(i,) for i in range(1, 7)], "id long"), spark.createDataFrame([], "node long, label long")
    labels = jaccard.link_all(pairs, 5, sets, none, jaccard.Rule())
    assert {tuple(r) for r in labels.collect()} == {(1, 1), (2, 1), (3, 1)}
    assert sorted(tried) == [(1, 2), (1, 3), (4, 6), (5, 6)]


def test_signatures_rule_out_only_unlinked_pairs():
    rng, rule = np.random.default_rng(4), jaccard.Rule()
    sets, label = [], []
    for n in (30, 500, 520, 900, 3000):
        base = rng.integers(0, 2**62, n).astype(np.uint64)
        for share in (0, 0.03, 0.08, 0.1, 0.11, 0.14, 0.4):
            one = base.copy()
            one[rng.choice(n, int(n * share), replace=False)] = rng.integers(0, 2**62, int(n * share))
            sets.append(np.unique(one)[: n - int(rng.integers(0, n // 20))])
            label.append(int(rng.integers(0, 12)))
    ids = rng.permutation(len(sets))
    for block in (np.zeros(len(sets), int), np.arange(len(sets)) % 2):
        odd = jaccard._lists([jaccard.signature(x) for x in sets], pa.int64())
        table = pa.table({"id": ids, "label": label, "n": [len(x) for x in sets], "odd": odd, "block": block})
        found = jaccard.block_pairs(rule)(table)
        found = list(zip(found["a"].to_pylist(), found["b"].to_pylist(), strict=True))
        linked, others = set(), 0
        for i, j in itertools.combinations(range(len(sets)), 2):
            if label[i] != label[j] and (not block.any() or block[i] != block[j]):
                both = len(np.intersect1d(sets[i], sets[j]))
                if both * rule.den >= (len(sets[i]) + len(sets[j]) - both) * rule.num:
                    linked.add((int(min(ids[i], ids[j])), int(max(ids[i], ids[j]))))
                else:
                    others += 1
        assert len(found) == len(set(found)) and len(linked) > 5 and linked <= set(found)
        assert len(set(found) - linked) < 0.1 * others


def crowds(spark):
    """Sets of two crowds, just short of similar but for some pairs of each, and the component of each."""
    rng, rows, group = np.random.default_rng(6), [], {}
    for crowd in range(2):
        base = rng.integers(0, 2**62, 120)
        for i in range(20):
            one = 100 * crowd + i
            own = rows[-1][2] if i % 5 == 4 else np.concatenate([base[:90], rng.integers(0, 2**62, 30)]).tolist()
            own = own[:-3] + rng.integers(0, 2**62, 3).tolist()
            rows.append((one, len(own), own))
            group[one] = one - 1 if i % 5 == 4 else one
    parts = [([int(x) for x in jaccard.parts_of(g)], [], jaccard.odd_parts(g).tolist()) for g in (np.array(r[2]).astype(np.uint64) for r in rows)]
    rows = [(i, n, *p, g) for (i, n, g), p in zip(rows, parts, strict=True)]
    kind = "id long, n long, parts array<short>, fine array<short>, odd array<long>, grams array<long>"
    return spark.createDataFrame(rows, kind), group


def test_crowds_meet_by_signatures(spark, monkeypatch):
    sets, group = crowds(spark)
    crowded = spark.createDataFrame([(i - i % 100, i) for i in group], "pivot long, id long")
    none, met = common.stored(spark.createDataFrame([], "node long, label long"), "labels"), []

    def rounds(dealt, start, end, *rest, link=jaccard.link_blocks):
        met.append((start, dealt.columns))
        return link(dealt, start, end, *rest)

    monkeypatch.setattr(jaccard, "link_blocks", rounds)
    monkeypatch.setattr(jaccard, "BLOCK_DOCS", 2)  # ten blocks a crowd, in two rounds
    labels = {r["node"]: r["label"] for r in jaccard.crowd_links(crowded, sets, none, jaccard.Rule()).collect()}
    assert {i: labels.get(i, i) for i in group} == group and len(labels) == 16
    assert [start for start, _ in met] == [0, 8] and not any("grams" in columns for _, columns in met)


def test_shares_of_entries_give_the_same_buckets(spark, monkeypatch):
    sets, group = crowds(spark)
    again = spark.createDataFrame([(i,) for i in group if i % 100 != 19], "doc_id long")
    none, moved = spark.createDataFrame([], "node long, label long"), []

    def counted(rows, labels, move=jaccard.moved_entries):
        moved.append(rows.select(functions.sum(functions.size("entries"))).first()[0])
        return move(rows, labels)

    monkeypatch.setattr(jaccard, "moved_entries", counted)
    found = []
    for share in (10**7, 3000):
        monkeypatch.setattr(jaccard, "SHARE", share)
        rows = jaccard.further_members(again, 1, 4 * len(group), sets, none, jaccard.Rule())
        found.append(sorted((tuple(r["bucket"]), r["pivot"], r["id"]) for r in rows.collect()))
    assert found[0] == found[1] and len(found[0]) > 60 and {100 * c + 19 for c in range(2)}.isdisjoint(i for *_, i in found[0])
    assert len(moved) > 3 and max(moved[1:]) < 3000 and sum(moved[1:]) == moved[0]


def test_rows_are_filtered_where_they_lie(spark, monkeypatch):
    ids = common.stored(spark.range(0, 3000, 3).withColumnRenamed("id", "x"), "ids")
    rows = spark.range(0, 6000, numPartitions=3).selectExpr("if(id % 7 = 0, null, id) AS doc_id", "repeat('t', 9) AS text")
    want = {i for i in range(0, 3000, 3) if i % 7}
    assert {r["doc_id"] for r in common.among(rows, ids, "doc_id").collect()} == want
    monkeypatch.setattr(common, "BROADCAST_ROWS", 10)
    some = common.among(rows, ids, "doc_id")
    assert some.columns == rows.columns
    found = [r["doc_id"] for r in some.collect()]
    assert len(found) == len(set(found)) < 1.3 * len(want) and want <= set(found) and None not in found
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    docs = [(i, f"a{i} b c d e f g h i j k l m n o p q r s t") for i in range(60)]
    docs += [(60 + i, docs[i][1] + " u") for i in range(30)]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard.similar_groups(docs, jaccard.Rule()).collect()}
    monkeypatch.undo()
    assert got == {r["doc_id"]: r["component_id"] for r in jaccard.similar_groups(docs, jaccard.Rule()).collect()}


# --- contamination -----------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=120), st.lists(st.integers(1, 4), min_size=1, max_size=6))
def test_fm_index_finds_all(text, phrase):
    text, phrase = np.array(text), np.array(phrase)
    index = decontam.FMIndex(text)
    padded = np.zeros((1, 8), np.int64)
    padded[0, 8 - len(phrase) :] = phrase
    low, high = index.search(padded, np.array([len(phrase)]))
    found = sorted(index.locate(np.arange(low[0], high[0])).tolist())
    assert found == [i for i in range(len(text)) if np.array_equal(text[i : i + len(phrase)], phrase)]


def test_contamination_against_brute_force(spark):
    rng = random.Random(1)
    words = ["a", "b", "cé", "d9", "E"]

    def text(n):
        return "".join(rng.choice(words) + rng.choice([" ", ", ", "\n", "-"]) for _ in range(n))

    items = [(i, text(rng.choice([1, 2, 4, 5, 9]))) for i in range(25)]
    docs = [(i, text(rng.choice([0, 3, 10, 60]))) for i in range(150)]
    window = 4

    def split(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate({c: c + 32 for c in range(65, 91)}))

    windows = [(i, w[j : j + window]) for i, t in items if (w := split(t)) for j in range(max(1, len(w) - window + 1))]
    found = decontam.contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), window
    )
    got = {r["doc_id"]: r for r in found.collect()}
    for i, t in docs:
        w, hit, ids = split(t), set(), set()
        for item, phrase in windows:
            for j in range(len(w) - len(phrase) + 1):
                if w[j : j + len(phrase)] == phrase:
                    hit.update(range(j, j + len(phrase)))
                    ids.add(item)
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["items"]) == (len(w), len(hit), sorted(ids))
        covered = [x for s in got[i]["spans"] for x in split(t[s["start"] : s["end"]])]
        assert len(covered) == len(hit)


def test_blocks_give_the_same(spark, monkeypatch):
    items = spark.createDataFrame([(i, f"w{i} w{i + 1} w{i + 2} w{i + 3}") for i in range(40)], "item_id long, text string")
    docs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(60)))], "doc_id long, text string")
    one = decontam.contamination(docs, items, 3).collect()
    monkeypatch.setattr(decontam, "BLOCK_ROWS", 10)
    assert decontam.contamination(docs, items, 3).collect() == one


# --- personal data -----------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def by_pattern(text):
    out = {}
    for kind, pattern in PATTERNS.items():
        spans = []
        for m in re.finditer(pattern, text):
            digits = re.findall("[0-9]", m.group())
            if kind == "ip" and max(map(int, m.group().split("."))) > 255:
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and pii.luhn(m.group())):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            spans.append(m.span())
        out[kind] = spans
    return out


PIECES = ["1", "25", "300", ".", ".", "@", "a", "b-", "+", " ", " ", "(", ")", "x@y.zz", "4111 1111 1111 1111", "+1 (743) 555-3824", "9.8.7.6", "é"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join))
def test_base_spans_are_those_of_the_patterns(text):
    assert pii.base_spans(text) == by_pattern(text)


def test_long_runs_are_linear():
    for text in ("1" * 300_000, "1." * 150_000, "a" * 300_000 + "@", "@a" * 100_000, "+1" * 100_000):
        pii.base_spans(text)


def test_field_reads_unseen_rows():
    field = pii.fit_rows(pii.examples())
    unseen = pii.examples(300, seed=99)
    found = pii.find([t for t, _ in unseen], field)
    right = sum(sorted(s) == sorted(spans) for (_, spans), (_, s) in zip(unseen, found, strict=True))
    assert right >= 285
    for (text, _), (base, spans) in zip(unseen, found, strict=True):
        assert {(k, *s) for k in pii.KINDS for s in base[k]} <= set(spans) and base == by_pattern(text)
    assert not any(s for _, s in pii.find(["in 1999 about 25 of 3,400 (see 12.5) units", "version 2.10.3 at 10:30"], field))


def test_long_lists_and_names_are_read_whole():
    field = pii.fit_rows(pii.examples())
    made = {"phone": "(499) 555-6503", "email": "joe [at] example [dot] com"}
    for (kind, x), between in itertools.product(made.items(), (", ", "; ", " and ")):
        step = len(x) + len(between)
        found = pii.find(["call " + between.join([x] * 150)], field)[0][1]
        assert found == [(kind, 5 + i * step, 5 + i * step + len(x)) for i in range(150)]
    name = "avery" * 12
    assert pii.find([f"write to {name} [at] example [dot] com now"], field)[0][1] == [("email", 9, 9 + 60 + 23)]
    assert pii.find(["(499) 555-6503"], field)[0][1] == [("phone", 0, 14)]


def test_stretches_are_whole_words():
    rng = random.Random(4)
    for _ in range(500):
        text = "".join(rng.choice(["a" * rng.randint(1, 60), " ", " ", "7", "@", "(at)", "\n"]) for _ in range(rng.randint(0, 12)))
        found = list(pii.windows(text))
        for a, b in found:
            assert (a == 0 or text[a - 1].isspace() or text[a].isspace()) and (b == len(text) or text[b].isspace())
        assert all(b < c for (_, b), (c, _) in itertools.pairwise(found))
        for m in pii.MARK.finditer(text):
            assert any(a <= max(0, m.start() - pii.REACH) and min(len(text), m.end() + pii.REACH) <= b for a, b in found)


def test_emissions_do_not_depend_on_the_parts(monkeypatch):
    field = pii.fit_rows(pii.examples(60))
    text = "call +1 (234) 555-1234 or (499) 555-6503, " * 9
    tokens = [m.span() for m in pii.TOKEN.finditer(text)]
    whole = field.emissions(text, tokens)
    monkeypatch.setattr(pii, "TOKENS", 7)
    assert np.array_equal(field.emissions(text, tokens), whole)


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(0)
    field = pii.Field({}, np.zeros((0, len(pii.LABELS))), rng.normal(size=(len(pii.LABELS),) * 2))
    sequences = [rng.normal(size=(n, len(pii.LABELS))) for n in (1, 2, 3, 4)]
    for scores, path in zip(sequences, field.decode(sequences), strict=True):
        def total(p, scores=scores):
            return sum(scores[i, x] for i, x in enumerate(p)) + sum(field.transition[x, y] for x, y in itertools.pairwise(p))

        best = max(itertools.product(range(len(pii.LABELS)), repeat=len(scores)), key=total)
        assert tuple(path) == best


def test_redaction():
    assert pii.redacted("a b@c.de f", [("email", 2, 8)]) == "a <email> f"
    assert pii.redacted("0123456", [("ip", 1, 3), ("card", 2, 5)]) == "0<ip>56"


# --- packing -----------------------------------------------------------------------------


def test_vocabularies_agree():
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ours = packing.encoding()
    rng = random.Random(2)
    signs = "abcdeé ß\n\t  .,'s'll123　한\U0001f600\x00"
    for _ in range(400):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 80)))
        assert whole.encode(text, add_special_tokens=False).ids == ours.encode_ordinary(text) == ours.encode_to_numpy(text).tolist()


def test_added_tokens_agree(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ours = packing.encoding()
    rng = random.Random(3)
    pieces = ["<|endoftext|>", "<|endoftext|>", "<|endoftext", "|>", "<", " ", "  ", "\n", "a", "é", "the end", "'s", "12", "😀"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 12))) for _ in range(400)]
    for text in texts:
        want = whole.encode(text, add_special_tokens=False).ids
        assert want == ours.encode_ordinary(text) == ours.encode_to_numpy(text).tolist()
    rows = packing.pack_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    for r in rows.collect():
        ids = np.array([*whole.encode(texts[r["doc_id"]], add_special_tokens=False).ids, packing.END], "<u4")
        assert r["doc_tokens"] == len(ids)
        assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 150), max_size=40), st.integers(1, 9))
def test_pack_places_every_token_once(lengths, segments):
    tokens = [np.arange(n) for n in lengths]
    sequences = packing.pack(tokens, length=64, segments=segments)
    held = sorted((i, at + k) for content in sequences for i, at, n in content for k in range(n))
    assert held == sorted((i, k) for i, n in enumerate(lengths) for k in range(n))
    for content in sequences:
        size = sum(n for _, _, n in content)
        assert len(content) <= segments and (size == 64 or size & (size - 1) == 0)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 150), max_size=40), st.integers(1, 9), st.integers(1, 70))
def test_pack_holds_the_loss_limit(lengths, segments, loss):
    sequences = packing.pack([np.arange(n) for n in lengths], length=64, segments=segments, loss=loss)
    held = sorted((i, at + k) for content in sequences for i, at, n in content for k in range(n))
    assert held == sorted((i, k) for i, n in enumerate(lengths) for k in range(n))
    for content in sequences:
        size = sum(n for _, _, n in content)
        assert len(content) <= segments and (size == 64 or size & (size - 1) == 0)
        assert sum(n - (at == 0) for _, at, n in content) <= loss


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 100), st.just(1), st.integers(0, 50)), max_size=40))
def test_uncut_bins_hold_their_limits(rows):
    vectors, limits = np.array(rows, float).reshape(-1, 3), np.array([100, 5, 50])
    bins = packing.fill(vectors, limits)
    assert sorted(i for content in bins for i, _, _ in content) == list(range(len(rows)))
    for content in bins:
        assert (vectors[[i for i, _, _ in content]].sum(axis=0) <= limits).all()


# --- language ----------------------------------------------------------------------------


def test_code_lengths_by_definition():
    texts = {"x": "abab abc ab", "y": "cba cb cab a"}
    counts = []
    for t in texts.values():
        keys, n = np.unique(langid.symbols(t.split())[0], return_counts=True)
        counts.append(dict(zip(keys.tolist(), n.tolist(), strict=True)))
    model = langid.Model(list(texts), counts)

    def bits(lang, word):
        seen = {}
        for w in texts[lang].split():
            coded = " " * langid.ORDER + w + " "
            for i in range(langid.ORDER, len(coded)):
                for order in range(langid.ORDER + 1):
                    seen.setdefault(coded[i - order : i], []).append(coded[i])
        total, coded = 0.0, " " * langid.ORDER + word + " "
        for i in range(langid.ORDER, len(coded)):
            for order in range(langid.ORDER, -1, -1):
                after = seen.get(coded[i - order : i], [])
                kinds = len(set(after))
                if coded[i] in after:
                    total -= math.log2(after.count(coded[i]) / (len(after) + kinds))
                    break
                if after:
                    total -= math.log2(kinds / (len(after) + kinds))
            else:
                total += 8
        return total

    words = ["ab", "abc", "cab", "zz", "a", "bca"]
    got = model.of_words(words)
    for w, row in zip(words, got, strict=True):
        assert row == pytest.approx([bits(lang, w) for lang in texts], rel=1e-5)


def test_whole_texts_are_learned(spark):
    texts = {"x": "abab ab " * 5000 + "zqxj vw", "y": "cba cb"}
    rows = [(i, t, lang) for i, (lang, t) in enumerate(texts.items())]
    got = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    counts = []
    for t in texts.values():
        keys, n = np.unique(langid.symbols(t.split())[0], return_counts=True)
        counts.append(dict(zip(keys.tolist(), n.tolist(), strict=True)))
    words = ["zqxj", "vw", "ab", "cb"]
    assert np.allclose(got.of_words(words), langid.Model(list(texts), counts).of_words(words))


def test_held_out_languages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = langid.learn_and_identify(docs).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) > 200 and sum(r["lang"] == r["lang_pred"] for r in found) >= 0.97 * len(found)
    assert all(0 <= r["score"] <= 1 for r in found)


# --- quality -----------------------------------------------------------------------------


def test_probabilities_sum_to_one(spark):
    texts = ["abracadabra", "abra abra cad", "bad cab", "a", "dab"] * 3
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    shard = next(iter(Blocks(quality.train(docs))))
    letters = sorted({c for t in texts for c in t} | {quality.STOP, quality.START, "ý"})
    # START is only ever a context, so it is not in the alphabet; ý stands for the unknown character.
    for context in ("", "a", "ab", "abra", "zz"):
        total = 0.0
        for c in letters:
            if c == quality.START:
                continue
            points, _ = quality.characters([context + c])
            at = np.array([quality.ORDER - 1 + len(context)])
            total += 2 ** shard.logp(quality.run_keys(points), at)[0]
        assert total == pytest.approx(1.0, abs=1e-6)


def test_shards_give_the_same(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    columns = ["doc_id", "perplexity", "keep"]
    one = {r["doc_id"]: r for r in quality.classify(docs, labels).select(columns).collect()}
    monkeypatch.setattr(quality, "SHARD_ROWS", 3000)
    for r in quality.classify(docs, labels).select(columns).collect():
        assert r["perplexity"] == pytest.approx(one[r["doc_id"]]["perplexity"]) and r["keep"] == one[r["doc_id"]]["keep"]


def test_junk_is_rejected(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.classify(docs, labels).join(labels, "doc_id").collect()
    good = [r["keep"] for r in rows if r["quality"] == 1 and r["toxic"] == 0]
    bad = [r["keep"] for r in rows if r["quality"] == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.05 * len(bad)


# --- token counts ------------------------------------------------------------------------


def test_edits_match_recounts():
    counter, rng = token_counts.Counter(), random.Random(8)
    signs = " \n\t'stre ,.a1é  　"
    for _ in range(150):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 1500)))
        tree = token_counts.Tree.of_text(text, counter)
        for _ in range(4):
            start = rng.randint(0, len(text) + 2)
            added = "".join(rng.choice(signs) for _ in range(rng.choice([0, 1, 3, 20, 900])))
            text, tree, _ = token_counts.edited(text, tree, start, start + rng.choice([0, 1, 5, 40, 400]), added, counter)
            assert tree.total == len(counter.encoder.encode_ordinary(text)) and tree.chars[1] == len(text)
            assert tree.tokens[tree.leaves :].sum() == tree.total


def test_small_edits_encode_little():
    counter = token_counts.Counter()
    text = "some words of a long document. " * 3000
    tree = token_counts.Tree.of_text(text, counter)
    _, tree, encoded = token_counts.edited(text, tree, 40_000, 40_004, "other", counter)
    assert encoded < 2000


# --- lookup ------------------------------------------------------------------------------


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2**63 - 1), unique=True, max_size=200), st.lists(st.integers(0, 2**63 - 1), max_size=50))
def test_lookup(keys, others):
    table, at = Lookup(np.array(keys, np.uint64)), {k: i for i, k in enumerate(keys)}
    asked = keys + others
    assert table.find(np.array(asked, np.uint64)).tolist() == [at.get(k, -1) for k in asked]


# --- edits of one id --------------------------------------------------------------------------


def test_no_edit_of_an_id_is_lost(spark):
    docs = spark.createDataFrame([(1, "one two three"), (2, "alpha beta")], "doc_id long, text string")
    schema = "doc_id long, edits array<struct<start:int,end:int,insertion:string>>"
    edits = spark.createDataFrame([(1, [(4, 7, "2")]), (1, [(0, 3, "1")]), (2, [(0, 0, "x ")])], schema)
    found = {r["doc_id"]: r for r in token_counts.apply_edits(docs, token_counts.build(docs), edits).collect()}
    assert found[1]["n_edits"] == 2 and found[1]["text"] == "1 tw2hree"  # the array that starts first comes first
    assert found[2]["text"] == "x alpha beta"


def test_texts_under_one_id_keep_their_own_edits(spark):
    docs = spark.createDataFrame([(1, "a text of its own " * 9), (1, "another one " * 20), (1, "another one " * 20)], "doc_id long, text string")
    sampled = token_counts.sample_edits(docs)
    rows = token_counts.apply_edits(docs, token_counts.build(docs), sampled).collect()
    plans = {r["key"]: r["edits"] for r in sampled.collect()}
    assert len(rows) == 3 and len(plans) == 2 and all(r["n_edits"] == 2 for r in rows)
    counter, expected = token_counts.Counter(), []
    for r in docs.withColumn("key", token_counts.key_of(docs["doc_id"], docs["text"])).collect():
        text = r["text"]
        for e in plans[r["key"]]:
            start = min(e["start"], len(text))
            text = text[:start] + e["insertion"] + text[min(max(e["end"], start), len(text)) :]
        expected.append((text, int(counter.numbers(counter.pattern.findall(text)).sum())))
    assert sorted((r["text"], r["edited_tokens"]) for r in rows) == sorted(expected)


def test_score_tells_clearness_not_length(spark):
    rows = [(i, w, "x" if i % 2 else "y") for i in range(40) for w in [("abc bca cab " if i % 2 else "uvw vwu wuv ") * 5]]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    scorer = langid.Scorer(model)
    short, long, mixed = scorer.predict(["abc bca", "abc bca " * 500, "abc bca uvw vwu abc"])
    assert short[0] == long[0] == mixed[0] == "x"
    assert abs(short[1] - long[1]) < 1e-9 and 0.5 < mixed[1] < short[1] < 1
