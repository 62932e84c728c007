"""Exact similarity join of documents on word n-gram sets.

Two sets link when ``den * |A & B| >= num * |A | B|``. For sets whose larger one has at most ``hi``
elements, the symmetric difference of a linked pair is at most ``D``, a fixed share of the two sizes.
Hashing divides the universe of n-grams into segments; each difference spoils one segment, so when the
*allocations* of all segments add up to more than ``D`` one segment must agree: exactly, if its
allocation is 1, or up to one element, if it is 2. A segment with allocation 1 is indexed by the hash of
its subset, one with allocation 2 also by the hashes of its subset without one element. ``layout``
chooses segments and allocation for each band of sizes by a cost of entries and chance agreements:
few large segments with one-deletion entries for short documents, many small ones for long documents.
A set stops at the first segment at which the allocations of its filled ones exceed the differences that its
own size allows: of two linked sets the one that stops first has an agreeing segment by then.

Empty segments (or, with allocation 2, nearly empty ones) agree by chance and are left out; a layout has
slack for them. A set whose slack does not suffice is indexed once more under another seed, and so on: of
two linked sets that both fail, both reach the next seed, so no link is lost. After the last seed the empty
segments are indexed too. Candidates share an entry; they are verified on their whole sets.

Equal sets are merged first, and groups of near copies by a first round over few entries of each set. Only
buckets that then hold several components are compared: small ones pair by pair, crowded ones at a further
level or in blocks of signatures. So a group of n similar documents costs about n comparisons while no link
between components is lost.

What a step writes to disk is bounded by the whole table: the entries of a further level are moved in shares, a
part of the entries each, blocks in rounds, and whole sets for a part of the pairs at a time. Sets and texts are
filtered where they lie, never moved to be filtered.
N-grams are compared by 64-bit hashes.
"""

from __future__ import annotations

import functools
import itertools
import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.common import BROADCAST_ROWS, ROWS, among, fitted, give_back, hinted, lean, materialize, reading, release, small_batches, stored, temporary
from panelcast.llm.components import components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BAND_GROWTH = 1.4
CHANCE, WEIGHT = 0.3, 200.0
RISK, SEEDS = 0.25, 12
PARTS, FINE_PARTS, FINE_FROM = 64, 1024, 1000
CHUNK = 1_000_000
FEW = 8
#: Entries keep their upper 48 bits, which chance lets agree once in 1e14 pairs of entries and files and the exchange compress.
SPARE_BITS = np.uint64(16)
#: Sizes up to which layouts are worked out once for all tasks.
KNOWN = 100_000
CROWD, LEVELS = 32, 2
#: Documents and n-grams of a block, and words of a comparison within a task.
BLOCK_DOCS, BLOCK_GRAMS, BLOCK_WORDS = 2048, 16_000_000, 1 << 20
#: Entries of a share, unless a fourth of the table's n-grams are more; an n-gram of a further level makes about so many.
SHARE, PER_GRAM = 10_000_000, 2.5
#: Pairs compared in a task: by the sizes of their parts, and by whole sets.
PAIRS, WHOLE = 2_000, 500


@dataclass(frozen=True)
class Rule:
    """Words of an n-gram and the least similarity ``num / den``."""

    words: int = 5
    num: int = 80
    den: int = 100

    def difference(self, total: int) -> int:
        """Largest symmetric difference of a linked pair whose sizes add up to ``total``."""
        return total * (self.den - self.num) // (self.den + self.num)

    def partner(self, n: int) -> int:
        """Largest set that can link with one of ``n`` elements."""
        return n * self.den // self.num


# --- sets -----------------------------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _fold(parts: list[np.ndarray]) -> np.ndarray:
    total = np.full_like(parts[0], len(parts))
    with np.errstate(over="ignore"):
        for part in parts:
            total = total * np.uint64(0x9E3779B97F4A7C15) + part
    return mix(total)


def gram_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text: A-Z lower-cased, words between white space; fewer
    words than an n-gram are one n-gram, none are none."""
    split = [x.encode("utf-8", "surrogatepass").lower().split() for x in texts]
    flat = list(itertools.chain.from_iterable(split))
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, flat), np.uint64, len(flat))
    grams = _fold([hashed[i : len(hashed) - words + 1 + i] for i in range(words)]) if len(flat) >= words else hashed[:0]
    out, start = [], 0
    for part in split:
        n = len(part)
        if n >= words:
            out.append(np.unique(grams[start : start + n - words + 1]))
        elif n:
            out.append(_fold([hashed[start + i : start + i + 1] for i in range(n)]))
        else:
            out.append(hashed[:0])
        start += n
    return out


# --- layouts --------------------------------------------------------------------------


def band_tops() -> Iterator[tuple[int, int]]:
    low = high = 1
    while True:
        yield low, high
        low, high = high + 1, max(high + 1, int(high * BAND_GROWTH))


def _tail(mean: float, k: int) -> float:
    """Chance that a Poisson number exceeds ``k``."""
    if k < 0:
        return 1.0
    term = total = math.exp(-mean)
    for i in range(1, k + 1):
        term *= mean / i
        total += term
    return max(0.0, 1.0 - total)


def _weak(n: int, segments: int, allocation: int) -> float:
    """Expected number of segments that hold too few of ``n`` elements to count."""
    share = 1 / segments
    none = (1 - share) ** n
    return segments * (none + (n * share * (1 - share) ** (n - 1) if allocation == 2 else 0.0))


def _risk(rule: Rule, segments: int, allocation: int, n: int, hi: int) -> float:
    """Chance that a set of ``n`` elements needs a further seed."""
    spare = segments * allocation - 1 - rule.difference(n + min(hi, rule.partner(n)))
    return _tail(_weak(n, segments, allocation), spare // allocation) if spare >= 0 else 1.0


#: Layouts worked out so far. A plain table, so that functions that use it are pickled by value.
LAYOUTS: dict[tuple, tuple[int, int]] = {}


def layout(rule: Rule, lo: int, hi: int, allocations: tuple[int, ...] = (1, 2)) -> tuple[int, int]:
    """Segments and allocation of the band whose larger sets have ``lo`` to ``hi`` elements: the cheapest
    in entries and chance agreements, further seeds included."""
    key = rule.num, rule.den, lo, hi, allocations
    if key not in LAYOUTS:
        LAYOUTS[key] = _layout(rule, lo, hi, allocations)
    return LAYOUTS[key]


def _layout(rule: Rule, lo: int, hi: int, allocations: tuple[int, ...]) -> tuple[int, int]:
    options, sizes = [], sorted({max(1, lo * rule.num // rule.den), lo, hi})
    for allocation in allocations:
        fewest = -(-(rule.difference(2 * hi) + 1) // allocation)
        for segments in range(fewest, fewest + max(4, fewest // 2), max(1, fewest // 50)):
            risk = max(_risk(rule, segments, allocation, n, hi) for n in sizes)
            held = hi / segments
            agree = CHANCE**held
            if allocation == 2:
                agree += held * CHANCE ** max(held - 1, 0)
            cost = segments + (hi if allocation == 2 else 0) + WEIGHT * segments * agree
            options.append((risk > RISK, risk if risk > RISK else cost / (1 - risk), segments, allocation))
    return min(options)[2:]


def entries(grams: np.ndarray, rule: Rule, level: int = 0) -> np.ndarray:
    """Index entries of one set: for its own band, and for the next one if it can be the smaller there.
    Every level is an index by itself; those above 0 have large segments of allocation 2."""
    n, out = len(grams), []
    if not n or rule.difference(n + rule.partner(n)) == 0:  # only equal sets link
        return grams[:0]
    for band, (lo, hi) in enumerate(band_tops()):
        if hi < n:
            continue
        if rule.partner(n) < lo:
            break
        most = rule.difference(n + min(hi, rule.partner(n)))
        if most:
            segments, allocation = layout(rule, lo, hi, (2,) if level else (1, 2))
            for seed in range(SEEDS):
                found, enough = _entries(grams, (band * LEVELS + level) * SEEDS + seed, segments, allocation, most, seed == SEEDS - 1)
                out.append(found)
                if enough:
                    break
    return np.unique(np.concatenate(out) >> SPARE_BITS) << SPARE_BITS if out else grams[:0]


def _entries(
    grams: np.ndarray, scheme: int, segments: int, allocation: int, most: int, last: bool
) -> tuple[np.ndarray, bool]:
    """Entries of one scheme up to the segment whose filled ones outweigh ``most`` differences, and whether there
    is one; else all entries."""
    with np.errstate(over="ignore"):
        tokens = mix(grams + np.uint64(scheme + 1))
        segment = (tokens >> np.uint64(11)) % np.uint64(segments)
        order = np.argsort(segment, kind="stable")
        segment, tokens = segment[order].astype(np.int64), tokens[order]
        held = np.bincount(segment, minlength=segments)
        used = np.flatnonzero(held)
        sums = np.zeros(segments, np.uint64)
        sums[used] = np.add.reduceat(tokens, (np.cumsum(held) - held)[used])
        label = mix(np.arange(segments, dtype=np.uint64) + (np.uint64(scheme) << np.uint64(40)))
        empty = held < allocation
        outweighed = np.flatnonzero(allocation * np.cumsum(~empty) > most)
        enough = len(outweighed) > 0
        end = int(outweighed[0]) + 1 if enough else segments
        used = used[used < end]
        parts = [mix(sums[used] + label[used])]
        if allocation == 2:
            drop = (held[segment] > 1) & (segment < end)
            parts.append(mix((sums[segment] - tokens + label[segment])[drop]))
        if last and not enough:
            parts.append(mix(label[empty]))
    return np.concatenate(parts), enough


def parts_of(grams: np.ndarray, parts: int = PARTS) -> np.ndarray:
    """Sizes of a fixed division of the set; the sum of the smaller ones bounds an intersection. Sets too
    large for the sizes' two bytes have none."""
    if len(grams) > 32767 or not parts:
        return np.zeros(0, np.int16)
    return np.bincount((mix(grams) >> np.uint64(20)).astype(np.int64) % parts, minlength=parts).astype(np.int16)


def odd_parts(grams: np.ndarray, parts: int = FINE_PARTS) -> np.ndarray:
    """Which parts of the finer division hold an odd number of elements, as bits of 64-bit words. Two sets differ in
    at least as many elements as they differ in bits."""
    held = np.bincount((mix(grams) >> np.uint64(20)).astype(np.int64) % parts, minlength=parts)
    return np.packbits((held & 1).astype(np.uint8), bitorder="little").view(np.int64)


def signature(grams: np.ndarray) -> np.ndarray:
    """The odd parts of a division that grows with the set, by powers of two: two bits for an element at least, so
    that a long set's differences show too."""
    return odd_parts(grams, max(FINE_PARTS, 1 << (2 * len(grams) - 1).bit_length()))


def folded(odd: np.ndarray, words: int) -> np.ndarray:
    """A signature as that of a smaller division of ``words`` 64-bit words."""
    return np.bitwise_xor.reduce(odd.reshape(-1, words), axis=0)


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    part, start, size = [], 0, 0
    for i, x in enumerate(texts):
        part.append(x or "")
        size += len(part[-1])
        if size >= CHUNK:
            yield start, part
            part, start, size = [], i + 1, 0
    if part:
        yield start, part


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat).cast(kind))


def index_batches(rule: Rule):
    for lo, hi in itertools.takewhile(lambda band: band[1] <= KNOWN, band_tops()):
        if rule.difference(2 * hi):
            layout(rule, lo, hi)  # travels with the function

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in _chunks(batch["text"].to_pylist()):
                sets = gram_sets(texts, rule.words)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch["doc_id"].slice(start, len(texts)),
                        "n": pa.array([len(s) for s in sets], pa.int64()),
                        "digest": pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                        "entries": _lists([entries(s, rule).view(np.int64) for s in sets], pa.int64()),
                    }
                )

    return lean(run)


def set_batches(rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in _chunks(batch["text"].to_pylist()):
                sets = gram_sets(texts, rule.words)
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": batch["doc_id"].slice(start, len(texts)),
                        "n": pa.array([len(s) for s in sets], pa.int64()),
                        "parts": _lists([parts_of(s) for s in sets], pa.int16()),
                        "fine": _lists([parts_of(s, FINE_PARTS if len(s) >= FINE_FROM else 0) for s in sets], pa.int16()),
                        "odd": _lists([odd_parts(s) for s in sets], pa.int64()),
                        "grams": _lists([s.view(np.int64) for s in sets], pa.int64()),
                    }
                )

    return lean(run)


def level_batches(rule: Rule, level: int, share: int = 0, shares: int = 1):
    """The entries of a level, or one of several shares of them: an entry is in the same share for every set."""

    def some(found: np.ndarray) -> np.ndarray:
        return found if shares == 1 else found[(found >> SPARE_BITS) % np.uint64(shares) == share]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.asarray(x.values).view(np.uint64) for x in batch["grams"]]
            found = _lists([some(entries(s, rule, level)).view(np.int64) for s in sets], pa.int64())
            yield pa.RecordBatch.from_pydict({"doc_id": batch["id"], "entries": found})

    return lean(run)


def signature_batches():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [signature(np.asarray(x.values).view(np.uint64)) for x in batch["grams"]]
            yield pa.RecordBatch.from_pydict({"id": batch["id"], "n": batch["n"], "odd": _lists(found, pa.int64())})

    return lean(run)


# --- join -----------------------------------------------------------------------------


def of_pairs(sets: DataFrame, pairs: DataFrame, *sides: str) -> DataFrame:
    """The rows of ``sets`` whose documents are on the given sides of stored ``pairs``. Rows of sets stay where
    they are while the pairs are few."""
    ids = [pairs.select(F.col(side).alias("id")) for side in sides]
    return sets.join(hinted(ids[0] if len(ids) == 1 else ids[0].union(ids[1])), "id", "left_semi")


def plausible(pairs: DataFrame, most: int, sets: DataFrame, rule: Rule, parts: str = "parts") -> DataFrame:
    """The pairs ``a, b``, at most ``most``, that sizes and part sizes do not rule out (sets without parts pass)."""
    a = sets.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col(parts).alias("pa"))
    b = sets.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col(parts).alias("pb"))
    # An id may have several texts, so that a pair is met several times; the bound only counts partitions.
    met = fitted(fitted(pairs.join(a, "a"), most, PAIRS).join(b, "b"), most, PAIRS)
    small, large = F.least("na", "nb"), F.greatest("na", "nb")
    shared = F.zip_with("pa", "pb", lambda x, y: F.coalesce(F.least(x, y), F.lit(0)))
    both = F.aggregate(shared, F.lit(0).cast("long"), lambda s, x: s + x)
    both = F.when((F.size("pa") == 0) | (F.size("pb") == 0), small).otherwise(both)
    met = met.filter(small * rule.den >= large * rule.num)
    met = met.withColumn("both", both).filter(F.col("both") * rule.den >= (F.col("na") + F.col("nb") - F.col("both")) * rule.num)
    return met.select("a", "b")


def few_differences(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs ``a, b`` whose odd parts differ in no more bits than linked sets of their sizes do."""
    a = sets.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("odd").alias("oa"))
    b = sets.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("odd").alias("ob"))
    met = b.join(hinted(pairs), "b").join(a, "a")
    bits = F.zip_with("oa", "ob", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    differ = F.aggregate(bits, F.lit(0).cast("long"), lambda s, x: s + x)
    return met.filter(differ * (rule.den + rule.num) <= (F.col("na") + F.col("nb")) * (rule.den - rule.num)).select("a", "b")


def verified(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The stored pairs ``a, b`` whose sets link. Few pairs go to the sets of ``b``; what then moves is a set for each
    pair, and the sets of ``a`` once."""
    a = of_pairs(sets, pairs, "a").select(F.col("id").alias("a"), F.col("grams").alias("ga"))
    b = sets.select(F.col("id").alias("b"), F.col("grams").alias("gb"))
    met = b.join(hinted(pairs), "b").join(a, "a")
    met = met.withColumn("both", F.size(F.array_intersect("ga", "gb")).cast("long"))
    union = F.size("ga") + F.size("gb") - F.col("both")
    return met.filter(F.col("both") * rule.den >= union * rule.num).select("a", "b")


def apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose documents are in different components so far."""
    a = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    b = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    met = pairs.join(hinted(a), "a", "left").join(hinted(b), "b", "left")
    return met.filter(F.coalesce("la", "a") != F.coalesce("lb", "b")).select("a", "b")


def untried(pairs: DataFrame, tried: DataFrame) -> DataFrame:
    """The pairs ``a, b`` that are not among the stored ``tried`` ones."""
    return pairs.join(hinted(tried), ["a", "b"], "left_anti")


def link_all(pairs: DataFrame, most: int, sets: DataFrame, labels: DataFrame, rule: Rule) -> DataFrame:
    """The components grown by the links among ``pairs``, of which there are at most ``most``.

    A first pass tries each document with one partner only, which joins most groups; the second tries
    whatever other pairs still lie in different components. Of many pairs a part is tried at a time, since a set
    moves for each.
    """
    with temporary() as temp:
        pairs = temp(plausible(pairs, most, sets, rule), "plausible")
        most = pairs.count()
        if not most:
            return labels
        # Odd parts tell most sets of some hundred elements; long documents need the sizes of a finer division.
        pairs = temp(fitted(few_differences(pairs, of_pairs(sets, pairs, "a", "b"), rule), most, PAIRS), "close")
        most = pairs.count()
        if not most:
            return labels
        pairs = temp(plausible(pairs, most, of_pairs(sets, pairs, "a", "b"), rule, "fine"), "finer")
        for one_each in (True, False):
            if pairs.isEmpty():
                break
            tried = temp(fitted(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), most), "tried") if one_each else pairs
            parts = -(-most // min(BROADCAST_ROWS, max(ROWS, sets.count() // 4))) if most > ROWS else 1
            for part in range(parts):
                some = tried
                if parts > 1:
                    some = temp(fitted(apart(tried.filter(F.pmod(F.xxhash64("a", "b"), F.lit(parts)) == part), labels), most), "part")
                labels = grown(labels, fitted(verified(some, sets, rule), most, WHOLE))
            pairs = temp(fitted(apart(untried(pairs, tried), labels), most), "apart") if one_each else pairs
        return labels


def grown(labels: DataFrame, more: DataFrame) -> DataFrame:
    """The components of stored ``labels`` joined by further links; the labels given are dropped if there are any."""
    with temporary() as temp:
        more = temp(more, "linked")
        if more.isEmpty():
            return labels
        known = labels.select(F.col("label").alias("a"), F.col("node").alias("b"))
        found = components(known.union(more.select("a", "b")), kept=True)
        release(labels)
        return found


def gram_tables(docs: DataFrame, ids: DataFrame, rule: Rule) -> DataFrame:
    """``id, n, parts, grams`` of the documents in the stored ``ids``, and perhaps of some others, from their texts,
    as a stored table."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    chosen = among(docs, ids, "doc_id")
    return stored(chosen.mapInArrow(set_batches(rule), f"id {kind}, n long, parts array<short>, fine array<short>, odd array<long>, grams array<long>"), "sets")


def similar_groups(df: DataFrame, rule: Rule, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row.

    ``component_id`` is the smallest id reachable by links. Null and empty texts have no n-grams and
    link with nothing. Rows with the same id are one document: it links where any of them does.
    A null id takes part in no link and has a null component. Repeated rows give repeated results;
    other columns are not read; an empty table gives an empty result.

    A first round over each set's ``FEW`` smallest entries joins most groups of near copies. The round
    over all entries then keeps only buckets that hold several components, so such groups do not
    come back in each of their many buckets. Buckets of more than ``CROWD`` documents, such as those of
    a passage that many documents quote, are not compared: their documents are indexed again at the
    next level, which is complete by itself, with large segments that such a passage seldom fills. What
    is crowded there too, clouds of documents just short of similar, is compared in blocks.
    """
    spark = df.sparkSession
    small_batches(spark)
    docs = reading(df, doc_id=doc_id, text=text)
    kind = docs.schema["doc_id"].dataType.simpleString()
    index = docs.mapInArrow(index_batches(rule), f"doc_id {kind}, n long, digest binary, entries array<long>")
    index = stored(index, "index")
    known, total = index.filter("doc_id is not null and digest is not null"), index.count()
    grams = known.agg(F.sum("n")).first()[0] or 0
    reps = materialize(fitted(known.groupBy("digest").agg(F.min("doc_id").alias("id")), total), "reps")
    labels = components(fitted(same_document(known, reps), total))
    with temporary() as temp:
        few = known.select("doc_id", "digest", F.slice("entries", 1, FEW).alias("entries"))
        copies = known.select("doc_id", "digest").join(reps, "digest").filter("doc_id <> id")
        copies = hinted(temp(fitted(copies.select("doc_id", "digest").distinct(), total), "copies"))
        near = shared_entries(few.join(copies, ["doc_id", "digest"], "left_anti"), labels)
        near = temp(fitted(near, FEW * total), "near")
        most = near.count()
        ids = temp(fitted(near.select(F.col("id").alias("doc_id")).distinct(), min(most, total)), "ids")
        first = sets = gram_tables(docs, ids, rule)
        pairs = near.filter("id <> pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct()
        labels = link_all(fitted(pairs, most), most, sets, labels, rule)

        rows = known.select("doc_id", "digest", "entries").join(copies, ["doc_id", "digest"], "left_anti")
        members = stored(shared_entries(rows, labels), "members")
        # Of the index only what the result needs stays; the entries are most of it.
        out = materialize(index.select("doc_id", "n", "digest"), "documents")
        release(index)
        more = members.select(F.col("id").alias("doc_id")).distinct().join(ids, "doc_id", "left_anti")
        second = gram_tables(docs, temp(fitted(more, total), "more"), rule)
        sets = first.unionByName(second)
        sizes = sets.groupBy("id").agg(F.min("n").alias("low"), F.max("n").alias("high"))  # an id may have several texts
        sizes = temp(fitted(sizes, total), "sizes")
        for level in range(1, LEVELS + 1):
            labels = settle(members.filter(F.col("bucket.held") <= CROWD), sets, sizes, labels, rule)
            crowded = members.filter(F.col("bucket.held") > CROWD).select("pivot", "id")
            crowded = temp(fitted(crowded, crowded.count()), "crowded")
            release(members)
            if crowded.isEmpty():
                break
            if level == LEVELS:
                labels = crowd_links(crowded, sets, labels, rule)
            else:
                again = temp(fitted(crowded.select("id").distinct(), total), "again")
                members = further_members(again, level, grams, sets, labels, rule)
        release(first, second)

    found = reps.join(labels, reps["id"] == labels["node"], "left")
    found = materialize(fitted(found.select("digest", F.coalesce("label", "id").alias("component")), total), "found")
    release(labels)
    out = out.join(found, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def further_members(again: DataFrame, level: int, grams: int, sets: DataFrame, labels: DataFrame, rule: Rule) -> DataFrame:
    """The stored :func:`shared_entries` of a further level, on which the documents of ``again``, and perhaps some
    others of ``sets``, are indexed; the whole table has ``grams`` n-grams. Their many entries are moved in shares."""
    kind = sets.schema["id"].dataType.simpleString()
    rows = among(sets.select("id", "n", "grams"), again, "id")
    load = PER_GRAM * (rows.agg(F.sum("n")).first()[0] or 0)
    shares = max(1, math.ceil(load / max(SHARE, grams / 4)))
    with temporary() as temp:
        found = []
        for share in range(shares):
            some = rows.select("id", "grams").mapInArrow(level_batches(rule, level, share, shares), f"doc_id {kind}, entries array<long>")
            found.append((temp if shares > 1 else stored)(shared_entries(some, labels), "members"))
        if shares == 1:
            return found[0]
        return stored(functools.reduce(DataFrame.union, found).distinct(), "members")


def block_pairs(rule: Rule):
    """The pairs ``a < b`` of documents of two blocks (or of one) that sizes and signatures do not rule out, of
    different components."""

    def run(table: pa.Table) -> pa.Table:
        ids = table["id"].combine_chunks()
        label = table["label"].combine_chunks().dictionary_encode().indices.to_numpy()
        block, n = table["block"].to_numpy(), table["n"].to_numpy()
        rank = np.empty(len(n), np.int64)
        rank[pc.sort_indices(ids).to_numpy()] = np.arange(len(n))
        odd = [np.asarray(x.values).view(np.uint64) for x in table["odd"]]
        words, crossed, found = np.array([len(x) for x in odd]), block.min() != block.max(), []
        for width in np.unique(words):
            # Two signatures are compared in the division of the smaller one.
            rows = np.flatnonzero(words >= width)
            rows = rows[np.argsort(n[rows], kind="stable")]
            sizes, matrix = n[rows], np.stack([folded(odd[i], width) for i in rows])
            own, at = np.flatnonzero(words[rows] == width), 0
            while at < len(own):
                low, high = np.searchsorted(sizes, [-(-sizes[own[at]] * rule.num // rule.den), rule.partner(sizes[own[at]]) + 1])
                some = own[at : at + max(1, BLOCK_WORDS // int((high - low) * width))]
                at += len(some)
                high = np.searchsorted(sizes, rule.partner(sizes[some[-1]]) + 1)
                i, j = rows[some][:, None], rows[low:high][None]
                differ = np.bitwise_count(matrix[some][:, None] ^ matrix[None, low:high]).sum(2, dtype=np.int64)
                near = differ * (rule.den + rule.num) <= (n[i] + n[j]) * (rule.den - rule.num)
                near &= np.minimum(n[i], n[j]) * rule.den >= np.maximum(n[i], n[j]) * rule.num
                near &= (label[i] != label[j]) & ((words[j] > width) | (rank[i] < rank[j]))
                if crossed:
                    near &= block[i] != block[j]
                x, y = np.nonzero(near)
                found.append(np.stack([rows[some][x], rows[low:high][y]]))
        pairs = np.concatenate(found, axis=1)
        turned = rank[pairs[0]] > rank[pairs[1]]
        out = pa.table({"a": ids.take(pa.array(np.where(turned, pairs[1], pairs[0]))), "b": ids.take(pa.array(np.where(turned, pairs[0], pairs[1])))})
        del odd, found, pairs
        give_back()
        return out

    return run


def crowd_links(crowded: DataFrame, sets: DataFrame, labels: DataFrame, rule: Rule) -> DataFrame:
    """The components after joining all linked documents which share a crowded bucket.

    Documents that crowded buckets tie together are dealt to blocks of bounded size; every two blocks
    meet in one task, which compares their signatures, so that of a document a few bytes an n-gram move once
    per block of its crowd. Only pairs that signatures do not rule out are tried on whole sets. Block pairs
    are met in rounds, as many at a time as move about the bytes of ``sets``.
    """
    clouds = components(crowded.select(F.col("pivot").alias("a"), F.col("id").alias("b")), kept=True)
    most = clouds.count()
    kind = sets.schema["id"].dataType.simpleString()
    with temporary() as temp:
        rows = clouds.select(F.col("node").alias("id"), F.col("label").alias("cloud")).alias("c")
        rows = rows.join(labels, F.col("c.id") == labels["node"], "left").select("id", "cloud", F.coalesce("label", "id").alias("label"))
        rows = rows.join(sets.select("id", "n"), "id")
        dense = rows.groupBy("cloud").agg(
            F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_DOCS), F.ceil(F.sum("n") / BLOCK_GRAMS)).alias("blocks"),
            F.min("label").alias("x"),
            F.max("label").alias("y"),
        ).filter("x < y")
        rows = clouds.select(F.col("node").alias("id"), F.col("label").alias("cloud")).join(temp(fitted(dense.select("cloud", "blocks"), most), "dense"), "cloud")
        rows = rows.select("id", "cloud", "blocks", F.pmod(F.xxhash64("id"), "blocks").alias("block"))
        dealt = temp(fitted(rows, most), "dealt")
        blocks, most = dealt.agg(F.max("blocks"), F.count(F.lit(1))).first()
        if most:
            found = among(sets.select("id", "n", "grams"), dealt.select("id"), "id")
            found = found.mapInArrow(signature_batches(), f"id {kind}, n long, odd array<long>")
            found = temp(found.join(hinted(dealt), "id"), "signatures")
            each = max(1, 8 * sets.count() // most)  # a signature is about a tenth of its set
            for start in range(0, blocks, each):
                labels = link_blocks(found, start, start + each, sets, labels, rule)
    release(clouds)
    return labels


def link_blocks(dealt: DataFrame, start: int, end: int, sets: DataFrame, labels: DataFrame, rule: Rule) -> DataFrame:
    """The components grown by the links between blocks of one cloud whose numbers differ by ``start`` to ``end - 1``."""
    kind = sets.schema["id"].dataType.simpleString()
    with temporary() as temp:
        rows = dealt.join(hinted(labels), dealt["id"] == labels["node"], "left")
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
        rows = rows.select("id", F.coalesce("label", "id").alias("label"), "n", "odd", "cloud", "block", other)
        rows = rows.filter(F.abs(F.col("block") - F.col("other")).between(start, end - 1))
        rows = rows.withColumns({"x": F.least("block", "other"), "y": F.greatest("block", "other")}).drop("other")
        pairs = rows.groupBy("cloud", "x", "y").applyInArrow(block_pairs(rule), f"a {kind}, b {kind}")
        pairs = temp(pairs.distinct(), "between")
        most = pairs.count()
        return link_all(pairs, most, sets, labels, rule) if most else labels


def settle(members: DataFrame, sets: DataFrame, sizes: DataFrame, labels: DataFrame, rule: Rule) -> DataFrame:
    """The components after trying all pairs that lie in one bucket of at most ``CROWD`` documents
    and in different components. ``sizes``, a stored table, has the least and largest set of each id."""
    with temporary() as temp:
        rows = unresolved(members.select("bucket", "id"), labels)
        rows = temp(fitted(rows.join(hinted(sizes), "id"), members.count()), "rows")
        most = rows.agg(F.sum(F.col("bucket.held") - 1)).first()[0]
        return link_all(between(rows, most // 2, rule), most // 2, sets, labels, rule) if most else labels


def moved_entries(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``entry, id, label``, a row for each entry, dealt by entry: most of what the join writes to disk. Nothing else
    moves; a window alone would move what it computes from a row as well, such as the hash of its id. An entry's
    varying bytes stand next to those of the id, and a label that is the id itself is left out (null), so that
    compression leaves little more of a row than them."""
    rows = rows.join(hinted(labels), rows["doc_id"] == labels["node"], "left")
    rows = rows.select("doc_id", F.when(F.col("label") != F.col("doc_id"), F.col("label")).alias("label"), F.explode("entries").alias("entry"))
    return rows.select("entry", F.col("doc_id").alias("id"), "label").repartition("entry")


def shared_entries(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``bucket, pivot, id`` of the entries that several components share; ``pivot`` is the least id of
    the bucket. Buckets with the same documents are one bucket."""
    rows = moved_entries(rows, labels)
    bucket, label = Window.partitionBy("entry"), F.coalesce("label", "id")
    rows = rows.select(
        "id",
        F.min(label).over(bucket).alias("x"),
        F.max(label).over(bucket).alias("y"),
        F.min("id").over(bucket).alias("pivot"),
        F.count("id").over(bucket).alias("held"),
        F.bit_xor(F.xxhash64("id")).over(bucket).alias("mark"),
    ).filter("x < y")
    rows = rows.groupBy("pivot", "held", "mark", "id").agg(F.count(F.lit(1)).alias("_"))
    return rows.select(F.struct("pivot", "held", "mark").alias("bucket"), "pivot", "id")


def unresolved(members: DataFrame, labels: DataFrame) -> DataFrame:
    """``bucket, id, label`` of the rows of buckets that hold more than one component."""
    rows = members.join(hinted(labels), members["id"] == labels["node"], "left")
    rows = rows.select("bucket", "id", F.coalesce("label", "id").alias("label"))
    bucket = Window.partitionBy("bucket")
    rows = rows.withColumns({"x": F.min("label").over(bucket), "y": F.max("label").over(bucket)})
    return rows.filter("x <> y").select("bucket", "id", "label")


def between(rows: DataFrame, most: int, rule: Rule) -> DataFrame:
    """Pairs ``a < b``, at most ``most``, of documents of one bucket in different components whose sizes may link."""
    own = {"id": "{}", "label": "l{}", "low": "low{}", "high": "high{}"}
    a = rows.select("bucket", *(F.col(c).alias(name.format("a")) for c, name in own.items()))
    b = rows.select(F.col("bucket").alias("other"), *(F.col(c).alias(name.format("b")) for c, name in own.items()))
    near = (F.col("higha") * rule.den >= F.col("lowb") * rule.num) & (F.col("highb") * rule.den >= F.col("lowa") * rule.num)
    met = a.join(b, (F.col("bucket") == F.col("other")) & (F.col("a") < F.col("b")) & (F.col("la") != F.col("lb")) & near)
    return fitted(fitted(met.select("a", "b"), most).distinct(), most)


def same_document(known: DataFrame, reps: DataFrame) -> DataFrame:
    """Links between the representatives of different texts under one id."""
    several = known.groupBy("doc_id").agg(F.min("digest").alias("x"), F.max("digest").alias("y")).filter("x <> y")
    rows = known.select("doc_id", "digest").join(several.select("doc_id"), "doc_id").join(reps, "digest")
    return rows.select(F.col("id").alias("a"), F.col("doc_id").alias("b")).filter("a <> b").distinct()
