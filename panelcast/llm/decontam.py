"""Benchmark decontamination with an FM-index per training shard.

A shard is a batch of documents. Its words become numbers; runs of words that the test phrases use, at
least as long as the shortest phrase, form the shard's text (no other word can lie in an occurrence).
Its suffix array gives the Burrows-Wheeler transform, kept as a wavelet matrix, and every ``SAMPLE``-th
text position. All phrases are searched backward together; occurrences are located by walking to the
next sampled position, and overlapping ones are merged to removal spans.

Phrases, the windows of ``window`` words of each item, are taken in blocks of about ``BLOCK_ROWS`` rows
by hash. Each block is broadcast; a shard searches block after block, so memory is bounded by one block
and one batch of documents, however large the benchmark is.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import Blocks, lean, materialize, reading, shipped, small_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 13
SAMPLE = 8
BLOCK_ROWS = 200_000
CHUNK = 8_000_000
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
# A-Z to a-z; every other byte that cannot be in a word to a space.
SPACED = bytes(
    c + 32 if 0x41 <= c <= 0x5A else 0x20 if c <= 0x2F or 0x3A <= c <= 0x60 or 0x7B <= c <= 0x7F else c
    for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(SPACED).split()


# --- index ----------------------------------------------------------------------------


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes by prefix doubling; a suffix that ends sorts before its extensions."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64) + 1
    step = 1
    while True:
        following = np.zeros(n, np.int64)
        following[: n - step] = rank[step:]
        key = rank * (n + 2) + following
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        fresh = np.empty(n, np.int64)
        fresh[order] = np.cumsum(np.concatenate([[1], ordered[1:] != ordered[:-1]]))
        rank, step = fresh, step * 2
        if step >= n or rank[order[-1]] == n:
            return order


class Wavelet:
    """Rank and access on a sequence of numbers, one bit vector per bit, for arrays of queries."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max()).bit_length())
        self.ones, self.zeros = [], []
        for bit in reversed(range(self.bits)):
            one = (values >> bit) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(one)]).astype(np.int32))
            self.zeros.append(len(values) - int(self.ones[-1][-1]))
            values = np.concatenate([values[one == 0], values[one == 1]])

    def rank(self, value: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each value stands before each end."""
        begin = np.zeros_like(end)
        for level, bit in enumerate(reversed(range(self.bits))):
            ones, one = self.ones[level], ((value >> bit) & 1).astype(bool)
            begin = np.where(one, self.zeros[level] + ones[begin], begin - ones[begin])
            end = np.where(one, self.zeros[level] + ones[end], end - ones[end])
        return end - begin

    def access(self, at: np.ndarray) -> np.ndarray:
        value = np.zeros_like(at)
        for level in range(self.bits):
            ones = self.ones[level]
            one = ones[at + 1] - ones[at]
            value = value * 2 + one
            at = np.where(one == 1, self.zeros[level] + ones[at], at - ones[at])
        return value


class FMIndex:
    """Backward search and location in a text of positive numbers and zeros (separators)."""

    def __init__(self, text: np.ndarray):
        text = np.append(text + 1, 0)  # an end that is unlike everything else
        order = suffix_array(text)
        self.n = len(text)
        before = text[order - 1]
        self.bwt = Wavelet(before.astype(np.int64))
        counts = np.bincount(before)
        self.first = np.cumsum(counts) - counts
        marked = order % SAMPLE == 0
        self.marks = np.concatenate([[0], np.cumsum(marked)]).astype(np.int64)
        self.places = order[marked]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of the phrases (right-aligned rows of numbers)."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for step in range(phrases.shape[1]):
            live = np.flatnonzero((lengths > step) & (low < high))
            if not len(live):
                break
            value = phrases[live, -1 - step] + 1
            inside = value < len(self.first)
            high[live[~inside]] = low[live[~inside]]
            live, value = live[inside], value[inside]
            start = self.first[value]
            low[live], high[live] = start + self.bwt.rank(value, low[live]), start + self.bwt.rank(value, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of the suffixes in these rows."""
        out, todo, steps = np.empty(len(rows), np.int64), np.arange(len(rows)), 0
        at = rows.astype(np.int64)
        while len(todo):
            marked = self.marks[at + 1] > self.marks[at]
            out[todo[marked]] = self.places[self.marks[at[marked]]] + steps
            todo, at = todo[~marked], at[~marked]
            value = self.bwt.access(at)
            at = self.first[value] + self.bwt.rank(value, at)
            steps += 1
        return out


# --- search ---------------------------------------------------------------------------


class Block:
    """Some test phrases with the items they belong to."""

    def __init__(self, rows: list[tuple[bytes, object]]):
        phrases: dict[bytes, list] = {}
        for phrase, item in rows:
            phrases.setdefault(phrase, []).append(item)
        split = [p.split(b" ") for p in phrases]
        self.vocabulary: dict[bytes, int] = {}
        for words in split:
            for w in words:
                self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
        self.lengths = np.array([len(words) for words in split], np.int64)
        self.shortest = int(self.lengths.min()) if split else 0
        self.phrases = np.zeros((len(split), int(self.lengths.max()) if split else 1), np.int64)
        for i, words in enumerate(split):
            self.phrases[i, len(self.phrases[i]) - len(words) :] = [self.vocabulary[w] for w in words]
        self.items = list(phrases.values())

    def occurrences(self, docs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, first word and phrase of every occurrence."""
        none = np.zeros(0, np.int64)
        sizes = np.array([len(d) for d in docs], np.int64)
        if not self.shortest or not sizes.sum():
            return none, none, none
        found = self.vocabulary.get
        # A zero between documents keeps runs apart.
        numbers = np.zeros(int(sizes.sum()) + len(docs) + 1, np.int64)
        starts = np.cumsum(sizes + 1) - sizes
        for start, words in zip(starts.tolist(), docs, strict=True):
            numbers[start : start + len(words)] = np.fromiter(map(found, words, repeat(0)), np.int64, len(words))
        edges = np.diff((numbers > 0).astype(np.int8))
        begin, end = np.flatnonzero(edges == 1) + 1, np.flatnonzero(edges == -1) + 1
        if len(end) < len(begin):
            end = np.append(end, len(numbers))
        long = end - begin >= self.shortest
        begin, end = begin[long], end[long]
        if not len(begin):
            return none, none, none
        held = end - begin + 1  # a run and the zero after it
        offsets = np.cumsum(held) - held
        back = np.arange(int(held.sum())) + np.repeat(begin - offsets, held)
        text = numbers[np.minimum(back, len(numbers) - 1)]
        text[offsets + held - 1] = 0
        index = FMIndex(text)
        low, high = index.search(self.phrases, self.lengths)
        times = high - low
        phrase = np.repeat(np.arange(len(times)), times)
        rows = np.arange(len(phrase)) + np.repeat(low - (np.cumsum(times) - times), times)
        place = back[index.locate(rows)]
        doc = np.searchsorted(starts, place, side="right") - 1
        return doc, place - starts[doc], phrase


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], end)
        else:
            out.append((start, end))
    return out


def code_points(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of words as spans of code points."""
    at = [m.span() for m in WORD.finditer(text.translate(LOWER))]
    return [(at[a][0], at[b - 1][1]) for a, b in spans]


LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def search_batches(blocks: list, fields: list[str], kind: pa.DataType):
    """``blocks`` are broadcast variables; a batch is searched for one block after the other."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Blocks(blocks)
        for batch in batches:
            for start, texts in chunks(batch["text"].to_pylist()):
                docs = [words_of(x) for x in texts]
                spans: list[list] = [[] for _ in docs]
                items: list[set] = [set() for _ in docs]
                for block in held:
                    doc, first, phrase = block.occurrences(docs)
                    ends = first + block.lengths[phrase]
                    for d, a, b in zip(doc.tolist(), first.tolist(), ends.tolist(), strict=True):
                        spans[d].append((a, b))
                    pairs = np.unique(doc * len(block.items) + phrase)
                    for pair in pairs.tolist():
                        d, p = divmod(pair, len(block.items))
                        items[d].update(block.items[p])
                joined = [merged(s) for s in spans]
                removal = [code_points(x, s) if s else [] for x, s in zip(texts, joined, strict=True)]
                rows = {f: batch[f].slice(start, len(texts)) for f in fields}
                rows["n_words"] = pa.array([len(d) for d in docs], pa.int64())
                rows["n_hit"] = pa.array([sum(b - a for a, b in s) for s in joined], pa.int64())
                rows["items"] = pa.array([sorted(s) for s in items], pa.list_(kind))
                rows["spans"] = pa.array([[{"start": a, "end": b} for a, b in s] for s in removal], span)
                yield pa.RecordBatch.from_pydict(rows)

    return lean(run)


def chunks(texts: list[str | None]) -> Iterator[tuple[int, list[str | None]]]:
    start, size = 0, 0
    for i, x in enumerate(texts):
        size += len(x or "")
        if size >= CHUNK:
            yield start, texts[start : i + 1]
            start, size = i + 1, 0
    if start < len(texts):
        yield start, texts[start:]


def window_batches(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            phrases, items = [], []
            for item, text in zip(batch["item_id"], batch["text"].to_pylist(), strict=True):
                words = words_of(text)
                for i in range(max(len(words) - window + 1, min(1, len(words)))):
                    phrases.append(b" ".join(words[i : i + window]))
                    items.append(item)
            yield pa.RecordBatch.from_pydict(
                {"phrase": pa.array(phrases, pa.binary()), "item_id": pa.array([x.as_py() for x in items], batch["item_id"].type)}
            )

    return run


def phrase_blocks(items: DataFrame, window: int = WINDOW) -> list:
    """Broadcast blocks of the phrases of ``item_id, text``; one block at a time is on the driver."""
    spark = items.sparkSession
    kind = items.schema["item_id"].dataType.simpleString()
    items = items.filter("item_id is not null")
    rows = items.mapInArrow(window_batches(window), f"phrase binary, item_id {kind}").distinct()
    rows = materialize(rows, "phrases")
    count = -(-rows.count() // BLOCK_ROWS)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("phrase"), F.lit(max(count, 1))))
    blocks = []
    for i in range(count):
        found = rows.filter(F.col("block") == i).select("phrase", "item_id").collect()
        blocks.append(shipped(spark, Block([(bytes(p), item) for p, item in found])))
    return blocks


def contamination(
    df: DataFrame, benchmark: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``doc_id, n_words, n_hit, items, spans`` of every row (and the columns in ``keep``).

    ``n_hit`` counts words inside any occurrence, ``items`` the sorted ids of items with occurring
    windows, ``spans`` the merged occurrences in code points (end exclusive). An item with fewer words
    than a window, but not none, is one window. Null and empty texts have no words and no hits; items
    with a null id are ignored; an empty benchmark gives no hits; repeated rows give repeated results.
    """
    small_batches(df.sparkSession)
    items = reading(benchmark, item_id="item_id", text="text")
    kind = items.schema["item_id"].dataType
    columns = {"doc_id": doc_id, "text": text} | {c: c for c in keep or []}
    rows = reading(df, **columns)
    fields = [c for c in rows.columns if c != "text" or "text" in (keep or [])]
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in fields)
    arrow = pa.int64() if kind.simpleString() == "bigint" else pa.int32() if kind.simpleString() == "int" else pa.string()
    out = f"{schema}, n_words long, n_hit long, items array<{kind.simpleString()}>, spans array<struct<start:long,end:long>>"
    return rows.mapInArrow(search_batches(phrase_blocks(items, window), fields, arrow), out)


def is_contaminated(n_words: Column, n_hit: Column) -> Column:
    """At least a twentieth of the words, and one at least, lies in an occurrence."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def report(found: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of a contamination table."""
    names = F.sort_array(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
        is_contaminated(F.col("n_words"), F.col("n_hit")).alias("contaminated"),
    )
