"""Token counts that follow edits, by a segment tree over each document's pre-tokens.

The tokenizer splits a text to pre-tokens, each encoded by itself, so a count is a sum over pre-tokens.
A tree's leaves hold up to ``LEAF`` consecutive pre-tokens as numbers of characters and of tokens; inner
nodes hold sums. An edit descends to the leaf it starts in, splits again from a few pre-tokens earlier
(the pattern looks ahead over at most the next two) until, past the edit, a pre-token ends where an old
leaf ended: from there the old pre-tokens stand. Only that region is encoded, its leaves get the new
numbers and the sums above them are updated.

Trees are stored as two arrays per document: node ``i`` has the children ``2i`` and ``2i + 1``, the last
half of the nodes being the leaves.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import materialize, reading, small_batches
from panelcast.llm.packing import encoding

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAF, CROWDED = 64, 256
CONTEXT = 4
CACHED = 500_000


class Counter:
    """Pre-tokens of a text and the number of tokens in each, with the ones met so far kept."""

    def __init__(self, vocabulary: str | None = None):
        import public_tokenizers
        import regex

        self.encoder, self.pattern = encoding(vocabulary), regex.compile(public_tokenizers.PATTERN)
        self.known: dict[str, int] = {}

    def numbers(self, pieces: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > CACHED:
            known.clear()
        for x in pieces:
            if x not in known:
                known[x] = len(self.encoder.encode_ordinary(x))
        return np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))


class Tree:
    """Characters and tokens of runs of pre-tokens, with their sums."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray):
        self.chars, self.tokens = chars, tokens
        self.leaves = len(chars) // 2

    @classmethod
    def of_leaves(cls, chars: np.ndarray, tokens: np.ndarray) -> Tree:
        n = 1 << max(0, len(chars) - 1).bit_length()
        nodes = np.zeros((2, 2 * n), np.int64)
        nodes[:, n : n + len(chars)] = chars, tokens
        level = n
        while level > 1:
            level //= 2
            nodes[:, level : 2 * level] = nodes[:, 2 * level : 4 * level].reshape(2, level, 2).sum(axis=2)
        return cls(*nodes)

    @classmethod
    def of_text(cls, text: str, counter: Counter) -> Tree:
        pieces = counter.pattern.findall(text)
        return cls.of_leaves(*grouped(pieces, counter))

    @property
    def total(self) -> int:
        return int(self.tokens[1])

    def leaf_at(self, position: int) -> tuple[int, int]:
        """The leaf that holds a position (the last one beyond the end) and where it starts."""
        node, start = 1, 0
        while node < self.leaves:
            node *= 2
            if position >= start + self.chars[node] and self.chars[node + 1]:
                start += int(self.chars[node])
                node += 1
        return node - self.leaves, start

    def replace(self, first: int, last: int, chars: np.ndarray, tokens: np.ndarray) -> None:
        """New numbers for the leaves ``first`` to ``last``, and the sums above them."""
        low, high = first + self.leaves, last + self.leaves
        self.chars[low : high + 1], self.tokens[low : high + 1] = chars, tokens
        while low > 1:
            low, high = low // 2, high // 2
            for nodes in (self.chars, self.tokens):
                nodes[low : high + 1] = nodes[2 * low : 2 * high + 2].reshape(-1, 2).sum(axis=1)


def grouped(pieces: list[str], counter: Counter, slots: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Characters and tokens of runs of pieces: ``LEAF`` each, or dealt to a number of slots."""
    count = -(-len(pieces) // LEAF) if slots is None else slots
    chars, tokens = np.zeros(max(count, 1), np.int64), np.zeros(max(count, 1), np.int64)
    if pieces:
        each = -(-len(pieces) // count)
        at = np.arange(0, len(pieces), each)
        chars[: len(at)] = np.add.reduceat(np.fromiter(map(len, pieces), np.int64, len(pieces)), at)
        tokens[: len(at)] = np.add.reduceat(counter.numbers(pieces), at)
    return chars, tokens


def edited(text: str, tree: Tree, start: int, end: int, insertion: str, counter: Counter) -> tuple[str, Tree, int]:
    """The text with ``[start, end)`` replaced, its tree, and how many characters were encoded anew.
    Positions beyond the text count as its end, an end before the start as the start."""
    start = min(max(start, 0), len(text))
    end = min(max(end, start), len(text))
    fresh = text[:start] + insertion + text[end:]
    first, begin = tree.leaf_at(start)
    while first > 0 and len(counter.pattern.findall(text, begin, start)) <= CONTEXT:
        first -= 1
        begin -= int(tree.chars[tree.leaves + first])
    shift, beyond = len(fresh) - len(text), start + len(insertion)
    last = first
    ends = begin + int(tree.chars[tree.leaves + last])  # of the last leaf, in the old text
    pieces, at = [], begin
    for m in counter.pattern.finditer(fresh, begin):
        pieces.append(m.group())
        at = m.end()
        while ends + shift < at and last + 1 < tree.leaves:
            last += 1
            ends += int(tree.chars[tree.leaves + last])
        if at >= beyond and at == ends + shift:
            break
    else:
        last = tree.leaves - 1
    if len(pieces) > CROWDED * (last - first + 1):  # too much text for these leaves
        before = tree.chars[tree.leaves : tree.leaves + first], tree.tokens[tree.leaves : tree.leaves + first]
        after = tree.chars[tree.leaves + last + 1 :], tree.tokens[tree.leaves + last + 1 :]
        own = grouped(pieces, counter)
        tree = Tree.of_leaves(*(np.concatenate([a, b, c]) for a, b, c in zip(before, own, after, strict=True)))
    else:
        tree.replace(first, last, *grouped(pieces, counter, last - first + 1))
    return fresh, tree, at - begin


# --- tables ---------------------------------------------------------------------------


def _ints(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32)))


def build_batches(vocabulary: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary)
        for batch in batches:
            trees = [Tree.of_text(x.as_py() or "", counter) for x in batch["text"]]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch["doc_id"], "key": batch["key"], "chars": _ints([t.chars for t in trees]), "tokens": _ints([t.tokens for t in trees])}
            )

    return run


def edit_batches(vocabulary: str | None, fields: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary)
        for batch in batches:
            out = {"n_tokens": [], "n_edits": [], "edited_tokens": [], "edited_chars": [], "encoded_chars": [], "text": []}
            trees = []
            for text, chars, tokens, edits in zip(*(batch[c] for c in ("text", "chars", "tokens", "edits")), strict=True):
                tree = Tree(*(np.array(x.values, np.int64) for x in (chars, tokens)))
                body, before, encoded = text.as_py() or "", tree.total, 0
                edits = [e for e in edits.as_py() or [] if e["start"] is not None and e["end"] is not None]
                for e in edits:
                    body, tree, n = edited(body, tree, e["start"], e["end"], e["insertion"] or "", counter)
                    encoded += n
                trees.append(tree)
                values = before, len(edits), tree.total, len(body), encoded, body
                for column, value in zip(out.values(), values, strict=True):
                    column.append(value)
            rows = {f: batch[f] for f in fields}
            rows |= {k: pa.array(v, pa.string() if k == "text" else pa.int64()) for k, v in out.items()}
            rows |= {"chars": _ints([t.chars for t in trees]), "tokens": _ints([t.tokens for t in trees])}
            yield pa.RecordBatch.from_pydict(rows)

    return run


def key_of(doc_id: Column, text: Column) -> Column:
    return F.concat_ws("/", F.coalesce(doc_id.cast("string"), F.lit("null")), F.hex(F.xxhash64(F.coalesce(text, F.lit("")))))


def build(df: DataFrame, vocabulary: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, key, chars, tokens``: the tree of every document, by a key of its id and text. Null and
    empty texts have a tree of one empty leaf."""
    small_batches(df.sparkSession)
    rows = reading(df, doc_id=doc_id, text=text)
    rows = rows.select("doc_id", key_of(F.col("doc_id"), F.col("text")).alias("key"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(build_batches(vocabulary), f"doc_id {kind}, key string, chars array<int>, tokens array<int>")


def apply_edits(
    df: DataFrame, trees: DataFrame, edits: DataFrame, vocabulary: str | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Counts, texts and trees after each document's edits.

    ``edits`` holds ``doc_id, edits``: per document an array of ``start, end, insertion`` in order, each
    in positions of the text that the ones before it left (an edit with a null position is skipped).
    Several rows of one ``doc_id`` are applied one after the other, in ascending order of their arrays.
    With a column ``key`` (see :func:`key_of`) the rows are those of one text; equal ones count once.
    Returns ``doc_id, n_tokens, n_edits, edited_tokens, edited_chars, encoded_chars, text, chars,
    tokens``; documents without edits keep their tree. Repeated documents share a tree and are edited
    alike; a null id has no edits. Edits meet their trees first, so texts are shuffled once.
    """
    rows = reading(df, doc_id=doc_id, text=text).withColumn("key", key_of(F.col("doc_id"), F.col("text")))
    on = "key" if "key" in edits.columns else "doc_id"
    wanted = edits.filter(F.col("doc_id").isNotNull()).select(on, "edits")
    wanted = (wanted.distinct() if on == "key" else wanted).groupBy(on).agg(F.flatten(F.sort_array(F.collect_list("edits"))).alias("edits"))
    planned = trees.join(wanted, on, "left").groupBy("key")
    planned = planned.agg(F.first(F.struct("chars", "tokens", "edits")).alias("plan"))
    met = rows.join(planned, "key").select("doc_id", "text", "plan.*")
    kind = rows.schema["doc_id"].dataType.simpleString()
    numbers = "n_tokens long, n_edits long, edited_tokens long, edited_chars long, encoded_chars long"
    schema = f"doc_id {kind}, {numbers}, text string, chars array<int>, tokens array<int>"
    return met.select("doc_id", "text", "chars", "tokens", "edits").mapInArrow(edit_batches(vocabulary, ["doc_id"]), schema)


def sample_edits(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Two edits for every document, from hashes of its id: a replacement of up to 40 characters by up
    to 60 of the text's first ones, and an insertion or a deletion somewhere else."""
    rows = reading(df, doc_id=doc_id, text=text).filter("doc_id is not null")
    body = F.coalesce(F.col("text"), F.lit(""))
    n = F.length(body)

    def pick(seed: int, below: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), below.cast("long")).cast("int")

    def edit(seed: int, removed: int, added: int) -> Column:
        start = pick(seed, n + 1)
        return F.struct(
            start.alias("start"),
            (start + pick(seed + 1, F.lit(removed + 1))).alias("end"),
            F.substring(body, F.lit(1), pick(seed + 2, F.lit(added + 1))).alias("insertion"),
        )

    return rows.select("doc_id", key_of(F.col("doc_id"), F.col("text")).alias("key"), F.array(edit(1, 40, 60), edit(11, 8, 8)).alias("edits"))


def count_through_edits(df: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Build and keep every document's tree, apply the sample edits, and report the counts."""
    trees = materialize(build(df, vocabulary), "trees")
    found = apply_edits(df, trees, sample_edits(df), vocabulary)
    return found.select("doc_id", "n_tokens", "n_edits", "edited_tokens", "edited_chars", "encoded_chars")
