"""Ranked lexical search by geometric blocking of posting lists with maximum summaries.

Documents are read once to vectors over the terms that a block of queries asks for, from which the numbers
of documents that hold each term are counted. The vectors are then indexed in shards of bounded size, where
they lie. In a shard every term's posting list is clustered: some of its documents are leaders, every
other joins the leader it is most similar to (by a random projection of its weighted vector), and a
cluster makes one or more blocks. A block's summary holds the largest impact of its documents at every term
that queries combine with the list's own, so weights times summary is at least the score of each of its
documents.

A query sorts the blocks of its terms' lists by that bound and scores documents exactly until the next
bound is below its ``k``-th best score so far. That score goes along from shard to shard of a task, tasks
return ``k`` rows a query at most, and the best of those are the result. Bounds and scores are integers,
so nothing is lost, ties included.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.common import materialize, reading, small_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
UPPER, LOWER = bytes(range(ord("A"), ord("Z") + 1)), bytes(range(ord("a"), ord("z") + 1))
FOLDED = bytes.maketrans(SEPARATORS + UPPER, b" " * len(SEPARATORS) + LOWER)
CHUNK = 1 << 20
#: Queries and their terms that are searched for together, documents of a shard, and cells of its matrix.
QUERIES, TERMS, DOCS, CELLS = 4096, 8192, 4096, 32_000_000
BLOCK, DIMENSIONS = 64, 16
#: Blocks that are scored before the bound is compared again.
STEP = 8
SALTS = 64


def words(text: str) -> Iterator[list[bytes]]:
    """The terms of a text in order, in parts: runs of letters and digits and of all signs beyond ASCII, only A-Z
    in lower case."""
    body, at = text.encode().translate(FOLDED), 0
    while at < len(body):
        end = body.find(b" ", at + CHUNK)
        end = len(body) if end < 0 else end
        yield body[at:end].split()
        at = end


def weight(n: int, df: np.ndarray) -> np.ndarray:
    return np.floor(1000 * np.log((2 * n + 2) / (2 * df + 1))).astype(np.int64)


class Shard:
    """The blocked posting lists of some documents. ``impacts`` has a row per document and a column per term;
    ``company`` names, for every term, the sorted columns that queries combine with it."""

    def __init__(self, impacts: np.ndarray, weights: np.ndarray, company: list[np.ndarray], block: int = BLOCK):
        self.impacts, self.lists = impacts, {}
        rng = np.random.default_rng(len(weights))
        signs = rng.choice(np.array([-1, 1], np.float32), (len(weights), DIMENSIONS))
        place = impacts.astype(np.float32) @ (signs * weights[:, None].astype(np.float32))
        place /= np.maximum(np.linalg.norm(place, axis=1, keepdims=True), 1e-9)
        held = impacts > 0
        for t in np.flatnonzero(held.any(axis=0) & (weights > 0)):
            docs = np.flatnonzero(held[:, t])
            starts = np.zeros(1, np.int64)
            if len(docs) > block:
                leaders = rng.choice(docs, -(-len(docs) // block), replace=False)
                nearest = np.argmax(place[docs] @ place[leaders].T, axis=1)
                order = np.argsort(nearest, kind="stable")
                docs, nearest = docs[order], nearest[order]
                begin = np.flatnonzero(np.diff(nearest, prepend=-1))
                size = np.diff(begin, append=len(docs))
                starts = np.concatenate([np.arange(b, b + n, block) for b, n in zip(begin, size, strict=True)])
            summary = np.maximum.reduceat(impacts[np.ix_(docs, company[t])], starts, axis=0)
            self.lists[int(t)] = docs, np.append(starts, len(docs)), company[t], summary

    def search(self, terms: np.ndarray, weights: np.ndarray, ids: np.ndarray, best: Best) -> tuple[int, int]:
        """Offer ``best`` every document that may belong to it; returns blocks scored and blocks there are."""
        found = [(t, *self.lists[t]) for t in terms.tolist() if t in self.lists]
        if not found:
            return 0, 0
        bounds, blocks = [], []
        for _, docs, starts, columns, summary in found:
            bounds.append(summary[:, np.searchsorted(columns, terms)].astype(np.int64) @ weights)
            blocks += [docs[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True)]
        bounds = np.concatenate(bounds)
        order, seen, done = np.argsort(-bounds, kind="stable"), np.zeros(len(ids), bool), 0
        while done < len(order) and bounds[order[done]] >= best.least:
            some = order[done : done + STEP]
            some = some[bounds[some] >= best.least]
            done += len(some)
            docs = np.unique(np.concatenate([blocks[b] for b in some]))
            docs = docs[~seen[docs]]
            seen[docs] = True
            best.offer(self.impacts[np.ix_(docs, terms)].astype(np.int64) @ weights, ids[docs])
        return done, len(order)


class Best:
    """The ``k`` best scores above 0, of equal ones those of the smallest ids."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def least(self) -> int:
        """What a score must reach to matter."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.least
        scores, ids = np.append(self.scores, scores[good]), np.append(self.ids, ids[good])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]


# --- tables ---------------------------------------------------------------------------


def query_blocks(items: DataFrame, queries: int = QUERIES, terms: int = TERMS) -> Iterator[list[tuple[int, list[bytes]]]]:
    """The queries ``item_id, text`` with their distinct terms, in blocks of bounded size; the driver holds one
    block. Rows of one item are one query; a null id or no terms make none."""
    block, held, last = [], set(), None
    for row in items.filter("item_id is not null").orderBy("item_id").toLocalIterator():
        own = sorted({w for part in words(row["text"] or "") for w in part})
        if block and last == row["item_id"]:
            block[-1] = last, sorted({*block[-1][1], *own})
        else:
            if block and (len(block) >= queries or len(held) + len(own) > terms):
                yield block
                block, held = [], set()
            block.append((row["item_id"], own))
        held.update(own)
        last = row["item_id"]
    if block:
        yield block


def _vectors(known: dict[bytes, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, terms, counts = [], [], []
            for text in batch["text"]:
                total, found = 0, Counter()
                for part in words(text.as_py() or ""):
                    total += len(part)
                    found.update(filter(None.__ne__, map(known.get, part)))
                n.append(total)
                terms.append(list(found.keys()))
                counts.append(list(found.values()))
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch["doc_id"], "n": pa.array(n, pa.int64()), "terms": pa.array(terms, pa.list_(pa.int32())), "counts": pa.array(counts, pa.list_(pa.int64()))}
            )

    return run


def vectors(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """``doc_id, n, terms, counts`` of every document with a term: all its terms counted in ``n``, those of ``terms``
    with their occurrences. A null text has none; a row without an id is left out."""
    small_batches(docs.sparkSession)
    rows = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = {t: i for i, t in enumerate(terms)}
    return rows.mapInArrow(_vectors(known), "doc_id long, n long, terms array<int>, counts array<long>").filter("n > 0")


def _search(queries: list[tuple[int, np.ndarray]], weights: np.ndarray, company: list[np.ndarray], n_docs: int, n_terms: int, k: int, block: int, size: int):
    def shard(rows: list[tuple]) -> tuple[np.ndarray, Shard]:
        ids = np.array([r[0] for r in rows], np.int64)
        impacts = np.zeros((len(rows), len(weights)), np.int32)
        for i, (_, n, terms, counts) in enumerate(rows):
            # Each product stays exact: lengths are taken as Python integers.
            m = 50 + 50 * n * n_docs // n_terms
            tf = np.array(counts, np.int64)
            impacts[i, terms] = [1_000_000_000 * x // (1000 * x + 20 * m) for x in tf.tolist()]
        return ids, Shard(impacts, weights, company, block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, rows = [Best(k) for _ in queries], []

        def search() -> None:
            ids, index = shard(rows)
            for (_, terms), kept in zip(queries, best, strict=True):
                index.search(terms, weights[terms], ids, kept)
            rows.clear()

        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in ("doc_id", "n", "terms", "counts")), strict=True):
                rows.append(row)
                if len(rows) >= size:
                    search()
        if rows:
            search()
        yield pa.RecordBatch.from_pydict(
            {
                "item_id": pa.array([q for (q, _), b in zip(queries, best, strict=True) for _ in b.ids], pa.int64()),
                "doc_id": pa.array(np.concatenate([np.zeros(0, np.int64), *(b.ids for b in best)])),
                "score": pa.array(np.concatenate([np.zeros(0, np.int64), *(b.scores for b in best)])),
            }
        )

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each item, first of each salted part, then of what is left."""
    order = F.desc("score"), F.asc("doc_id")
    parts = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    parts = parts.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "salt").orderBy(*order))).filter(F.col("rank") <= k)
    ranked = parts.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).filter(F.col("rank") <= k)
    return ranked.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(
    docs: DataFrame, items: DataFrame, k: int = 50, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", block: int = BLOCK
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item, equal scores by ascending ``doc_id``.

    Ids are integers. Documents without terms, with a null text or of score 0 are not returned, rows of one
    ``doc_id`` are ranked each for itself, and an empty table on either side gives no rows. A
    document's score sums over the item's distinct terms weight times impact: the weight is
    ``floor(1000 * ln((2N + 2) / (2df + 1)))`` for ``df`` of ``N`` documents, the impact of ``tf`` occurrences is
    ``10^9 tf div (1000 tf + 20 m)``, where ``m`` is 50 + 50 times the document's terms over the mean, rounded down.
    """
    spark = docs.sparkSession
    docs, items = reading(docs, doc_id=doc_id, text=text), reading(items, item_id=item_id, text=item_text)
    results = [_search_block(docs, queries, k, block) for queries in query_blocks(items)]
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for found in results:
        out = found if len(results) == 1 else out.union(found)
    return out


def _search_block(docs: DataFrame, queries: list[tuple[int, list[bytes]]], k: int, block: int) -> DataFrame:
    terms = sorted({t for _, own in queries for t in own})
    rows = materialize(vectors(docs, terms), "vectors")
    n_docs, n_terms = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    # At most one number for each term of the block.
    df = np.zeros(len(terms), np.int64)
    for row in rows.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[row["term"]] = row["count"]
    weights = weight(n_docs, df)
    place = {t: i for i, t in enumerate(terms)}
    asked = [(q, np.array([place[t] for t in own if weights[place[t]] > 0], np.int64)) for q, own in queries]
    together: list[set[int]] = [set() for _ in terms]
    for _, own in asked:
        for t in own.tolist():
            together[t].update(own.tolist())
    company = [np.array(sorted(x), np.int64) for x in together]
    size = max(1, min(DOCS, CELLS // max(1, len(terms))))
    found = rows.mapInArrow(_search(asked, weights, company, n_docs, n_terms, k, block, size), "item_id long, doc_id long, score long")
    return _ranked(found, k)
