"""Connected components by alternating star operations on an edge table, each block of edges contracted first."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import fitted, lean, release, stored, temporary

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Edges of a block, which a task holds at once.
BLOCK = 250_000


def star_batches(block: int):
    """Batches of edges ``a, b`` to stars: of every ``block`` edges, each node but the least of its component with
    that least node. Nodes without another, of edges ``a = b``, go."""

    def stars(top: dict, kind: pa.DataType) -> pa.RecordBatch:
        found = [(root(top, x), x) for x in top]
        found = [(a, b) for a, b in found if a != b]
        return pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in found], kind), "b": pa.array([b for _, b in found], kind)})

    def root(top: dict, x):
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top, held, kind = {}, 0, None
        for batch in batches:
            kind = batch.schema.field("a").type
            for start in range(0, batch.num_rows, block):
                part = batch.slice(start, block)
                if held + part.num_rows > block:
                    yield stars(top, kind)
                    top, held = {}, 0
                held += part.num_rows
                for a, b in zip(part["a"].to_pylist(), part["b"].to_pylist(), strict=True):
                    top.setdefault(a, a)
                    top.setdefault(b, b)
                    x, y = root(top, a), root(top, b)
                    if x < y:
                        top[y] = x
                    elif y < x:
                        top[x] = y
        if top:
            yield stars(top, kind)

    return lean(run)


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )


def _star(pairs: DataFrame, keep: Column, label: str) -> DataFrame:
    """Stored edges from every neighbour ``v`` of ``u`` that ``keep`` admits to the least of the neighbours
    and ``u``. Both join inputs are read from stored tables, so the partition of a hub can be split."""
    with temporary() as temp:
        least = pairs.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m"))
        least = temp(least, "least")
        met = pairs.join(least, "u").filter(keep).select(F.col("v").alias("b"), F.col("m").alias("a"))
        own = least.filter("u <> m").select(F.col("u").alias("b"), F.col("m").alias("a"))
        return stored(met.union(own).filter("a <> b").select("a", "b").distinct(), label)


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()


def _blocks(edges: DataFrame) -> int:
    return max(1, -(-edges.count() // BLOCK))


def components(edges: DataFrame, kept: bool = False) -> DataFrame:
    """``node, label`` of every node on an edge ``a, b``: the smallest node it is connected with, as a stored table.
    Edges are stored first unless they are ``kept``, cheap to read twice.

    Blocks of at most ``BLOCK`` edges are contracted side by side, each in a task, again while that halves them.
    A single block is done by then. Of more, each pass hangs neighbours under smaller ones until every edge leads
    to its component's smallest node; passes grow with the logarithm of the longest path. Only a count and a
    checksum of the edges reach the driver, and only the last pass's tables stay until the labels are stored.
    """
    kind = edges.schema["a"].dataType.simpleString()
    edges = edges.filter("a <> b").select("a", "b")
    edges = edges if kept else stored(edges, "edges")
    before, blocks = math.inf, _blocks(edges)
    while before > 1 and 2 * blocks <= before:
        given, before = edges, blocks
        edges = stored(given.coalesce(blocks).mapInArrow(star_batches(BLOCK), f"a {kind}, b {kind}"), "stars")
        release(given)
        blocks = _blocks(edges)
    state = _state(edges) if before > 1 else (0, None)
    while state[0]:
        large = _star(_both_ways(edges), F.col("v") > F.col("u"), "large")
        release(edges)
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        edges = _star(down, F.lit(True), "small")
        release(large)
        before, state = state, _state(edges)
        if state == before:
            break
    labels = edges.select(F.col("b").alias("node"), F.col("a").alias("label"))
    labels = labels.union(edges.select(F.col("a").alias("node"), F.col("a").alias("label")))
    labels = labels.distinct() if blocks > 1 else labels.coalesce(1).distinct()  # one task needs no shuffle
    labels = stored(fitted(labels, 2 * blocks * BLOCK), "labels")
    release(edges)
    return labels
