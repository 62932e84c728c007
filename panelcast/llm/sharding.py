"""Placement of rows by a hierarchical weighted hash tree (native columns only).

A tree has regions, racks and shards. A key descends it level by level: at each level every child
draws ``-ln(u) / weight`` with ``u`` from a hash of the child's name and the key, and the smallest
draw wins, so a child gets keys in proportion to its weight and a child's draw depends on no other
child. A weight that changes therefore moves keys only between its own subtree and the rest.

A shard that is added opens a region of its own, so it takes rows only into itself: no other
subtree's weight changes. Null keys descend as the text ``null``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import gapless, materialize, reading

BUCKETS = 4096
ROW_OVERHEAD = 8


@dataclass(frozen=True)
class Leaf:
    shard: int
    region: str
    rack: str
    weight: float = 1.0


def tree(shards: int, racks: int = 2, per_rack: int = 4) -> list[Leaf]:
    """``shards`` equal shards, filled rack by rack and region by region."""
    return [Leaf(i, f"g{i // (racks * per_rack)}", f"k{i // per_rack}") for i in range(shards)]


def grown(leaves: list[Leaf], weight: float = 1.0) -> list[Leaf]:
    """The tree with one more shard, in a region and rack of its own."""
    n = 1 + max((leaf.shard for leaf in leaves), default=-1)
    return [*leaves, Leaf(n, f"added{n}", f"added{n}", weight)]


def draw(node: str, key: Column, weight: float) -> Column:
    """An exponential draw with rate ``weight`` from the first 52 bits of an MD5 digest."""
    digest = F.md5(F.concat(F.lit(f"{node}/"), key))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    return -F.log((bits + 0.5) / float(1 << 52)) / float(weight)


def _lowest(options: list[tuple[str, float, Column]], key: Column) -> Column:
    """What the option with the smallest draw leads to; equal draws go to the option listed first."""
    if len(options) == 1:
        return options[0][2]
    draws = [draw(name, key, weight) for name, weight, _ in options]
    least = F.least(*draws)
    chosen = options[-1][2]
    for value, (_, _, then) in reversed(list(zip(draws[:-1], options[:-1], strict=True))):
        chosen = F.when(value == least, then).otherwise(chosen)
    return chosen


def shard_of(leaves: list[Leaf], key: Column) -> Column:
    """The shard that ``key`` (a string column) descends to."""
    if not leaves:
        raise ValueError("a tree needs at least one shard")
    regions: dict[str, dict[str, list[Leaf]]] = {}
    for leaf in leaves:
        if leaf.weight <= 0:
            raise ValueError("weights must be positive")
        regions.setdefault(leaf.region, {}).setdefault(leaf.rack, []).append(leaf)

    def weight(rows: list[Leaf]) -> float:
        return reduce(lambda total, leaf: total + leaf.weight, rows, 0.0)

    def rack(name: str, rows: list[Leaf]) -> Column:
        return _lowest([(f"{name}/s{x.shard}", x.weight, F.lit(x.shard)) for x in rows], key)

    def region(name: str, racks: dict[str, list[Leaf]]) -> Column:
        return _lowest([(f"{name}/{k}", weight(v), rack(f"{name}/{k}", v)) for k, v in racks.items()], key)

    return _lowest(
        [(k, weight([x for rows in v.values() for x in rows]), region(k, v)) for k, v in regions.items()], key
    )


def place(df: DataFrame, leaves: list[Leaf], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Shard, slot and shard after one more shard of every row.

    Returns ``doc_id, size, text_crc32, law, shard, slot, grown_shard``. ``size`` is the UTF-8 length
    plus eight, a null text counting as empty in size and CRC. Slots run from 0 without gaps in each
    shard, by bucket of the key and then by key. Equal rows are counted before they are shuffled and
    spread again afterwards, so a row repeated any number of times is one row to the shuffle. An
    empty table gives an empty result; other columns are ignored.
    """
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = reading(df, doc_id=doc_id, text=text).select(
        "doc_id",
        (F.octet_length(body) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(body.cast("binary")).cast("long").alias("text_crc32"),
    )
    counted = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies"))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    bucket = F.conv(F.substring(F.md5(F.concat(F.lit("bucket/"), key)), 1, 3), 16, 10).cast("int")
    placed = counted.select(
        "*",
        shard_of(leaves, key).alias("shard"),
        shard_of(grown(leaves), key).alias("grown_shard"),
        (bucket % BUCKETS).alias("bucket"),
    )
    placed = materialize(placed, "placed")
    order = [F.col("doc_id").asc_nulls_first(), "size", "text_crc32"]
    slots = gapless(placed, "shard", "bucket", order, "copies", "first_slot")
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
    return slots.select("*", copy.alias("copy")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("first_slot") + F.col("copy")).alias("slot"),
        "grown_shard",
    )
