"""Trie of conversation prefixes by ROLLUP over positional turn columns.

A turn is known by 128 bits of the digest of its role and text. A conversation becomes rows of ``WIDTH``
positional columns ``t1 … tw``, one row per block of turns, keyed by the node that the blocks before it
lead to. One ``GROUP BY block, node, ROLLUP (t1, …, tw)`` then aggregates the prefixes of all
lengths and conversations together; ``grouping_id`` tells a prefix's length. A node's key mixes block
numbers and turns by exclusive or, so the key before each block is a running aggregate and no block waits
for another.

What a subtree holds is worked out without walking it. A node belongs to its smallest member; the nodes that
belong to one conversation are the end of its own path. With ``S`` the words of a member, ``P`` the words before
a node, ``O`` the words of the nodes that a member owns and ``L`` the leaves it owns (0 or 1),

* leaves of a subtree = sum of ``L`` over its members;
* sum of ``n_convs * words`` = sum of ``S - P`` over its members;
* sum of ``words`` = ``S - P`` of the owner + sum of ``O`` over the other members,

so a second ROLLUP over the owners' rows gives all of them.

No conversation is held as a whole: turns are numbered and blocks are keyed in spans, whose totals are then
summed. Members that end at a node are digested as a stream of sorted blocks of ids.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.common import materialize, reading

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WIDTH = 8
#: Consecutive turn numbers, blocks of turns, and ids that one group holds at most.
TURNS, BLOCKS, IDS = 1024, 1024, 4096
WORDS = r"[^\x20\x09-\x0D]+"
ROOT = "root"


def turns(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, pos, id, words``: the turns of every conversation in order, numbered from 1.

    Order is by turn, null first; turns of one number follow each other by the digest of role and text, so
    equal rows are turns of their own and texts are never shuffled. A null role or text is empty; a row
    without a conversation is left out. Numbers are ranks inside ``TURNS`` consecutive turn numbers plus the
    totals of the spans before, so a conversation of any length is spread; rows that repeat one number of
    one conversation are ordered together.
    """
    rows = reading(df, conv_id=conv_id, turn=turn, role=role, text=text).filter("conv_id is not null")
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.floor(F.col("turn").cast("long") / F.lit(TURNS)).alias("span"),
        F.substring(F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)), 1, 16).alias("id"),
        F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words"),
    )
    rows = materialize(rows, "turns")
    before = Window.partitionBy("conv_id").orderBy(F.col("span").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    spans = rows.groupBy("conv_id", "span").agg(F.count(F.lit(1)).alias("n"))
    spans = spans.select("conv_id", "span", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("conv_id", "span").orderBy(F.col("turn").asc_nulls_first(), "id")
    ranked = rows.withColumn("rank", F.row_number().over(inside)).alias("r").join(spans.alias("s"), F.expr("r.conv_id = s.conv_id and r.span <=> s.span"))
    return ranked.select("r.conv_id", (F.col("first") + F.col("rank")).alias("pos"), "id", "words")


def rebuilt(turned: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """``conv_id, pos, id, words``: conversations that share beginnings.

    With ``h`` the CRC-32 of the decimal ``conv_id`` modulo ``most``, a conversation ``c`` starts with the first
    ``h`` turns of conversation ``c - c % every`` (all if there are fewer, none if there is none), followed by its
    own turns after its first ``h``. One that is left without turns stays as a row of null ``pos``.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % F.lit(most)
    own = turned.withColumn("h", h)
    ids = own.select("conv_id", "h", (F.col("conv_id") - F.col("conv_id") % F.lit(every)).alias("base")).distinct()
    heads = turned.filter((F.col("conv_id") % every == 0) & (F.col("pos") < most))
    heads = heads.select(F.col("conv_id").alias("base"), F.col("pos").alias("p"), "id", "words")
    taken = ids.join(heads, "base").filter("p <= h").select("conv_id", F.col("p").alias("pos"), "id", "words")
    moved = taken.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    rest = own.filter("pos > h").join(moved, "conv_id", "left")
    rest = rest.select("conv_id", (F.col("pos") - F.col("h") + F.coalesce("n", F.lit(0))).alias("pos"), "id", "words")
    none = ids.select("conv_id", *(F.lit(None).cast(t).alias(c) for c, t in (("pos", "long"), ("id", "binary"), ("words", "long"))))
    return taken.union(rest).union(none)


def _key(seed: int, block: Column, turns: list[Column]) -> Column:
    """64 bits of a block's number and its first turns; null turns add nothing."""
    return F.xxhash64(F.lit(seed), block, *turns)


def blocks(placed: DataFrame, width: int = WIDTH) -> DataFrame:
    """``conv_id, block, k1, k2, before, t1 … tw, size, ends, total``: a row per conversation and block of turns.

    ``placed`` holds ``conv_id, pos, id, words``; a null ``pos`` only says that the conversation exists. ``k1, k2``
    and ``before`` are the key and the words of the prefix in front of the block, ``total`` the words of the whole
    conversation, and ``ends`` tells whether it ends in this block.
    """
    block = F.coalesce(F.floor((F.col("pos") - 1) / F.lit(width)), F.lit(0)).cast("long")
    at = F.col("pos") - 1 - F.col("block") * width
    slots = [F.max(F.when(at == i, F.struct("id", "words"))).alias(f"t{i + 1}") for i in range(width)]
    rows = placed.withColumn("block", block).groupBy("conv_id", "block").agg(*slots, F.count("pos").alias("size"))
    names = [f"t{i + 1}" for i in range(width)]
    ids = [F.col(f"{t}.id") for t in names]
    rows = rows.withColumns(
        {"m1": _key(1, F.col("block"), ids), "m2": _key(2, F.col("block"), ids), "own": sum((F.coalesce(F.col(f"{t}.words"), F.lit(0)) for t in names), F.lit(0))}
    )
    rows = materialize(rows.withColumn("span", F.floor(F.col("block") / F.lit(BLOCKS))), "blocks")

    # Running aggregates inside spans, and those of the spans before.
    def running(window, *columns) -> list[Column]:
        folds = (F.bit_xor, F.bit_xor, F.sum)
        return [F.coalesce(f(c).over(window), F.lit(0)) for f, c in zip(folds, columns, strict=True)]

    across = Window.partitionBy("conv_id")
    spans = rows.groupBy("conv_id", "span").agg(F.bit_xor("m1").alias("m1"), F.bit_xor("m2").alias("m2"), F.sum("own").alias("own"), F.max("block").alias("last"))
    a, b, c = running(across.orderBy("span").rowsBetween(Window.unboundedPreceding, -1), "m1", "m2", "own")
    spans = spans.select("conv_id", "span", a.alias("a"), b.alias("b"), c.alias("c"), F.sum("own").over(across).alias("total"), F.max("last").over(across).alias("last"))
    inside = Window.partitionBy("conv_id", "span").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    x, y, z = running(inside, "m1", "m2", "own")
    met = rows.withColumns({"x": x, "y": y, "z": z}).join(spans, ["conv_id", "span"])
    return met.select(
        "conv_id",
        "block",
        F.col("x").bitwiseXOR(F.col("a")).alias("k1"),
        F.col("y").bitwiseXOR(F.col("b")).alias("k2"),
        (F.col("z") + F.col("c")).alias("before"),
        *names,
        "size",
        (F.col("block") == F.col("last")).alias("ends"),
        "total",
    )


def _rollup(rows: DataFrame, sums: str, width: int) -> DataFrame:
    """Every prefix of the rows, with aggregates of its members: all levels of all blocks in one ROLLUP."""
    names = ", ".join(f"t{i + 1}" for i in range(width))
    found = rows.sparkSession.sql(
        f"SELECT block, k1, k2, {names}, grouping_id() AS gid, {sums} FROM {{rows}} GROUP BY block, k1, k2, ROLLUP ({names})",
        rows=rows,
    )
    # Of the grouping bits those of the columns left out are set, the last columns in the lowest bits.
    level = F.lit(width) - F.length(F.regexp_replace(F.bin(F.col("gid")), "0", ""))
    found = found.withColumn("level", level.cast("int"))
    # A shorter conversation has no turn at this level; the empty prefix of a later block is a node of the one before.
    reached = F.when(F.col("level") == 0, F.col("block") == 0)
    for i in range(width):
        reached = reached.when(F.col("level") == i + 1, F.col(f"t{i + 1}").isNotNull())
    return found.filter(reached)


def _node(level: Column, width: int, up: int = 0) -> Column:
    """Hexadecimal key of the prefix of ``level - up`` turns in a block. The whole block's key is that in front
    of the next block; in front of the first block stands the root."""
    def of(n: int) -> Column:
        block = F.col("block")
        if n == 0:
            whole = [F.col("k1"), F.col("k2")]
        else:
            ids = [F.col(f"t{i + 1}.id") for i in range(n)]
            whole = [F.col(k).bitwiseXOR(_key(s, block, ids)) for s, k in ((1, "k1"), (2, "k2"))]
        text = F.concat(*(F.lpad(F.hex(x), 16, "0") for x in whole))
        return F.when(block == 0, F.lit(ROOT)).otherwise(text) if n == 0 else text

    chosen = F.when(level == up, of(0))
    for n in range(1, width - up + 1):
        chosen = chosen.when(level == n + up, of(n))
    return chosen


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the blocks of ids of each node, which arrive one after the other."""
    node, state = None, None
    for batch in batches:
        done = []
        for name, ids in zip(batch["node"].to_pylist(), batch["ids"].to_pylist(), strict=True):
            if name != node:
                if node is not None:
                    done.append((node, state.hexdigest()))
                node, state = name, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        if done:
            yield pa.RecordBatch.from_pydict(dict(zip(("node", "ends_sha256"), map(pa.array, zip(*done, strict=True)), strict=True)))
    if node is not None:
        yield pa.RecordBatch.from_pydict({"node": pa.array([node]), "ends_sha256": pa.array([state.hexdigest()])})


def ends(rows: DataFrame, width: int = WIDTH) -> DataFrame:
    """``node, ends_sha256`` of the nodes where conversations end: ids joined by commas in ascending order. Ids are
    joined in blocks of ``IDS`` neighbours; one task streams the blocks of a node through the digest, which
    cannot be computed in parts."""
    last = rows.filter("ends").select(_node(F.col("size"), width).alias("node"), "conv_id")
    last = last.withColumn("part", F.floor(F.col("conv_id") / F.lit(IDS)))
    parts = last.groupBy("node", "part").agg(F.concat_ws(",", F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string"))).alias("ids"))
    parts = parts.repartition("node").sortWithinPartitions("node", "part").select("node", "ids")
    return parts.mapInArrow(_digest, "node string, ends_sha256 string")


def nodes(placed: DataFrame, width: int = WIDTH) -> DataFrame:
    """The trie of conversations ``conv_id, pos, id, words`` (see ``rebuilt``; a null ``pos`` names a conversation
    that may have no turns), a row per node.

    Returns ``node, parent`` (keys), ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256``. Without conversations there is no root.
    """
    rows = materialize(blocks(placed, width), "blocks_keyed")
    sums = "count(*) AS n_convs, min(conv_id) AS conv_id, min_by(total, conv_id) AS total, sum(total) AS member_words, min(before) AS before"
    found = _rollup(rows, sums, width)
    level = F.col("level")

    def words(upto) -> Column:
        return sum((F.when(upto(i), F.coalesce(F.col(f"t{i + 1}.words"), F.lit(0))).otherwise(0) for i in range(width)), F.lit(0).cast("long"))

    trie = found.select(
        "block", "k1", "k2", *(f"t{i + 1}" for i in range(width)), "level", "n_convs", "conv_id", "total", "member_words",
        _node(level, width).alias("node"), _node(level, width, up=1).alias("parent"), (F.col("block") * width + level).alias("depth"),
        words(lambda i: level == i + 1).alias("words"), (F.col("before") + words(lambda i: level > i + 1)).alias("before"),
    ).select("node", F.when(F.col("depth") > 0, F.col("parent")).alias("parent"), "conv_id", "depth", "n_convs", "total", "member_words", "words", "before")
    trie = materialize(trie, "trie")
    children = trie.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    trie = materialize(trie.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie_children")

    # What each conversation owns, summed over the members of every node.
    owned = trie.groupBy("conv_id").agg(F.sum("words").alias("owned"), F.sum((F.col("n_children") == 0).cast("long")).alias("leaves"))
    own = rows.join(owned, "conv_id")
    sums = _rollup(own, "sum(owned) AS owned_words, sum(leaves) AS n_leaves", width).select(_node(level, width).alias("node"), "owned_words", "n_leaves")
    mine = trie.join(owned.select("conv_id", "owned"), "conv_id")
    parents = trie.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    full = mine.join(sums, "node").join(ends(rows, width), "node", "left").join(parents, "parent", "left")
    # Words of a subtree, each node counted for every member and counted once.
    every = F.col("member_words") - F.col("n_convs") * F.col("before")
    once = F.col("total") - F.col("before") + F.col("owned_words") - F.col("owned")
    return full.select(
        "node",
        "parent",
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        (every - once).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def rebuilt_trie(df: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations of a table ``conv_id, turn, role, text``, without node keys."""
    placed = rebuilt(materialize(turns(df), "numbered"))
    return nodes(placed).drop("node", "parent")
