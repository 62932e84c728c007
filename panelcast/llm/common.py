"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import hashlib
import pickle
import sys
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.session import materialize, scratch_path, shared_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["BROADCAST_ROWS", "ROWS", "Blocks", "among", "bind", "fitted", "gapless", "give_back", "hinted", "lean", "materialize", "reading", "release", "scratch_path", "shared_dir", "shipped", "small_batches", "stored", "table", "temporary"]

ARROW_ROWS, ARROW_BYTES = 1000, 16 << 20
BROADCAST_ROWS, BITS = 1_000_000, 16
#: Short rows, such as a few numbers, that a task may as well write alone.
ROWS = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reading(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns of ``df``, under the operator's own names (``new="old"``); whatever
    else the table carries, also under clashing names, is left behind."""
    return df.select(*(df[old].alias(new) for new, old in columns.items()))


def small_batches(spark: SparkSession) -> None:
    """Bound the rows and bytes of the session's Arrow batches, so that a Python worker holds about a
    thousand texts; smaller bounds stay."""
    rows, size = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= ARROW_ROWS:
        spark.conf.set(rows, str(ARROW_ROWS))
    held = spark.conf.get(size)
    if not (held.rstrip("b").isdigit() and 0 < int(held.rstrip("b")) <= ARROW_BYTES):
        spark.conf.set(size, f"{ARROW_BYTES}b")


def give_back() -> None:
    """Return what this process has freed to the system. Python workers are used again, and what one task held for a
    moment would otherwise count against the executor's memory in all later ones."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass


def lean(run):
    """``run``, a function over the batches of a task, that starts and leaves its worker without freed memory."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        yield from run(batches)
        give_back()

    return whole


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back, like ``materialize``, as a table that :func:`release`
    can drop."""
    spark = df.sparkSession
    base = f"{shared_dir(spark)}/panelcast-scratch"
    name = f"scratch_{hashlib.md5(base.encode()).hexdigest()[:12]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{base}'")
    table_name = f"{label}_{uuid.uuid4().hex}".lower()
    df.write.format("parquet").saveAsTable(f"{name}.{table_name}")
    out = spark.read.schema(df.schema).parquet(f"{base}/{table_name}")
    out._scratch = f"{name}.{table_name}"
    return out


def release(*tables: DataFrame | None) -> None:
    """Drop :func:`stored` tables, files included, that nothing reads any more."""
    for t in tables:
        name = getattr(t, "_scratch", None) if t is not None else None
        if name:
            t.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")


@contextmanager
def temporary() -> Iterator:
    """A function like :func:`stored` whose tables go when the block ends, also by an error."""
    held: list[DataFrame] = []

    def keep(df: DataFrame, label: str) -> DataFrame:
        held.append(stored(df, label))
        return held[-1]

    try:
        yield keep
    finally:
        release(*held)


def hinted(small: DataFrame) -> DataFrame:
    """A stored table of few bytes a row to join with: broadcast if its rows are few, else left to a
    shuffled join."""
    return F.broadcast(small) if small.count() <= BROADCAST_ROWS else small


def among(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` whose ``key`` is in the stored ``ids``, a table of one column, where they lie. Of many ids only
    bits of their hashes are broadcast, ``BITS`` for each, which lets some further rows pass; rows of a null key never do."""
    known = ids.toDF(key)
    rows = known.count()
    if rows <= BROADCAST_ROWS:
        return df.join(F.broadcast(known), key, "left_semi")
    place = F.pmod(F.xxhash64(key), F.lit(rows * BITS)) + 1
    held = known.filter(F.col(key).isNotNull()).groupBy(F.bitmap_bucket_number(place).alias("_bucket"))
    held = held.agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bits"))
    at = F.bitmap_bit_position(place)
    met = df.filter(F.col(key).isNotNull()).withColumn("_bucket", F.bitmap_bucket_number(place)).join(F.broadcast(held), "_bucket")
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return met.filter(F.getbit(byte, (at % 8).cast("int")) == 1).select(df.columns)


def fitted(df: DataFrame, rows: int, each: int = ROWS) -> DataFrame:
    """``df``, which has at most ``rows`` rows, in no more partitions than hold ``each`` of them. The partitions of a
    shuffle are counted for the whole input; without this, a table of a few rows costs as many tasks and files."""
    return df.coalesce(max(1, -(-rows // each)))


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where lambdas use it per element."""
    return F.transform(F.array(value), body)[0]


def gapless(df: DataFrame, group: str, bucket: str, order: list[str], weight: str, name: str) -> DataFrame:
    """Running sum of ``weight`` before each row within ``group``, without one task per group.

    Rows are ranked inside ``(group, bucket)``; the buckets' totals, a small table, give each bucket
    its first number. ``df`` is read twice and should be a stored table.
    """
    from pyspark.sql import Window

    inside = Window.partitionBy(group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        df.groupBy(group, bucket)
        .agg(F.sum(weight).alias("_rows"))
        .select(group, bucket, F.coalesce(F.sum("_rows").over(across), F.lit(0)).alias("_first"))
    )
    ranked = df.withColumn("_inside", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    return ranked.join(firsts, [group, bucket]).withColumn(name, F.col("_first") + F.col("_inside")).drop("_first", "_inside")


def shipped(spark: SparkSession, value):
    """A broadcast of any value for :class:`Blocks`. It travels as bytes that hold the code of its classes too, since
    executors do not have this package."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


class Blocks:
    """The values of :func:`shipped` blocks, one after the other. A single block stays unpacked; of several only
    the one in use is held."""

    def __init__(self, blocks: list):
        self.blocks, self.only = blocks, None

    def __iter__(self):
        if len(self.blocks) == 1:
            self.only = pickle.loads(self.blocks[0].value) if self.only is None else self.only
            yield self.only
        else:
            for block in self.blocks:
                yield pickle.loads(block.load_from_path(block._path))
