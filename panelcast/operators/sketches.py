"""Distinct counts that can be stored and added up: a sketch per key and period.

A sketch is a few kilobytes of binary that estimates how many different values it has seen. Sketches merge, so
one table by month answers for any range of months and any coarser key without reading facts again, which
distinct counts themselves cannot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions.calendar import period_label

#: Logarithm of a sketch's size; the relative standard error is about ``1.04 / sqrt(2 ** LOG_SIZE)``, 0.8 %.
LOG_SIZE = 14


def distinct_sketches(
    df: DataFrame, column: str, keys: Sequence[str] = (), freq: str = "MS", date_col: str = "date", log_size: int = LOG_SIZE
) -> DataFrame:
    """``keys…, period, n_rows, sketch``: one partial and final aggregate over the facts. Null values are not
    counted, rows without a date are left out; ``column`` is a whole number or text."""
    kind = df.schema[column].dataType.simpleString()
    value = F.col(column) if kind in ("int", "bigint", "string", "binary") else F.col(column).cast("string")
    dated = df.dropna(subset=[date_col]).withColumn("period", period_label(F.col(date_col), freq))
    return dated.groupBy(*keys, "period").agg(
        F.count(F.lit(1)).alias("n_rows"), F.hll_sketch_agg(value, F.lit(log_size)).alias("sketch")
    )


def merged(table: DataFrame, keys: Sequence[str] = (), between: tuple | None = None) -> DataFrame:
    """``keys…, n_rows, sketch`` of the periods from the first to the last of ``between`` (both included; all without
    it). The result can be merged again."""
    if between is not None:
        table = table.where(F.col("period").between(F.lit(between[0]), F.lit(between[1])))
    return table.groupBy(*keys).agg(F.sum("n_rows").alias("n_rows"), F.hll_union_agg("sketch").alias("sketch"))


def estimate(sketch: str | Column = "sketch") -> Column:
    """The number of distinct values a sketch has seen, 0 without one."""
    return F.coalesce(F.hll_sketch_estimate(sketch), F.lit(0))


def count_between(table: DataFrame, keys: Sequence[str] = (), between: tuple | None = None, name: str = "n_distinct") -> DataFrame:
    """``keys…, name``: distinct values over a range of periods, from stored sketches."""
    return merged(table, keys, between).select(*keys, estimate().alias(name))
