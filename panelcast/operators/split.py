"""Time-ordered splits and sequence windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.operators.features import series_order

MIN_POINTS = 5


def train_size(n: Column, test_ratio: float) -> Column:
    """First-part size; the double product is truncated, as for a list slice."""
    return F.floor(n * F.lit(1 - test_ratio)).cast("int")


def time_split(
    df: DataFrame,
    keys: Sequence[str] = (),
    test_ratio: float = 0.2,
    min_points: int = MIN_POINTS,
    order: str = "period",
) -> DataFrame:
    """Add ``n``, ``status`` and ``split`` ('train' or 'test') to each row.

    A keyed series under ``min_points`` gets ``status='too_short'`` and no split; without
    keys the query fails, since there is nothing else to return.
    """
    whole = Window.partitionBy(*keys)
    n = F.count(F.lit(1)).over(whole).cast("int")
    out = df.withColumns({"_rn": F.row_number().over(series_order(keys, order)), "n": n})
    short = F.col("n") < min_points
    if keys:
        status = F.when(short, "too_short").otherwise("ok")
    else:
        message = F.concat(F.lit("not enough data points to split: "), F.col("n").cast("string"))
        status = F.when(short, F.raise_error(message).cast("string")).otherwise("ok")
    side = F.when(F.col("_rn") <= train_size(F.col("n"), test_ratio), "train").otherwise("test")
    return (
        out.withColumn("status", status)
        .withColumn("split", F.when(F.col("status") == "ok", side))
        .drop("_rn")
    )


def split_ranges(split: DataFrame, keys: Sequence[str] = (), order: str = "period") -> DataFrame:
    """Rows and first/last period of each side of a split."""
    return split.groupBy(*keys, "split").agg(
        F.count(F.lit(1)).cast("int").alias("n_periods"),
        F.min(order).alias("first_period"),
        F.max(order).alias("last_period"),
    )


def sequence_windows(
    df: DataFrame,
    keys: Sequence[str] = (),
    length: int = 6,
    value: str = "sales",
    order: str = "period",
) -> DataFrame:
    """``seq`` = the ``length`` previous values, ``y`` = the current one; rows without a full
    history are left out."""
    history = F.collect_list(value).over(series_order(keys, order).rowsBetween(-length, -1))
    return (
        df.withColumns({"seq": history, "y": F.col(value)})
        .where(F.size("seq") == length)
        .where(F.col("y").isNotNull())
    )


def sequence_split(
    sequences: DataFrame, keys: Sequence[str] = (), train_share: float = 0.8, order: str = "period"
) -> DataFrame:
    """Add ``seq_split``: at least one sequence of each series is in the first part."""
    whole = Window.partitionBy(*keys)
    n = F.count(F.lit(1)).over(whole)
    size = F.greatest(F.lit(1), F.floor(n * F.lit(train_share)).cast("int"))
    rank = F.row_number().over(series_order(keys, order))
    return sequences.withColumn("seq_split", F.when(rank <= size, "train").otherwise("test"))


def last_sequence(
    df: DataFrame, keys: Sequence[str] = (), length: int = 6, value: str = "sales", order: str = "period"
) -> DataFrame:
    """The last ``length`` values of each series in time order."""
    newest_first = Window.partitionBy(*keys).orderBy(F.desc(order))
    recent = df.withColumn("_age", F.row_number().over(newest_first)).where(F.col("_age") <= length)
    points = F.sort_array(F.collect_list(F.struct(order, value)))
    return (
        recent.groupBy(*keys)
        .agg(points.alias("_points"))
        .select(
            *keys,
            F.element_at(F.col("_points"), -1)[order].alias("last_period"),
            F.col("_points")[value].alias("seq"),
        )
    )
