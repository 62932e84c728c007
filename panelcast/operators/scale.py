"""Min-max scaling per series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def scale_value(x: Column, low: Column, high: Column) -> Column:
    """(x - low) / (high - low); a constant series is divided by 1."""
    return (x - low) / F.when(high == low, F.lit(1.0)).otherwise(high - low)


def unscale_value(z: Column, low: Column, high: Column) -> Column:
    return z * F.when(high == low, F.lit(1.0)).otherwise(high - low) + low


def fit_scaler(df: DataFrame, keys: Sequence[str] = (), value: str = "sales") -> DataFrame:
    """``keys…, low, high``: one row per series."""
    return df.groupBy(*keys).agg(F.min(value).alias("low"), F.max(value).alias("high"))


def _with_stats(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    if keys:
        return df.join(stats, list(keys))
    return df.withColumns(
        {"low": stats.select("low").scalar(), "high": stats.select("high").scalar()}
    )


def apply_scaler(
    df: DataFrame, stats: DataFrame, keys: Sequence[str] = (), value: str = "sales"
) -> DataFrame:
    """Add ``scaled`` from fitted statistics (for example those of the train rows only)."""
    joined = _with_stats(df, stats, keys)
    scaled = scale_value(F.col(value), F.col("low"), F.col("high"))
    return joined.withColumn("scaled", scaled).drop("low", "high")


def invert_scaler(
    df: DataFrame,
    stats: DataFrame,
    keys: Sequence[str] = (),
    scaled: str = "scaled",
    out: str = "unscaled",
) -> DataFrame:
    joined = _with_stats(df, stats, keys)
    return joined.withColumn(
        out, unscale_value(F.col(scaled), F.col("low"), F.col("high"))
    ).drop("low", "high")


def scale_series(
    df: DataFrame, keys: Sequence[str] = (), value: str = "sales", fit_on: Column | None = None
) -> DataFrame:
    """Add ``low``, ``high`` and ``scaled`` in one window pass, without a join.

    ``fit_on`` limits the rows the statistics are taken from.
    """
    whole = Window.partitionBy(*keys)
    source = F.col(value) if fit_on is None else F.when(fit_on, F.col(value))
    return df.withColumns(
        {"low": F.min(source).over(whole), "high": F.max(source).over(whole)}
    ).withColumn("scaled", scale_value(F.col(value), F.col("low"), F.col("high")))
