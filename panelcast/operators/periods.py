"""Aggregation of facts to a panel of regular periods."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions import money
from panelcast.functions.calendar import period_label, periods_between, regrouped, resolve_freq, shift_label
from panelcast.operators.roles import detect_sales_column


def filter_equal(df: DataFrame, where: Mapping[str, object] | None) -> DataFrame:
    """Exact-equality filters; an empty or missing value means "no filter"."""
    for column, value in (where or {}).items():
        if value is None or value == "":
            continue
        if column not in df.columns:
            raise ValueError(f"column {column!r} not found among {df.columns}")
        df = df.where(F.col(column) == F.lit(value))
    return df


def to_periods(
    df: DataFrame,
    keys: Sequence[str] = (),
    freq: str = "MS",
    where: Mapping[str, object] | None = None,
    sales_col: str | None = None,
    date_col: str = "date",
    scale: int | None = None,
    fill_gaps: bool = False,
) -> DataFrame:
    """Panel ``keys…, period, sales`` with the positive period sums of ``sales_col``.

    The sum is a partial+final aggregate, so a key that owns a large part of the facts
    leaves each map task as one row per period. ``scale`` sums as an exact decimal with that
    many digits. Rows with a null date or key are left out. Periods that sum to zero or less
    disappear; ``fill_gaps`` puts the missing calendar periods back as 0. The periods of a multiple such
    as ``2W`` count from the first period of each series.
    """
    sales_col = sales_col or detect_sales_column(df.columns)
    value = money.addable(F.col(sales_col), df.schema[sales_col].dataType, scale)
    sums = (
        filter_equal(df, where)
        .dropna(subset=[date_col, *keys])
        .select(*keys, period_label(F.col(date_col), freq).alias("period"), value.alias("_value"))
        .groupBy(*keys, "period")
        .agg(F.sum("_value").alias("_total"))
    )
    if resolve_freq(freq).multiple > 1:
        first = F.min("period").over(Window.partitionBy(*keys))  # at most a row per single period
        label = regrouped(F.col("period"), F.col("_first"), freq)
        sums = sums.withColumn("_first", first).groupBy(*keys, label.alias("period")).agg(F.sum("_total").alias("_total"))
    panel = (
        sums.where(F.col("_total") > 0)
        .select(*keys, "period", F.col("_total").cast("double").alias("sales"))
    )
    return fill_period_gaps(panel, keys, freq) if fill_gaps else panel


def fill_period_gaps(panel: DataFrame, keys: Sequence[str], freq: str) -> DataFrame:
    """Insert the calendar periods missing between a series' first and last period as 0.

    Each row emits itself and the gap up to the next row, so no calendar join is needed.
    """
    f = resolve_freq(freq)
    order = Window.partitionBy(*keys).orderBy("period")
    gap = periods_between(F.col("period"), F.col("_next"), f)
    return (
        panel.withColumn("_next", F.lead("period").over(order))
        .withColumn("_step", F.explode(F.sequence(F.lit(0), F.coalesce(gap, F.lit(1)) - 1)))
        .select(
            *keys,
            shift_label(F.col("period"), f, F.col("_step")).alias("period"),
            F.when(F.col("_step") == 0, F.col("sales")).otherwise(F.lit(0.0)).alias("sales"),
        )
    )


def preview(panel: DataFrame, n: int = 8) -> DataFrame:
    """The first ``n`` periods."""
    return panel.orderBy("period", *[c for c in panel.columns if c != "period"]).limit(n)


def horizon_calendar(panel: DataFrame, keys: Sequence[str], horizon: int, freq: str = "MS") -> DataFrame:
    """The ``horizon`` labels after each series' last period: ``keys…, step, ds``."""
    last = panel.groupBy(*keys).agg(F.max("period").alias("_last"))
    return last.select(
        *keys, "_last", F.explode(F.sequence(F.lit(1), F.lit(int(horizon)))).alias("step")
    ).select(*keys, "step", shift_label(F.col("_last"), freq, F.col("step")).alias("ds"))
