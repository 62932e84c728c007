"""Totals, shares, pivots and key figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions import money

# Column labels of the year-by-month table.
MONTH_LABELS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def totals_by(df: DataFrame, group: str, value: str = "Revenue", scale: int | None = None) -> DataFrame:
    """Sum of ``value`` per non-null ``group``; unordered."""
    amount = money.addable(F.col(value), df.schema[value].dataType, scale)
    return (
        df.where(F.col(group).isNotNull())
        .groupBy(group)
        .agg(F.coalesce(F.sum(amount).cast("double"), F.lit(0.0)).alias(value))
    )


def ranked_totals(df: DataFrame, group: str, value: str = "Revenue", scale: int | None = None) -> DataFrame:
    """Totals, largest first, ties by name."""
    return totals_by(df, group, value, scale).orderBy(F.desc(value), group)


def share_of_total(totals: DataFrame, value: str = "Revenue", digits: int = 1) -> DataFrame:
    """Add ``share``: percent of the grand total, which is a scalar subquery."""
    grand = totals.agg(F.sum(value)).scalar()
    return totals.withColumn("share", F.round(F.col(value) / grand * 100, digits))


def category_share(
    df: DataFrame, group: str = "Category", value: str = "Revenue", scale: int | None = None
) -> DataFrame | None:
    """Totals and shares by ``group``, or nothing when the table has no such column."""
    if group not in df.columns:
        return None
    return share_of_total(totals_by(df, group, value, scale), value)


def year_month_pivot(
    df: DataFrame, value: str = "Revenue", scale: int | None = None, date_col: str = "date"
) -> DataFrame:
    """One row per year, one column per calendar month; absent months are null."""
    amount = money.addable(F.col(value), df.schema[value].dataType, scale)
    day = F.col(date_col).cast("date")
    monthly = (
        df.where(F.col(date_col).isNotNull())
        .select(F.year(day).alias("year"), F.month(day).alias("_month"), amount.alias("_value"))
        .groupBy("year", "_month")
        .agg(F.sum("_value").cast("double").alias("_total"))
    )
    cells = [
        F.max(F.when(F.col("_month") == i, F.col("_total"))).alias(label)
        for i, label in enumerate(MONTH_LABELS, start=1)
    ]
    return monthly.groupBy("year").agg(*cells)


def kpi_row(panel: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Number of periods, total, mean, peak value and its (earliest) period."""
    peak = F.min(F.struct((-F.col("sales")).alias("_sales"), "period"))  # of equal sales the earliest
    return panel.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_periods"),
        F.sum("sales").alias("total_sales"),
        F.avg("sales").alias("mean_sales"),
        peak.alias("_peak"),
    ).select(
        *keys,
        "n_periods",
        "total_sales",
        "mean_sales",
        (-F.col("_peak._sales")).alias("peak_sales"),
        F.col("_peak.period").alias("peak_period"),
    )


def distinct_sorted(df: DataFrame, column: str = "City") -> DataFrame:
    if column not in df.columns:
        raise ValueError(f"column {column!r} not found among {df.columns}")
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def distinct_first_seen(df: DataFrame, column: str = "City", date_col: str = "date") -> DataFrame:
    """Distinct values, nulls included, by first appearance in time."""
    return (
        df.groupBy(column)
        .agg(F.min(F.col(date_col).cast("date")).alias("first_date"))
        .orderBy("first_date", F.col(column).asc_nulls_last())
    )


def count_distinct_values(df: DataFrame, column: str = "Store_ID", approximate: bool = False) -> DataFrame:
    rule = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(rule(column).alias(f"n_{column}"))
