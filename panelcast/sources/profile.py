"""Table profile and load summary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_profile(df: DataFrame, order_by: str) -> DataFrame:
    """One row per column: position, name, type, first value, plus table row/column counts.

    "First" is the row with the smallest ``order_by``, so the answer does not depend on
    how files are split. One pass, one row of state per task.
    """
    columns = df.columns
    first = F.min_by(F.struct(*[F.col(c).cast("string").alias(c) for c in columns]), F.col(order_by))
    totals = df.agg(F.count(F.lit(1)).alias("n_rows"), first.alias("first"))
    entries = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(c).alias("column_name"),
                F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
                F.col("first")[c].alias("sample"),
            )
            for i, c in enumerate(columns)
        ]
    )
    return totals.select("n_rows", F.lit(len(columns)).alias("n_columns"), F.inline(entries))


def summary_parts(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Row counts and date ranges per distinct combination of ``dims``: a small table that can
    be joined to dimensions in place of the facts."""
    return df.groupBy(*dims).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("date").alias("_lo"), F.max("date").alias("_hi")
    )


def summary_from_parts(parts: DataFrame, n_columns: int, distinct: Mapping[str, str]) -> DataFrame:
    """Finish a summary; ``distinct`` maps columns to the names of their distinct counts."""
    return parts.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("n_rows"),
        F.lit(n_columns).alias("n_columns"),
        F.min("_lo").cast("date").alias("first_date"),
        F.max("_hi").cast("date").alias("last_date"),
        *[F.count_distinct(column).alias(name) for column, name in distinct.items()],
    )


def load_summary(df: DataFrame, city_col: str = "City", store_col: str = "Store_ID") -> DataFrame:
    """Rows, columns, date range, distinct cities and distinct stores of a fact table.

    Rows are first reduced to distinct (city, store) pairs with partial sums, so the
    distinct counts never expand the raw facts. Columns that are absent are left out.
    """
    names = {city_col: "n_cities", store_col: "n_stores"}
    distinct = {c: n for c, n in names.items() if c in df.columns}
    return summary_from_parts(summary_parts(df, list(distinct)), len(df.columns), distinct)
