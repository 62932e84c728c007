"""Column-role inference: which column is the date, which is the sales measure."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions import parsing

# Name fragments and priorities of the two roles. The list used to choose a
# sales column and the list used to show candidates differ in their last word.
DATE_WORDS = ("date", "time")
SALES_PRIORITY = ("Revenue", "Sales", "Units_Sold", "Unit_Price")
SALES_WORDS = ("sale", "revenue", "amount", "total", "income")
SALES_CANDIDATE_WORDS = ("sale", "revenue", "amount", "total", "price")


def _with_words(columns: Sequence[str], words: Sequence[str]) -> list[str]:
    return [c for c in columns if any(w in c.lower() for w in words)]


def date_candidates(columns: Sequence[str]) -> list[str]:
    return _with_words(columns, DATE_WORDS)


def sales_candidates(columns: Sequence[str]) -> list[str]:
    return _with_words(columns, SALES_CANDIDATE_WORDS)


def detect_date_column(columns: Sequence[str]) -> str:
    found = date_candidates(columns)
    if not found:
        raise ValueError(f"no date column among {list(columns)}")
    return found[0]


def detect_sales_column(columns: Sequence[str]) -> str:
    ranked = [c for c in SALES_PRIORITY if c in columns] + _with_words(columns, SALES_WORDS)
    if not ranked:
        raise ValueError(f"no sales column among {list(columns)}")
    return ranked[0]


def rename_date_role(df: DataFrame, date_col: str | None = None) -> DataFrame:
    return df.withColumnRenamed(date_col or detect_date_column(df.columns), "date")


def role_profile(df: DataFrame) -> DataFrame:
    """One row per (column, role) candidate: whether the name rule picks it, and how many of
    its values parse. One aggregation over the candidate columns only."""
    dates = date_candidates(df.columns)
    chosen_sales = _first_or_none(detect_sales_column, df.columns)
    sales = list(dict.fromkeys(sales_candidates(df.columns) + ([chosen_sales] if chosen_sales else [])))
    wanted = [(c, "date", c == dates[0]) for c in dates] + [(c, "sales", c == chosen_sales) for c in sales]
    if not wanted:
        raise ValueError(f"no date or sales candidate among {df.columns}")
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, (column, role, _) in enumerate(wanted):
        kind = df.schema[column].dataType.simpleString()
        if role == "date":
            native = kind in ("date", "timestamp", "timestamp_ntz")
            parsed = F.col(column) if native else parsing.free_date(F.col(column))
        else:
            parsed = parsing.to_number(F.col(column))
        aggs += [F.count(parsed).alias(f"ok_{i}"), F.count(column).alias(f"some_{i}")]
    entries = F.array(
        *[
            F.struct(
                F.lit(column).alias("column_name"),
                F.lit(role).alias("role"),
                F.lit(picked).alias("name_match"),
                (F.col(f"ok_{i}") / F.nullif(F.col("n"), F.lit(0))).alias("parse_rate"),
                (1 - F.col(f"some_{i}") / F.nullif(F.col("n"), F.lit(0))).alias("null_rate"),
            )
            for i, (column, role, picked) in enumerate(wanted)
        ]
    )
    return df.agg(*aggs).select(F.inline(entries))


def _first_or_none(rule, columns):
    try:
        return rule(columns)
    except ValueError:
        return None
