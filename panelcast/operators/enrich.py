"""Attaching attributes (city, category) from dimension tables to facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions import money
from panelcast.functions.calendar import period_label


def attach(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Equi-join on one key that keeps every fact; one without a dimension row gets nulls. The join
    strategy is the optimizer's: a shuffled join whose hot partitions AQE splits, or a broadcast under
    its size threshold."""
    return facts.join(dim, facts[fact_key] == dim[dim_key], "left").drop(dim[dim_key])


def summed(
    facts: DataFrame,
    keys: Sequence[str],
    value: str,
    scale: int | None = None,
    freq: str | None = None,
    date_col: str = "date",
) -> DataFrame:
    """Facts summed to ``keys`` (and period): what should be joined to a dimension in place of the
    facts where only sums are wanted. A hot key leaves each map task as one row per period.
    ``date_col`` then holds the period label.
    """
    amount = money.addable(F.col(value), facts.schema[value].dataType, scale)
    group = list(keys)
    if freq is not None:
        facts = facts.withColumn(date_col, period_label(F.col(date_col), freq))
        group.append(date_col)
    return facts.groupBy(*group).agg(F.sum(amount).alias(value))
