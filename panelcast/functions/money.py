"""Exact sums, rounding and display of money columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

CRORE = 10_000_000


def addable(value: Column, dtype: T.DataType, scale: int | None) -> Column:
    """``value`` ready for ``sum``: not-a-number dropped, optionally as exact decimal.

    With ``scale`` the sum does not depend on row order; without it doubles are added. An amount
    that no decimal of 26 digits before the point holds, infinity included, fails the query.
    """
    if isinstance(dtype, T.StringType):
        value = value.try_cast("double")
        dtype = T.DoubleType()
    if isinstance(dtype, T.FractionalType) and not isinstance(dtype, T.DecimalType):
        value = F.when(~F.isnan(value), value)
    if scale is not None and not isinstance(dtype, T.DecimalType):
        exact = value.try_cast(f"decimal({min(26 + scale, 38)},{scale})")
        lost = F.raise_error(F.concat(F.lit("amount out of range: "), value.cast("string"))).cast(f"decimal({min(26 + scale, 38)},{scale})")
        value = F.when(value.isNotNull() & exact.isNull(), lost).otherwise(exact)
    return value


def in_crore(value: Column, digits: int = 2) -> Column:
    """Text such as ``3.27Cr``; the numeric column is kept by the caller."""
    pattern = "0." + "0" * digits if digits else "0"
    return F.concat(F.call_function("format_number", value / CRORE, F.lit(pattern)), F.lit("Cr"))


def with_separators(value: Column, digits: int = 0) -> Column:
    return F.format_number(value, digits)
