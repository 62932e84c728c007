"""Calendar, lag and rolling features of a panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from panelcast.functions.calendar import FESTIVE_MONTHS, calendar_columns

DEFAULT_LAGS = (1, 7, 14, 30)
DEFAULT_WINDOWS = (7, 14, 30)


def series_order(keys: Sequence[str], order: str = "period") -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(order)


def lag_columns(spec: WindowSpec, lags: Sequence[int], target: str) -> dict[str, Column]:
    return {f"lag_{k}": F.lag(target, k).over(spec) for k in lags}


def rolling_columns(spec: WindowSpec, windows: Sequence[int], target: str) -> dict[str, Column]:
    """Mean and sample deviation of the ``w`` rows before the current one; null until all
    ``w`` are present and non-null."""
    out: dict[str, Column] = {}
    for w in windows:
        frame = spec.rowsBetween(-w, -1)
        full = F.count(target).over(frame) == w
        out[f"rolling_mean_{w}"] = F.when(full, F.avg(target).over(frame))
        out[f"rolling_std_{w}"] = F.when(full, F.stddev_samp(target).over(frame))
    return out


def add_calendar(
    df: DataFrame,
    date_col: str = "period",
    festive_months=FESTIVE_MONTHS,
    fy_start: int = 4,
    month_flags: dict[str, tuple[int, ...]] | None = None,
) -> DataFrame:
    return df.withColumns(calendar_columns(F.col(date_col), festive_months, fy_start, month_flags))


def add_lags(
    df: DataFrame,
    keys: Sequence[str] = (),
    lags: Sequence[int] = DEFAULT_LAGS,
    target: str = "sales",
    order: str = "period",
) -> DataFrame:
    return df.withColumns(lag_columns(series_order(keys, order), lags, target))


def add_rolling(
    df: DataFrame,
    keys: Sequence[str] = (),
    windows: Sequence[int] = DEFAULT_WINDOWS,
    target: str = "sales",
    order: str = "period",
) -> DataFrame:
    return df.withColumns(rolling_columns(series_order(keys, order), windows, target))


def drop_incomplete(df: DataFrame) -> DataFrame:
    return df.dropna(how="any")


def feature_table(
    df: DataFrame,
    keys: Sequence[str] = (),
    lags: Sequence[int] = (1, 2, 3, 6),
    windows: Sequence[int] = (3, 6),
    target: str = "sales",
    order: str = "period",
    complete: bool = True,
) -> DataFrame:
    """All features in one projection: one exchange and one sort serve every window."""
    spec = series_order(keys, order)
    columns = calendar_columns(F.col(order))
    columns |= lag_columns(spec, lags, target)
    columns |= rolling_columns(spec, windows, target)
    out = df.withColumns(columns)
    return drop_incomplete(out) if complete else out
