"""Additive seasonal decomposition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.operators.features import series_order


def decompose(
    df: DataFrame,
    keys: Sequence[str] = (),
    period: int = 12,
    value: str = "sales",
    order: str = "period",
) -> DataFrame:
    """Add ``trend``, ``seasonal``, ``resid`` and ``status``.

    Trend is the centred moving average (half weights at the ends of an even period), null
    where the window is incomplete; the seasonal part is the mean detrended value per
    position, centred to zero. A series under two full periods has ``status='too_short'``.
    All windows share the partitioning by ``keys``, so there is one exchange.
    """
    spec = series_order(keys, order)
    half = period // 2
    centred = spec.rowsBetween(-half, half)
    size = 2 * half + 1
    total = F.sum(value).over(centred)
    if period % 2 == 0:
        ends = F.lag(value, half).over(spec) + F.lead(value, half).over(spec)
        total = total - 0.5 * ends
    step1 = df.withColumns(
        {
            "_rn": F.row_number().over(spec),
            "_n": F.count(F.lit(1)).over(Window.partitionBy(*keys)),
            "trend": F.when(F.count(value).over(centred) == size, total / period),
        }
    ).withColumns(
        {
            "status": F.when(F.col("_n") >= 2 * period, "ok").otherwise("too_short"),
            "_pos": (F.col("_rn") - 1) % period,
        }
    )
    by_position = Window.partitionBy(*keys, "_pos")
    step2 = step1.withColumn("_mean", F.avg(F.col(value) - F.col("trend")).over(by_position))
    # The first cycle holds every position once, so its sum is the sum of position means.
    first_cycle = F.when(F.col("_rn") <= period, F.col("_mean"))
    centre = F.sum(first_cycle).over(Window.partitionBy(*keys)) / period
    ok = F.col("status") == "ok"
    return (
        step2.withColumn("seasonal", F.when(ok, F.col("_mean") - centre))
        .withColumn("trend", F.when(ok, F.col("trend")))
        .withColumn("resid", F.col(value) - F.col("trend") - F.col("seasonal"))
        .drop("_rn", "_n", "_pos", "_mean")
    )
