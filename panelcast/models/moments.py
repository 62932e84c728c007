"""Regression moments of a panel as a mergeable table, and ARIMA fitted from them.

A least-squares fit needs of a series only the sums of products of its regressors. They are taken by one
partial and final aggregate over panel rows, so no series is ever packed into a row, and they add up: moments
of parts of the calendar merge to those of the whole, and a stored table is brought up to date with the
moments of the new periods alone. Sums are of unscaled values; the scale (and the mean of a series that is not
differenced) is applied when the equations are solved, so neither spoils the addition.

The result is the two-stage fit of ``arima``: the same equations, solved from a table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from panelcast.models import kernels
from panelcast.models.arima import min_length
from panelcast.operators.features import series_order
from panelcast.session import materialize

WHOLE = "_whole"


def lagged_rows(
    panel: DataFrame, keys: Sequence[str] = (), d: int = 1, lags: int = 4, target: str = "sales", order: str = "period"
) -> DataFrame:
    """``keys…, order, y, w, w1 … wk``: values differenced ``d`` times with the ``lags`` ones before them (null
    at the beginning of a series). All windows share one exchange by key."""
    spec = series_order(keys, order)
    rows = panel.select(*keys, order, F.col(target).cast("double").alias("y")).withColumn("w", F.col("y"))
    for _ in range(d):
        rows = rows.withColumn("w", F.col("w") - F.lag("w", 1).over(spec))
    return rows.withColumns({f"w{i}": F.lag("w", i).over(spec) for i in range(1, lags + 1)})


def moments(rows: DataFrame, keys: Sequence[str], regressors: Sequence[str], target: str) -> DataFrame:
    """``keys…, n, peak, points, total, sums, cross, target_sum, target_cross, target_square``.

    Rows with a null regressor or target only count for ``points`` (rows), ``total`` and ``peak`` (sum and largest
    size of ``y``). ``sums`` are the regressors' own, ``cross`` the lower triangle of their products by rows,
    ``target_cross`` the products with the target.
    """
    whole = reduce(Column.__and__, [F.col(c).isNotNull() for c in (*regressors, target)])

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(F.when(whole, value)), F.lit(0.0))

    products = [F.col(a) * F.col(b) for i, a in enumerate(regressors) for b in regressors[: i + 1]]
    return rows.groupBy(*keys).agg(
        F.count(F.when(whole, 1)).alias("n"),
        F.max(F.abs("y")).alias("peak"),
        F.count("y").alias("points"),
        F.sum("y").alias("total"),
        F.array(*[total(F.col(c)) for c in regressors]).alias("sums"),
        F.array(*[total(x) for x in products]).alias("cross"),
        total(F.col(target)).alias("target_sum"),
        F.array(*[total(F.col(c) * F.col(target)) for c in regressors]).alias("target_cross"),
        total(F.col(target) * F.col(target)).alias("target_square"),
    )


def merge(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Moments of the rows that share ``keys``, added up: parts of a calendar, or a stored table united with the
    moments of new periods. Both must hold the same regressors."""
    sizes = table.select(F.max(F.size("sums")), F.max(F.size("cross"))).first()
    k, cells = (x or 0 for x in sizes)

    def added(name: str, size: int) -> Column:
        return F.array(*[F.sum(F.get(name, F.lit(i))) for i in range(size)]).alias(name)

    return table.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.max("peak").alias("peak"),
        F.sum("points").alias("points"),
        F.sum("total").alias("total"),
        added("sums", k),
        added("cross", cells),
        F.sum("target_sum").alias("target_sum"),
        added("target_cross", k),
        F.sum("target_square").alias("target_square"),
    )


def _solved(table: DataFrame, centre: Column, name: str) -> DataFrame:
    """Add the solution ``name`` of every row's equations, scaled by the peak; null where there is none."""
    solve = pandas_udf(kernels.solve_moments, T.ArrayType(T.DoubleType()))
    return table.withColumn(name, solve("n", "peak", centre, "sums", "cross", "target_sum", "target_cross"))


def arima_coefficients(
    panel: DataFrame, keys: Sequence[str] = (), order: tuple[int, int, int] = (2, 1, 1), target: str = "sales", period: str = "period"
) -> DataFrame:
    """``keys…, n, coef, adjusted`` of every series long enough for the order: the coefficients of
    ``arima.estimate``, from two moment tables. A failed solve has null coefficients."""
    p, d, q = order
    if p + q == 0:
        raise ValueError("an order without coefficients has no equations")
    m = max(p, q) + 2 if q else p
    own = list(keys) or [WHOLE]
    if not keys:
        panel = panel.withColumn(WHOLE, F.lit(0))
    rows = materialize(lagged_rows(panel, own, d, max(m, p), target, period), "lags")
    centre = F.lit(0.0) if d else F.col("total") / F.col("points")
    first = _solved(moments(rows, own, [f"w{i}" for i in range(1, m + 1)], "w"), centre, "long")
    first = first.where(F.col("points") >= min_length(order))
    if q == 0:
        found = first.withColumnRenamed("long", "raw")
    else:
        # Residuals of the long regression, in the units of y.
        met = rows.join(first.select(*own, "long", "points", "total"), own)
        mean = centre if d == 0 else F.lit(0.0)
        ahead = sum((F.get("long", F.lit(i)) * (F.col(f"w{i + 1}") - mean) for i in range(m)), F.lit(0.0))
        met = met.withColumn("e", F.col("w") - mean - ahead)
        spec = series_order(own, period)
        met = met.withColumns({f"e{j}": F.lag("e", j).over(spec) for j in range(1, q + 1)})
        # Centred like the regression of the kernel; the residuals have no mean taken off.
        met = met.withColumns({f"w{i}": F.col(f"w{i}") - mean for i in range(1, p + 1)} | {"w": F.col("w") - mean})
        names = [f"w{i}" for i in range(1, p + 1)] + [f"e{j}" for j in range(1, q + 1)]
        found = _solved(moments(met, own, names, "w"), F.lit(0.0), "raw")
    fields = [T.StructField("coef", T.ArrayType(T.DoubleType())), T.StructField("adjusted", T.BooleanType())]
    limit = pandas_udf(kernels.stable_rows(p), T.StructType(fields))
    out = found.withColumn("_arma", limit("raw"))
    return out.select(*keys, F.col("points").alias("n"), F.col("_arma.coef").alias("coef"), F.col("_arma.adjusted").alias("adjusted"))
