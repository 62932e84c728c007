"""Additive regression over a panel: piecewise-linear trend plus Fourier seasons.

Coefficients have Gaussian priors (tight on the slope changes), so the fit is a ridge
regression per series. Series that share a calendar share one design matrix and one
factorisation, whatever their number; forecasting is a column expression.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from panelcast.functions.calendar import day_number, periods_between, resolve_freq, shift_label
from panelcast.models import kernels, smoothing
from panelcast.models.series import explode_rows

MODEL = "additive"

BAND_Z = 1.2816  # 80 % band
MIN_POINTS = kernels.MIN_CURVE_POINTS


def _curve_type() -> T.StructType:
    numbers = kernels.CURVE_FIELDS[:4]
    return T.StructType(
        [
            T.StructField(name, T.DoubleType() if name in numbers else T.ArrayType(T.DoubleType()))
            for name in kernels.CURVE_FIELDS
        ]
    )


def curve_value(day: str, seasons=kernels.SEASONS) -> str:
    """SQL of the fitted curve at a day number; the design is rebuilt as plain arithmetic."""
    t = f"(({day}) - curve.t0) / curve.span"
    terms = [
        f"curve.trend[0] + curve.trend[1] * {t}",
        "aggregate(zip_with(curve.changes, curve.hinges, "
        f"(c, d) -> d * greatest({t} - (c - curve.t0) / curve.span, 0D)), 0D, (acc, v) -> acc + v)",
    ]
    place = 0
    for period, pairs in seasons:
        for trig in ("sin", "cos"):
            for k in range(1, pairs + 1):
                terms.append(f"curve.season[{place}] * {trig}(({day}) * {2 * math.pi * k / period!r}D)")
                place += 1
    return f"curve.scale * ({' + '.join(terms)})"


def fit(series: DataFrame, seasons=kernels.SEASONS, changes: int = kernels.MAX_CHANGEPOINTS, noise: float | None = None) -> DataFrame:
    """Add ``curve``, the parameter struct; null for series under the minimum length and for those whose solve
    failed. ``noise`` gives the noise deviation (in units of the largest value) instead of estimating it;
    the same ``seasons`` must be given to what evaluates the curve."""
    days = F.transform("periods", day_number)
    fit_curves = pandas_udf(kernels.curve_rows(tuple(seasons), changes, noise), _curve_type())
    fitted = series.withColumn("curve", fit_curves(days, F.col("ys")))
    return fitted.withColumn("curve", F.when(F.col("curve.scale").isNotNull(), F.col("curve")))


def stood_in(fitted: DataFrame, season: int) -> DataFrame:
    """Fitted rows with the smoother (``model, best, final``) where there is no curve."""
    other = F.when(F.col("curve").isNull(), smoothing.choose_kind(F.col("n"), season))
    rows = smoothing.smooth(fitted, season, kind=other)
    return rows.withColumn("model", F.coalesce("model", F.lit(MODEL)))


def parameters(fitted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Persistable parameter rows of :func:`fit`."""
    return fitted.select(*keys, F.lit(MODEL).alias("model"), "n", "last_period", "curve")


def _valued(rows: DataFrame, seasons=kernels.SEASONS) -> DataFrame:
    """Add ``yhat`` at ``ds``."""
    value = F.expr(curve_value("_day", seasons))
    return rows.withColumn("_day", day_number(F.col("ds"))).withColumn("yhat", value).drop("_day")


def _banded(rows: DataFrame) -> DataFrame:
    margin = F.expr(f"curve.sigma * curve.scale * {BAND_Z}D")
    return rows.withColumns({"yhat_lower": F.col("yhat") - margin, "yhat_upper": F.col("yhat") + margin})


def forecast(fitted: DataFrame, keys: Sequence[str], freq: str, history: bool = True, seasons=kernels.SEASONS) -> DataFrame:
    """``keys…, model, ds, yhat, yhat_lower, yhat_upper`` over history (optional) and the next
    ``steps`` periods, of the rows that have a curve."""
    f = resolve_freq(freq)
    ahead = F.transform(
        F.sequence(F.lit(1), F.col("steps")), lambda k: shift_label(F.col("last_period"), f, k)
    )
    dates = F.concat(F.col("periods"), ahead) if history else ahead
    usable = fitted.where(F.col("curve").isNotNull())
    rows = explode_rows(usable, [*keys, F.lit(MODEL).alias("model"), "curve"], dates, "ds")
    return _banded(_valued(rows, seasons)).drop("curve", "pos")


def forecast_all(stood: DataFrame, keys: Sequence[str], freq: str, band: float, seasons=kernels.SEASONS) -> DataFrame:
    """The next ``steps`` periods of every row of :func:`stood_in`, by its curve or by the smoother that stands in
    for it; one projection, so nothing is fitted twice. ``model`` tells which."""
    f = resolve_freq(freq)
    rows = explode_rows(stood, [*keys, "model", "curve", "final", "last_period"], F.sequence(F.lit(1), F.col("steps")), "_step")
    rows = rows.withColumn("ds", shift_label(F.col("last_period"), f, F.col("_step")))
    state = F.expr("final.l + _step * final.b + final.s[(_step - 1) % size(final.s)]")
    curved = F.col("curve").isNotNull()
    rows = _banded(_valued(rows, seasons))
    yhat = F.when(curved, F.col("yhat")).otherwise(state)
    rows = rows.withColumn("yhat", yhat)
    relative = {c: F.when(curved, F.col(c)).otherwise(F.col("yhat") * F.lit(1 + s * band)) for c, s in (("yhat_lower", -1), ("yhat_upper", 1))}
    return rows.withColumns(relative).select(*keys, "model", "ds", "yhat", "yhat_lower", "yhat_upper")


def predict_test(fitted: DataFrame, keys: Sequence[str], seasons=kernels.SEASONS) -> DataFrame:
    """Fitted curve on the held-out dates: ``keys…, model, ds, y, yhat``, of the rows that have a curve."""
    usable = fitted.where(F.col("curve").isNotNull())
    test = F.arrays_zip("test_periods", "test_ys")
    rows = explode_rows(usable, [*keys, F.lit(MODEL).alias("model"), "curve"], test, "_test").select(
        *keys, "model", "curve", F.col("_test.test_periods").alias("ds"), F.col("_test.test_ys").alias("y")
    )
    return _valued(rows, seasons).drop("curve")


def predict_test_all(stood: DataFrame, keys: Sequence[str], freq: str) -> DataFrame:
    """The held-out dates of every row of :func:`stood_in`: ``keys…, model, ds, y, yhat``."""
    test = F.arrays_zip("test_periods", "test_ys")
    rows = explode_rows(stood, [*keys, "model", "curve", "final", "last_period"], test, "_test")
    rows = rows.withColumns({"ds": F.col("_test.test_periods"), "y": F.col("_test.test_ys")})
    rows = rows.withColumn("_step", periods_between(F.col("last_period"), F.col("ds"), freq))
    state = F.expr("final.l + _step * final.b + final.s[(_step - 1) % size(final.s)]")
    rows = _valued(rows).withColumn("yhat", F.when(F.col("curve").isNotNull(), F.col("yhat")).otherwise(state))
    return rows.select(*keys, "model", "ds", "y", "yhat")
