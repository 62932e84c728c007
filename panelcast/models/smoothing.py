"""Exponential smoothing over a panel: seasonal, trend-only and level-only.

Each series is one row, so a fit is a projection: no join, no shuffle beyond the one that
builds the rows. Smoothing with given parameters is an ``aggregate`` over the row's values.
The search for the parameters, some seventy candidate passes per series, and the fitted values
go to NumPy in Arrow batches, where all series and candidates of a batch advance together.

The three kinds share one recursion: without a trend its weight and slope are 0, without a
season the seasonal queue holds a single 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from panelcast.models import kernels
from panelcast.models.series import explode_rows

ALPHAS = (0.1, 0.3, 0.5, 0.7, 0.9)
BETAS = (0.05, 0.2, 0.4)
GAMMAS = (0.05, 0.2, 0.4)
TREND_GRID = tuple(round(0.1 * i, 1) for i in range(1, 10))

SEASONAL, TREND, LEVEL = "holt_winters", "holt", "ses"

# Grid axes (alpha, beta, gamma) of each kind and the half steps of the pass around the winner.
SEARCH = {
    SEASONAL: ((ALPHAS, BETAS, GAMMAS), (0.1, 0.075, 0.075)),
    TREND: ((TREND_GRID, TREND_GRID, (0.0,)), (0.05, 0.05, 0.0)),
    LEVEL: ((TREND_GRID, (0.0,), (0.0,)), (0.05, 0.0, 0.0)),
}

# Row state: level l, slope b, season queue s (head = current position), squared error sse.
_LEVEL = "best.alpha * (y - x.s[0]) + (1 - best.alpha) * (x.l + x.b)"
_NEXT = f"""named_struct(
    'l', {_LEVEL},
    'b', best.beta * (({_LEVEL}) - x.l) + (1 - best.beta) * x.b,
    's', concat(slice(x.s, 2, size(x.s) - 1),
                array(best.gamma * (y - (x.l + x.b)) + (1 - best.gamma) * x.s[0])),
    'sse', x.sse + (y - (x.l + x.b + x.s[0])) * (y - (x.l + x.b + x.s[0])))"""
_FINAL = f"aggregate(tail, start, (x, y) -> {_NEXT})"

def _total(first: int, length: int) -> str:
    return f"aggregate(slice(ys, {first}, {length}), 0D, (acc, y) -> acc + y)"


def _start(m: int) -> Column:
    """First state of the row's kind: two cycles, two points or one point."""
    level = f"{_total(1, m)} / {m}"
    slope = f"({_total(m + 1, m)} - {_total(1, m)}) / {m * m}"
    return F.expr(
        f"""CASE model
        WHEN '{SEASONAL}' THEN named_struct('l', {level}, 'b', {slope},
            's', transform(slice(ys, 1, {m}), y -> y - {level}), 'sse', 0D)
        WHEN '{TREND}' THEN named_struct('l', get(ys, 1), 'b', get(ys, 1) - get(ys, 0), 's', array(0D), 'sse', 0D)
        WHEN '{LEVEL}' THEN named_struct('l', get(ys, 0), 'b', 0D, 's', array(0D), 'sse', 0D) END"""
    )


def _tail(m: int) -> Column:
    """Values after the ones used by the first state."""
    used = f"CASE model WHEN '{SEASONAL}' THEN {m} WHEN '{TREND}' THEN 2 WHEN '{LEVEL}' THEN 1 END"
    return F.expr(f"slice(ys, {used} + 1, greatest(1, size(ys)))")


def choose_kind(n: Column, m: int) -> Column:
    """Seasonal from two full cycles on, trend from three points, else level only."""
    seasonal_ok = (n >= 2 * m) if m > 1 else F.lit(False)
    return F.when(seasonal_ok, SEASONAL).when(n >= 3, TREND).otherwise(LEVEL)


def grid_search(series: DataFrame, season: int, refine: int = 1, kind: Column | None = None) -> DataFrame:
    """Add ``model, best``; ``best`` is the winning ``{sse, alpha, beta, gamma}``.

    Ties go to the smallest parameters. A row with a null ``kind`` is skipped.
    """
    m = int(season)
    kind = choose_kind(F.col("n"), m) if kind is None else kind
    fields = [T.StructField(c, T.DoubleType()) for c in ("sse", "alpha", "beta", "gamma")]
    search = pandas_udf(
        kernels.search_rows(SEARCH, m, refine), T.StructType([*fields, T.StructField("kind", T.StringType())])
    )
    found = series.withColumn("best", search(kind, F.col("ys")))
    return found.withColumn("model", F.col("best.kind"))


def run(series: DataFrame, season: int) -> DataFrame:
    """Smooth rows that have ``model`` and ``best``; adds ``start``, ``tail`` and ``final``."""
    m = int(season)
    prepared = series.withColumns({"start": _start(m), "tail": _tail(m)})
    return prepared.withColumn("final", F.expr(_FINAL))


def smooth(series: DataFrame, season: int, refine: int = 1, kind: Column | None = None) -> DataFrame:
    """Fit every series; adds ``model, best, final`` (the last state).

    A series without a finite error falls back to the level-only model, which is searched anew.
    """
    return run(grid_search(series, season, refine, kind), season)


def fixed(
    series: DataFrame, kind: str, season: int, alpha: float, beta: float = 0.0, gamma: float = 0.0
) -> DataFrame:
    """Smoothing with given parameters instead of a search."""
    beta = 0.0 if kind == LEVEL else float(beta)
    gamma = float(gamma) if kind == SEASONAL else 0.0
    best = F.expr(
        f"named_struct('sse', cast(NULL AS double), 'alpha', {float(alpha)}D, 'beta', {beta}D, 'gamma', {gamma}D)"
    )
    return run(series.withColumns({"model": F.lit(kind), "best": best}), season)


def parameters(fitted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Persistable parameter rows of :func:`smooth`."""
    return fitted.select(
        *keys,
        "model",
        "n",
        "last_period",
        F.col("best.alpha").alias("alpha"),
        F.col("best.beta").alias("beta"),
        F.col("best.gamma").alias("gamma"),
        F.col("final.sse").alias("sse"),
        F.col("final.l").alias("level"),
        F.col("final.b").alias("trend"),
        F.col("final.s").alias("season"),
    )


def project(level: str, trend: str, season: str, steps: str) -> str:
    """SQL of a forecast array: level plus trend plus the season repeated in turn."""
    return f"transform(sequence(1, {steps}), h -> {level} + h * {trend} + {season}[(h - 1) % size({season})])"


STATE_FORECAST = project("final.l", "final.b", "final.s", "steps")


def forecast_array(fitted: DataFrame, out: str = "yhat") -> DataFrame:
    """Add the forecast of ``steps`` periods to fitted rows."""
    return fitted.withColumn(out, F.expr(STATE_FORECAST))


def forecast_parameters(params: DataFrame, horizon: int, out: str = "yhat") -> DataFrame:
    """The same from persisted parameter rows."""
    return params.withColumn(out, F.expr(project("level", "trend", "season", str(int(horizon)))))


def fitted_values(fitted: DataFrame, keys: Sequence[str], season: int) -> DataFrame:
    """One-step-ahead fitted values ``keys…, model, period, sales, fitted`` of smoothed rows.

    Periods used only to start the recursion have no fitted value. Runs in Arrow batches:
    an array expression would copy the growing result at every step of a long series.
    """
    run_rows = pandas_udf(kernels.fitted_rows(int(season)), T.ArrayType(T.DoubleType()))
    values = run_rows(*[F.col(c) for c in ("model", "ys", "best.alpha", "best.beta", "best.gamma")])
    rows = explode_rows(
        fitted.withColumn("_fit", values),
        [*keys, "model", F.expr("size(ys) - size(tail)").alias("_skip"), "_fit"],
        F.arrays_zip("periods", "ys"),
        "_point",
    )
    return rows.select(
        *keys,
        "model",
        F.col("_point.periods").alias("period"),
        F.col("_point.ys").alias("sales"),
        F.expr("CASE WHEN pos >= _skip THEN get(_fit, pos - _skip) END").alias("fitted"),
    )
