"""ARIMA over a panel by two-stage least squares (Hannan and Rissanen, 1982).

Stage 1 regresses the differenced series on its own lags and keeps the residuals; stage 2
regresses it on ``p`` lags and ``q`` lagged residuals. Differencing, the residual filter and
the forecast recursion are array expressions on one row per series; only the two regressions go
to NumPy, where the series of an Arrow batch are solved together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from panelcast.models import kernels, smoothing

MODEL = "arima"
_EMPTY = "cast(array() AS array<double>)"


def min_length(order: tuple[int, int, int]) -> int:
    """The fewest points that leave both regressions as many rows as unknowns."""
    p, d, q = order
    m = max(p, q) + 2
    return d + max(1, max(2 * m, m + p + 2 * q) if q else 2 * p)


def differenced(series: DataFrame, order: tuple[int, int, int]) -> DataFrame:
    """Add ``scale``, ``w`` (scaled, differenced, centred when d = 0), ``mean`` and ``tails``,
    the last value at each differencing level. Rows under the minimum length get null ``w``."""
    _, d, _ = order
    peak = "aggregate(ys, 0D, (acc, y) -> greatest(acc, abs(y)))"
    out = series.withColumn("scale", F.expr(f"coalesce(nullif({peak}, 0D), 1D)")).withColumn(
        "_level0", F.expr(f"CASE WHEN n >= {min_length(order)} THEN transform(ys, y -> y / scale) END")
    )
    for i in range(d):
        level = f"_level{i}"
        steps = f"zip_with(slice({level}, 2, size({level}) - 1), slice({level}, 1, size({level}) - 1), (b, a) -> b - a)"
        out = out.withColumn(f"_level{i + 1}", F.expr(steps))
    if d:
        tails = ", ".join(f"element_at(_level{i}, -1)" for i in range(d))
        out = out.withColumns({"mean": F.lit(0.0), "tails": F.expr(f"array({tails})"), "w": F.col(f"_level{d}")})
    else:
        mean = "aggregate(_level0, 0D, (acc, v) -> acc + v) / size(_level0)"
        out = out.withColumns({"mean": F.expr(mean), "tails": F.expr(_EMPTY)}).withColumn(
            "w", F.expr("transform(_level0, v -> v - mean)")
        )
    return out.drop(*[f"_level{i}" for i in range(d + 1)])


def _zeros(size: int) -> str:
    return f"array({', '.join(['0D'] * size)})" if size else _EMPTY


def _push(queue: str, value: str, size: int) -> str:
    """A queue of fixed size with its newest value first."""
    return f"concat(array({value}), slice({queue}, 1, {size - 1}))" if size else queue


def _dot(terms: list[str]) -> str:
    return " + ".join(f"get(coef, {i}) * {term}" for i, term in enumerate(terms)) or "0D"


def _filter(order: tuple[int, int, int]) -> str:
    """Run the fitted model over ``w``: last residuals (newest first) and squared error."""
    p, _, q = order
    fit = _dot([f"get(w, t - {i + 1})" for i in range(p)] + [f"get(x.eh, {j})" for j in range(q)])
    error = f"(get(w, t) - ({fit}))"
    return f"""aggregate(sequence({p}, size(w) - 1), named_struct('eh', {_zeros(q)}, 'sse', 0D),
        (x, t) -> named_struct('eh', {_push("x.eh", error, q)}, 'sse', x.sse + {error} * {error}))"""


def estimate(series: DataFrame, order: tuple[int, int, int] = (2, 1, 1)) -> DataFrame:
    """Add ``coef`` (p AR then q MA), ``adjusted``, ``eh``, ``wh``, ``sigma2`` to series rows."""
    p, _, q = order
    out = differenced(series, order)
    if p + q == 0:
        out = out.withColumns({"coef": F.expr(_EMPTY), "adjusted": F.lit(False)})
    else:
        fields = [T.StructField("coef", T.ArrayType(T.DoubleType())), T.StructField("adjusted", T.BooleanType())]
        regress = pandas_udf(kernels.arma_rows(p, q), T.StructType(fields))
        out = out.withColumn("_arma", regress(F.col("w")))
        out = out.withColumns({"coef": F.col("_arma.coef"), "adjusted": F.col("_arma.adjusted")}).drop("_arma")
    out = out.withColumn("_run", F.expr(f"CASE WHEN w IS NOT NULL THEN {_filter(order)} END"))
    newest = f"CASE WHEN w IS NOT NULL THEN transform(sequence(1, {max(p, 1)}), i -> get(w, size(w) - i)) END"
    return out.withColumns(
        {
            "eh": F.col("_run.eh"),
            "wh": F.expr(newest),
            "sigma2": F.expr(f"_run.sse / (size(w) - {p}) * scale * scale"),
        }
    ).drop("_run")


def recursion(order: tuple[int, int, int]) -> str:
    """SQL of the forecast array from the state columns of :func:`estimate`."""
    p, d, q = order
    ahead = _dot([f"get(x.wh, {i})" for i in range(p)] + [f"get(x.eh, {j})" for j in range(q)])
    path = f"""aggregate(sequence(1, steps), named_struct('wh', wh, 'eh', eh, 'out', {_EMPTY}),
        (x, k) -> named_struct('wh', {_push("x.wh", ahead, max(p, 1))}, 'eh', {_push("x.eh", "0D", q)},
                               'out', concat(x.out, array({ahead}))),
        x -> transform(x.out, v -> v + mean))"""
    for level in range(d - 1, -1, -1):
        # Undo one difference: running sums from the last value of that level.
        path = f"""aggregate({path}, named_struct('last', get(tails, {level}), 'out', {_EMPTY}),
            (x, v) -> named_struct('last', x.last + v, 'out', concat(x.out, array(x.last + v))), x -> x.out)"""
    return f"transform({path}, v -> v * scale)"


def fit(series: DataFrame, order: tuple[int, int, int] = (2, 1, 1)) -> DataFrame:
    """Estimate every series; rows too short for the order, or whose solve failed, carry a trend
    smoother instead.

    ``model`` tells which: only those rows run the smoother.
    """
    n, failed = F.col("n"), F.col("w").isNotNull() & F.col("coef").isNull()
    other = F.when((n < min_length(order)) | failed, smoothing.choose_kind(n, 1))
    return (
        smoothing.smooth(estimate(series, order), 1, kind=other)
        .withColumn("model", F.coalesce("model", F.lit(MODEL)))
        .drop("start", "tail")
    )


def forecast_array(fitted: DataFrame, order: tuple[int, int, int] = (2, 1, 1), out: str = "yhat") -> DataFrame:
    """Add the forecast of ``steps`` periods to fitted rows."""
    rule = f"CASE WHEN model = '{MODEL}' THEN {recursion(order)} ELSE {smoothing.STATE_FORECAST} END"
    return fitted.withColumn(out, F.expr(rule))


def parameters(fitted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Persistable parameter rows of :func:`fit`."""
    return fitted.select(
        *keys, "model", "n", "last_period", "coef", "adjusted", "mean", "scale", "sigma2",
        "tails", "wh", "eh", "final",
    )
