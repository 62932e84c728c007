"""Back-tests and forecasts of a whole panel with a choice of models."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.functions.calendar import resolve_freq
from panelcast.models import additive, arima, sequence, smoothing
from panelcast.models.series import (
    explode_forecast,
    explode_test,
    hold_out,
    series_arrays,
    with_horizon,
)
from panelcast.operators.metrics import relative_band
from panelcast.session import materialize

MODELS = ("arima", "holt_winters", "additive", "sequence")
DEFAULT_HORIZON = 6
BAND = 0.08


def _check(models: Sequence[str]) -> list[str]:
    unknown = [m for m in models if m not in MODELS]
    if unknown or not models:
        raise ValueError(f"models are a non-empty choice of {MODELS}, got {list(models)}")
    return list(dict.fromkeys(models))


def _season(season: int | None, freq: str) -> int:
    return resolve_freq(freq).season_length if season is None else int(season)


def _tagged(rows: DataFrame, model: str, variant: Column | None = None) -> DataFrame:
    """``model`` is what was asked for, ``variant`` what was used."""
    used = F.col("model") if variant is None else variant
    return rows.withColumn("variant", used).withColumn("model", F.lit(model))


def _packed(panel: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """The series that all models read; each packs the stored panel into tasks by its points. The single
    series of a panel without keys is stored packed."""
    packed = series_arrays(panel, keys)
    return materialize(packed, "series") if len(names) > 1 and not keys else packed


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def backtest(
    panel: DataFrame,
    keys: Sequence[str] = (),
    freq: str = "MS",
    models: Sequence[str] = MODELS,
    test_ratio: float = 0.2,
    fit_scope: str = "train",
    season: int | None = None,
    order: tuple[int, int, int] = (2, 1, 1),
    sequence_kind: str = "linear",
    length: int = sequence.DEFAULT_LENGTH,
    calendar: bool = False,
    sequence_model: sequence.SequenceModel | None = None,
) -> DataFrame:
    """Predictions of the held-out periods: ``keys…, model, variant, ds, y, yhat, status``.

    Every model is scored on the same dates; a series that a model cannot read is predicted by the
    smoother, as ``variant`` tells. ``fit_scope='all'`` (smoothing and additive models) fits on the
    whole series and reads the in-sample values of the test periods. A series under five points has
    one row per model with ``status='too_short'`` and nothing to score. ``calendar`` adds calendar
    features to the inputs of the sequence model; ``sequence_model`` is used as it is instead of training one.
    """
    names, m = _check(models), _season(season, freq)
    packed = _packed(panel, keys, names)
    marked = hold_out(packed, freq, test_ratio, fit_scope)
    series = marked.where(F.col("status") == "ok")
    in_sample = fit_scope == "all"
    if in_sample and set(names) - {"holt_winters", "additive"}:
        raise ValueError("fit_scope='all' is for the models 'holt_winters' and 'additive'")
    parts = []
    for name in names:
        if name == "holt_winters":
            parts.append(_tagged(_smoothing_test(series, keys, freq, m, in_sample), name))
        elif name == "arima":
            fitted = arima.forecast_array(arima.fit(series, order), order)
            parts.append(_tagged(explode_test(fitted, keys, freq, F.col("model")), name))
        elif name == "additive":
            # Where there is no curve (too few points, or a failed solve) the smoother stands in.
            fitted = additive.fit(series)
            if in_sample:
                parts.append(_tagged(additive.predict_test(fitted, keys), name))
                parts.append(_tagged(_smoothing_test(fitted.where(F.col("curve").isNull()), keys, freq, m, True), name))
            else:
                parts.append(_tagged(additive.predict_test_all(additive.stood_in(fitted, m), keys, freq), name))
        else:
            model = sequence_model or _trained(series, keys, sequence_kind, length, calendar)
            if model is not None:
                parts.append(_tagged(sequence.predict_test(model, series, keys), name))
            rest = series.where(~sequence.usable(model))
            parts.append(_tagged(_smoothing_test(rest, keys, freq, m, in_sample), name))
    scored = _union(parts).withColumn("status", F.lit("ok"))
    return scored.unionByName(_unscored(marked, keys, names, scored))


def _unscored(marked: DataFrame, keys: Sequence[str], names: Sequence[str], like: DataFrame) -> DataFrame:
    """A row for each model and series without a test part."""
    label = F.explode(F.array(*[F.lit(x) for x in names])).alias("model")
    rows = marked.where(F.col("status") != "ok").select(*keys, label, "status")
    absent = [F.lit(None).cast(like.schema[c].dataType).alias(c) for c in ("variant", "ds", "y", "yhat")]
    return rows.select(*keys, "model", *absent, "status")


def _smoothing_test(series: DataFrame, keys: Sequence[str], freq: str, m: int, in_sample: bool) -> DataFrame:
    fitted = smoothing.smooth(series, m)
    if not in_sample:
        return explode_test(smoothing.forecast_array(fitted), keys, freq, F.col("model"))
    # The start of the test part bounds the in-sample rows; no join is needed.
    first = F.element_at("test_periods", 1)
    values = smoothing.fitted_values(fitted.withColumn("_first", first), [*keys, "_first"], m)
    return values.where(F.col("period") >= F.col("_first")).select(
        *keys, "model", F.col("period").alias("ds"), F.col("sales").alias("y"), F.col("fitted").alias("yhat")
    )


def forecast(
    panel: DataFrame,
    keys: Sequence[str] = (),
    freq: str = "MS",
    models: Sequence[str] = MODELS,
    horizon: int = DEFAULT_HORIZON,
    season: int | None = None,
    order: tuple[int, int, int] = (2, 1, 1),
    sequence_kind: str = "linear",
    length: int = sequence.DEFAULT_LENGTH,
    calendar: bool = False,
    band: float = BAND,
    history: bool = False,
    sequence_model: sequence.SequenceModel | None = None,
) -> DataFrame:
    """Future periods of every series, fitted on its whole history:
    ``keys…, model, variant, ds, yhat, yhat_lower, yhat_upper``.

    The additive model has its own band, the others a relative one. A series that a model cannot read
    is forecast by the smoother, as ``variant`` tells. ``history`` puts the fitted values of the
    smoothing and additive models, with their bands, before the forecast. ``sequence_model`` is used as it is
    instead of training one.
    """
    names, m = _check(models), _season(season, freq)
    if horizon < 1:
        raise ValueError("horizon is at least 1")
    if history and set(names) - {"holt_winters", "additive"}:
        raise ValueError("history is for the models 'holt_winters' and 'additive'")
    series = with_horizon(_packed(panel, keys, names), horizon)
    parts = []
    for name in names:
        if name == "holt_winters":
            fitted = smoothing.smooth(series, m)
            parts.append(_future(smoothing.forecast_array(fitted), keys, freq, name, band))
            if history:
                parts.append(_past(fitted, keys, m, name, band))
        elif name == "arima":
            fitted = arima.forecast_array(arima.fit(series, order), order)
            parts.append(_future(fitted, keys, freq, name, band))
        elif name == "additive":
            fitted = additive.fit(series)
            if history:
                parts.append(_tagged(additive.forecast(fitted, keys, freq), name))
                rest = smoothing.smooth(fitted.where(F.col("curve").isNull()), m)
                parts.append(_future(smoothing.forecast_array(rest), keys, freq, name, band))
                parts.append(_past(rest, keys, m, name, band))
            else:
                parts.append(_tagged(additive.forecast_all(additive.stood_in(fitted, m), keys, freq, band), name))
        else:
            model = sequence_model or _trained(series, keys, sequence_kind, length, calendar)
            if model is not None:
                path = sequence.forecast_array(model, series, horizon, freq).withColumn("model", F.lit(name))
                parts.append(_future(path, keys, freq, name, band))
            rest = smoothing.smooth(series.where(~sequence.usable(model)), m)
            parts.append(_future(smoothing.forecast_array(rest), keys, freq, name, band))
    return _union([p.select(*_forecast_columns(keys)) for p in parts])


def _forecast_columns(keys: Sequence[str]) -> list[str]:
    return [*keys, "model", "variant", "ds", "yhat", "yhat_lower", "yhat_upper"]


def _future(fitted: DataFrame, keys: Sequence[str], freq: str, name: str, band: float) -> DataFrame:
    rows = explode_forecast(fitted, keys, freq, ["model"])
    return relative_band(_tagged(rows, name), share=band)


def _past(fitted: DataFrame, keys: Sequence[str], m: int, name: str, band: float) -> DataFrame:
    """Fitted history with its band; periods that only start the recursion have no value."""
    rows = smoothing.fitted_values(fitted, keys, m)
    rows = rows.select(*keys, "model", F.col("period").alias("ds"), F.col("fitted").alias("yhat"))
    return relative_band(_tagged(rows, name), share=band)


def _trained(series: DataFrame, keys: Sequence[str], kind: str, length: int, calendar: bool, **options):
    rows = sequence.training_rows(series, keys, length)
    return sequence.fit(rows, length, kind, calendar=calendar, **options)


def train_sequence(
    panel: DataFrame,
    keys: Sequence[str] = (),
    kind: str = "linear",
    length: int = sequence.DEFAULT_LENGTH,
    calendar: bool = False,
    **options,
) -> sequence.SequenceModel | None:
    """The sequence model of a whole panel, to be stored and used again; none where no series is long enough.
    ``options`` are those of :func:`sequence.fit` (rounds, depth, seed)."""
    return _trained(series_arrays(panel, keys), keys, kind, length, calendar, **options)


def save_sequence(model: sequence.SequenceModel, path: str, mode: str = "errorifexists") -> None:
    """Write the model as a table of one row."""
    sequence.to_table(model).coalesce(1).write.mode(mode).parquet(path)


def load_sequence(spark: SparkSession, path: str) -> sequence.SequenceModel:
    return sequence.from_table(spark.read.schema(sequence.MODEL_SCHEMA).parquet(path))


def fit_parameters(
    panel: DataFrame,
    keys: Sequence[str] = (),
    model: str = "holt_winters",
    freq: str = "MS",
    season: int | None = None,
    order: tuple[int, int, int] = (2, 1, 1),
    sequence_model: sequence.SequenceModel | None = None,
) -> DataFrame:
    """One row of parameters and state per series, ready to be stored as a table. That of ``'sequence'`` has the
    scale and last values of each series under ``sequence_model``, which is stored by itself."""
    series = series_arrays(panel, keys)
    if model == "holt_winters":
        return smoothing.parameters(smoothing.smooth(series, _season(season, freq)), keys)
    if model == "arima":
        return arima.parameters(arima.fit(series, order), keys)
    if model == "sequence":
        if sequence_model is None:
            raise ValueError("the states of 'sequence' belong to a model, see train_sequence")
        rows = sequence.states(sequence_model, series, keys)
        rest = smoothing.smooth(series.where(~sequence.usable(sequence_model)), _season(season, freq))
        # One table: a row has the values before the forecast, or the state of the smoother that stands in.
        return rows.unionByName(smoothing.parameters(rest, keys), allowMissingColumns=True)
    if model == "additive":
        # One table: a row has a curve, or the state of the smoother that stands in for it.
        stood = additive.stood_in(additive.fit(series), _season(season, freq))
        state = smoothing.parameters(stood, [*keys, "curve"])
        return state.select(*keys, "model", "n", "last_period", "curve", "alpha", "beta", "gamma", "sse", "level", "trend", "season")
    raise ValueError(f"models are {MODELS}, got {model!r}")


def forecast_parameters(
    params: DataFrame,
    keys: Sequence[str] = (),
    model: str = "holt_winters",
    freq: str = "MS",
    horizon: int = DEFAULT_HORIZON,
    order: tuple[int, int, int] = (2, 1, 1),
    band: float = BAND,
    sequence_model: sequence.SequenceModel | None = None,
) -> DataFrame:
    """Forecast from stored parameter rows, without the history: the columns of :func:`forecast`.

    A filter on the keys of the stored table gives one city's forecast without refitting."""
    if model == "additive":
        curves = with_horizon(params.where(F.col("curve").isNotNull()), horizon)
        rows = _tagged(additive.forecast(curves, keys, freq, history=False), model)
        states = smoothing.forecast_parameters(params.where(F.col("curve").isNull()), horizon)
        columns = _forecast_columns(keys)
        rows = rows.select(*columns).unionByName(_future(states, keys, freq, model, band).select(*columns))
    elif model == "sequence":
        if sequence_model is None:
            raise ValueError("the states of 'sequence' belong to a model, see load_sequence")
        own = sequence.forecast_states(sequence_model, params.where(F.col("seq").isNotNull()), horizon, freq)
        rest = smoothing.forecast_parameters(params.where(F.col("seq").isNull()), horizon)
        columns = _forecast_columns(keys)
        rows = _future(own, keys, freq, model, band).select(*columns)
        rows = rows.unionByName(_future(rest, keys, freq, model, band).select(*columns))
    elif model == "arima":
        rows = _future(arima.forecast_array(with_horizon(params, horizon), order), keys, freq, model, band)
    else:
        rows = _future(smoothing.forecast_parameters(params, horizon), keys, freq, model, band)
    return rows.select(*_forecast_columns(keys))


def comparison_series(
    split_panel: DataFrame, predictions: DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """Long table behind a forecast chart: ``keys…, series, ds, value`` with the train part, the
    actual test part and one series per model."""
    ok = split_panel.where(F.col("status") == "ok")
    label = F.when(F.col("split") == "train", "train").otherwise("actual")
    observed = ok.select(*keys, label.alias("series"), F.col("period").alias("ds"), F.col("sales").alias("value"))
    predicted = predictions.select(*keys, F.col("model").alias("series"), "ds", F.col("yhat").alias("value"))
    return observed.unionByName(predicted)


def history_and_forecast(fitted: DataFrame, future: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Fitted history followed by the forecast, both with a relative band:
    ``keys…, ds, yhat, yhat_lower, yhat_upper``."""
    past = fitted.select(*keys, F.col("period").alias("ds"), F.col("fitted").alias("yhat"))
    return relative_band(past.unionByName(future.select(*keys, "ds", "yhat")), share=BAND)
