"""Sequence regression: the next value from the ``length`` values before it.

One model is trained over the sequences of all series (min-max scaled per series), so the
training set grows with the panel and is processed by distributed ``pyspark.ml`` regressors. What was
learned, linear weights or trees, is a small row of numbers that can be stored and used again without training.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.functions.calendar import calendar_columns, shift_label
from panelcast.models.forest import Forest, flatten
from panelcast.models.series import array_total, explode_rows
from panelcast.operators.scale import scale_value, unscale_value
from panelcast.operators.split import train_size
from panelcast.session import materialize

MODEL = "sequence"
DEFAULT_LENGTH = 6
ROUNDS = 100
SEED = 42


# Calendar features offered to the regressor next to the history.
CALENDAR_INPUTS = ("dayofweek", "month", "quarter", "is_festive_month", "india_fy_quarter")


def _calendar(ds: Column) -> Column:
    columns = calendar_columns(ds)
    return F.array(*[columns[c].cast("double") for c in CALENDAR_INPUTS])


def _plain_inputs(seq: Column, ds: Column, calendar: bool) -> Column:
    return F.concat(seq, _calendar(ds)) if calendar else seq


def _inputs(seq: Column, ds: Column, calendar: bool) -> Column:
    return array_to_vector(_plain_inputs(seq, ds, calendar))


@dataclass(frozen=True)
class Linear:
    """Weights of the inputs and what is added to their sum."""

    weights: tuple[float, ...]
    bias: float

    def predict(self, inputs: Column) -> Column:
        return F.lit(self.bias) + _dot(inputs, self.weights)


def _dot(values: Column, weights: Sequence[float]) -> Column:
    return array_total(F.zip_with(values, F.array(*[F.lit(w) for w in weights]), lambda x, w: x * w))


class SequenceModel:
    """What was learned, the history length it reads, and whether it reads the calendar.

    ``regressor`` is the trained ``pyspark.ml`` model, absent where the rule comes from a table.
    """

    def __init__(self, length: int, regressor=None, calendar: bool = False, rule: Linear | Forest | None = None):
        self.length, self.regressor, self.calendar, self._rule = length, regressor, calendar, rule

    @property
    def is_linear(self) -> bool:
        return hasattr(self.regressor, "coefficients") if self._rule is None else isinstance(self._rule, Linear)

    @property
    def rule(self) -> Linear | Forest:
        if self._rule is None:
            if self.is_linear:
                self._rule = Linear(tuple(map(float, self.regressor.coefficients)), float(self.regressor.intercept))
            else:
                self._rule = flatten(SparkSession.active(), self.regressor)
        return self._rule

    def predict(self, rows: DataFrame, out: str = "predicted") -> DataFrame:
        """Add the (scaled) value that follows each ``seq`` and falls on ``ds``."""
        if self.regressor is None:
            return rows.withColumn(out, self.rule.predict(_plain_inputs(F.col("seq"), F.col("ds"), self.calendar)))
        featured = rows.withColumn("features", _inputs(F.col("seq"), F.col("ds"), self.calendar))
        scored = self.regressor.transform(featured)
        return scored.withColumnRenamed("prediction", out).drop("features")


MODEL_SCHEMA = """length int, calendar boolean, weights array<double>, bias double, roots array<int>, feature array<int>,
    threshold array<double>, left array<int>, right array<int>, value array<double>"""


def to_table(model: SequenceModel) -> DataFrame:
    """The model as one row of ``MODEL_SCHEMA``; a linear one has no trees, trees have no weights."""
    rule, spark = model.rule, SparkSession.active()
    if isinstance(rule, Linear):
        row = (list(rule.weights), rule.bias, *[None] * 6)
    else:
        row = (None, None, *(list(getattr(rule, c)) for c in ("roots", "feature", "threshold", "left", "right", "value")))
    return spark.createDataFrame([(model.length, model.calendar, *row)], MODEL_SCHEMA)


def from_table(table: DataFrame) -> SequenceModel:
    """The model of a one-row table written from :func:`to_table`; training is not repeated."""
    rows = table.limit(2).collect()
    if len(rows) != 1:
        raise ValueError("a table of one model has one row")
    row = rows[0]
    if row["weights"] is not None:
        rule = Linear(tuple(row["weights"]), row["bias"])
    else:
        rule = Forest(*(tuple(row[c]) for c in ("roots", "feature", "threshold", "left", "right", "value")))
    return SequenceModel(row["length"], calendar=row["calendar"], rule=rule)


def _bounds(series: DataFrame) -> DataFrame:
    """Add ``low`` and ``high`` of the fitted part of each series."""
    return series.withColumns({"low": F.array_min("ys"), "high": F.array_max("ys")})


def _scaled(values: str) -> Column:
    return F.transform(values, lambda y: scale_value(y, F.col("low"), F.col("high")))


def _windows(values: Column, first: Column, last: Column, length: int) -> Column:
    """Structs ``{target, seq, y}`` for the 0-based target positions ``first..last``."""
    positions = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
    return F.transform(
        positions,
        lambda t: F.struct(
            t.alias("target"),
            F.slice(values, t - length + 1, length).alias("seq"),
            F.get(values, t).alias("y"),
        ),
    )


def training_rows(
    series: DataFrame, keys: Sequence[str] = (), length: int = DEFAULT_LENGTH, train_share: float = 0.8
) -> DataFrame:
    """``keys…, target, ds, seq, y, is_val``: scaled sequences of the fitted part; the last ones of
    each series are marked for validation (early stopping), at least one is not."""
    scaled = _bounds(series).withColumn("scaled", _scaled("ys"))
    n_seq = F.size("scaled") - length
    cut = F.greatest(F.lit(1), train_size(n_seq, 1 - train_share))
    windows = _windows(F.col("scaled"), F.lit(length), F.size("scaled") - 1, length)
    rows = explode_rows(scaled, [*keys, "periods", cut.alias("_cut")], windows, "_w")
    return rows.select(
        *keys,
        F.col("_w.target").alias("target"),
        F.get("periods", F.col("_w.target")).alias("ds"),
        F.col("_w.seq").alias("seq"),
        F.col("_w.y").alias("y"),
        (F.col("pos") >= F.col("_cut")).alias("is_val"),
    )


def test_rows(series: DataFrame, keys: Sequence[str] = (), length: int = DEFAULT_LENGTH) -> DataFrame:
    """Sequences whose target is a held-out period, with the actual values before it:
    ``keys…, ds, y, low, high, seq``; ``y`` is unscaled."""
    scaled = _bounds(series).withColumn("scaled", _scaled("full_ys"))
    first = F.size("full_ys") - F.size("test_ys")
    windows = _windows(
        F.col("scaled"), F.greatest(F.lit(length), F.col("_first")), F.size("scaled") - 1, length
    )
    carried = [*keys, "low", "high", "_first", "test_periods", "test_ys"]
    rows = explode_rows(scaled.withColumn("_first", first), carried, windows, "_w")
    index = F.col("_w.target") - F.col("_first")
    return rows.select(
        *keys,
        F.get("test_periods", index).alias("ds"),
        F.get("test_ys", index).alias("y"),
        "low",
        "high",
        F.col("_w.seq").alias("seq"),
    )


def fit(
    rows: DataFrame,
    length: int = DEFAULT_LENGTH,
    kind: str = "linear",
    rounds: int = ROUNDS,
    depth: int = 3,
    seed: int = SEED,
    calendar: bool = False,
) -> SequenceModel | None:
    """Train one regressor over all rows of :func:`training_rows`; nothing where there are none.

    The rows are written once to the shared folder, so boosting rounds read a table instead of
    recomputing the panel from the facts. Boosted trees stop early on the validation rows.
    """
    inputs = _inputs(F.col("seq"), F.col("ds"), calendar)
    stored = materialize(rows, "sequences").withColumn("features", inputs)
    sides = stored.agg(F.count_distinct("is_val").alias("sides")).first()["sides"]
    if sides == 0:
        return None
    if kind == "linear":
        learner = LinearRegression(featuresCol="features", labelCol="y")
    elif kind == "gbt":
        learner = GBTRegressor(
            featuresCol="features", labelCol="y", maxIter=rounds, maxDepth=depth, seed=seed
        )
        if sides == 2:
            learner = learner.setValidationIndicatorCol("is_val")
    else:
        raise ValueError("kind is 'gbt' or 'linear'")
    return SequenceModel(length, learner.fit(stored), calendar)


def usable(model: SequenceModel | None) -> Column:
    """Whether a series has the history the model reads; none has, where no model could be trained."""
    return F.lit(False) if model is None else F.col("n") >= model.length


def predict_test(model: SequenceModel, series: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One-step predictions of the held-out periods of usable series: ``keys…, model, ds, y, yhat``."""
    scored = model.predict(test_rows(series.where(usable(model)), keys, model.length))
    yhat = unscale_value(F.col("predicted"), F.col("low"), F.col("high"))
    return scored.select(*keys, F.lit(MODEL).alias("model"), "ds", "y", yhat.alias("yhat"))


def _path(model: SequenceModel, dates: Column) -> Column:
    """Recursion over the future dates: one fold, whatever the horizon, in which each value becomes the newest
    input. What a linear rule adds for a date is known before the recursion."""
    rule, length = model.rule, model.length

    def ahead(seq: Column, extra: Column) -> Column:
        if isinstance(rule, Linear):
            return _dot(seq, rule.weights[:length]) + extra
        return rule.predict(F.concat(seq, extra) if model.calendar else seq)

    def by_date(ds: Column) -> Column:
        if isinstance(rule, Linear):
            bias = F.lit(rule.bias)
            return bias + _dot(_calendar(ds), rule.weights[length:]) if model.calendar else bias
        return _calendar(ds) if model.calendar else F.lit(0.0)

    def step(state: Column, extra: Column) -> Column:
        # The value is bound once, since both fields of the next state use it.
        return F.transform(
            F.array(ahead(state["seq"], extra)),
            lambda nxt: F.struct(
                F.concat(F.slice(state["seq"], 2, length - 1), F.array(nxt)).alias("seq"),
                F.concat(state["out"], F.array(nxt)).alias("out"),
            ),
        )[0]

    start = F.struct(F.col("seq").alias("seq"), F.array().cast("array<double>").alias("out"))
    return F.aggregate(F.transform(dates, by_date), start, step, lambda s: s["out"])


def states(model: SequenceModel, series: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Persistable rows ``keys…, model, n, last_period, low, high, seq`` of the series that the model can read: the
    scale and the last scaled values, all that a forecast needs besides the model."""
    ready = _bounds(series.where(usable(model))).withColumn("seq", F.slice(_scaled("ys"), -model.length, model.length))
    return ready.select(*keys, F.lit(MODEL).alias("model"), "n", "last_period", "low", "high", "seq")


def forecast_states(model: SequenceModel, rows: DataFrame, horizon: int, freq: str = "MS", out: str = "yhat") -> DataFrame:
    """Add a forecast array to rows of :func:`states`."""
    last = F.col("last_period")
    dates = F.transform(F.sequence(F.lit(1), F.lit(int(horizon))), lambda k: shift_label(last, freq, k))
    path = _path(model, dates)
    return rows.withColumn(out, F.transform(path, lambda z: unscale_value(z, F.col("low"), F.col("high"))))


def forecast_array(
    model: SequenceModel, series: DataFrame, horizon: int, freq: str = "MS", out: str = "yhat"
) -> DataFrame:
    """Add a forecast array by feeding each prediction back as the newest value.

    Series shorter than the history length are for another model (see ``usable``).
    """
    ready = _bounds(series.where(usable(model))).withColumn(
        "seq", F.slice(_scaled("ys"), -model.length, model.length)
    )
    return forecast_states(model, ready, horizon, freq, out).drop("seq")
