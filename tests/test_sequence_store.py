"""The sequence model as stored numbers: trees as arrays, states of series, forecasts without training."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from panelcast.functions.calendar import shift_label
from panelcast.models import forest, sequence
from panelcast.models.series import series_arrays, with_horizon
from panelcast.operators.scale import unscale_value
from panelcast.plans import forecasting
from tests.helpers import panel, seasonal_values

SERIES = {f"c{i}": seasonal_values(48, i, slope=3.0 * i) for i in range(6)} | {"few": [3.0, 4.0, 5.0, 4.0], "one": [2.0]}
KINDS = [("linear", False), ("linear", True), ("gbt", False), ("gbt", True)]


@pytest.fixture(scope="module")
def data(spark):
    return panel(spark, SERIES)


@pytest.fixture(scope="module", params=KINDS, ids=lambda k: f"{k[0]}-{k[1]}")
def model(request, data):
    kind, calendar = request.param
    options = {"rounds": 12, "depth": 3} if kind == "gbt" else {}
    return forecasting.train_sequence(data, ["City"], kind, calendar=calendar, **options)


def values(df):
    return {(r["City"], r["ds"]): (r["variant"], r["yhat"]) for r in df.collect()}


def same(a, b):
    assert set(a) == set(b)
    assert all(a[k][0] == b[k][0] and a[k][1] == pytest.approx(b[k][1], rel=1e-9) for k in a)


def chained(model, series, horizon):
    """The recursion as one transform of the trained model after another."""
    rows = sequence.states(model, series, ["City"])
    out = F.array().cast("array<double>")
    rows = rows.withColumn("path", out)
    for k in range(1, horizon + 1):
        rows = model.predict(rows.withColumn("ds", shift_label(F.col("last_period"), "MS", F.lit(k))), "next")
        rows = rows.withColumns({"path": F.concat("path", F.array("next")), "seq": F.concat(F.slice("seq", 2, 5), F.array("next"))}).drop("next", "ds")
    unscaled = F.transform("path", lambda z: unscale_value(z, F.col("low"), F.col("high")))
    return {r["City"]: r["y"] for r in rows.select("City", unscaled.alias("y")).collect()}


def test_fold_is_the_chain(data, model):
    series = with_horizon(series_arrays(data, ["City"]), 5)
    expected = chained(model, series, 5)
    found = {r["City"]: r["yhat"] for r in sequence.forecast_array(model, series, 5).collect()}
    assert set(found) == {c for c, ys in SERIES.items() if len(ys) >= 6}
    assert all(found[c] == pytest.approx(expected[c], rel=1e-9) for c in found)


def test_plan_does_not_grow_with_the_horizon(data, model):
    series = series_arrays(data, ["City"])

    def size(horizon):
        return sequence.forecast_array(model, with_horizon(series, horizon), horizon)._jdf.queryExecution().optimizedPlan().toString()

    assert abs(len(size(24)) - len(size(3))) < 20


def test_read_in_another_session(spark, data, model, tmp_path, monkeypatch):
    trained = values(forecasting.forecast(data, ["City"], "MS", ["sequence"], 4, sequence_model=model))
    forecasting.save_sequence(model, f"{tmp_path}/model")
    forecasting.fit_parameters(data, ["City"], "sequence", sequence_model=model).write.parquet(f"{tmp_path}/states")
    monkeypatch.setattr(sequence, "fit", None)  # nothing is trained from here on
    other = spark.newSession()
    again = forecasting.load_sequence(other, f"{tmp_path}/model")
    assert again.regressor is None and again.rule == model.rule and again.is_linear == model.is_linear
    stored = forecasting.forecast_parameters(other.read.parquet(f"{tmp_path}/states"), ["City"], "sequence", horizon=4, sequence_model=again)
    same(values(stored), trained)
    same(values(forecasting.forecast(data, ["City"], "MS", ["sequence"], 4, sequence_model=again)), trained)
    tested, retested = (
        {(r["City"], r["ds"]): (r["variant"], r["yhat"]) for r in forecasting.backtest(data, ["City"], "MS", ["sequence"], sequence_model=m).where("status = 'ok'").collect()}
        for m in (model, again)
    )
    same(tested, retested)


def test_forest_walks_like_the_ensemble(spark, data):
    rows = sequence.training_rows(series_arrays(data, ["City"]), ["City"])
    fitted = sequence.fit(rows, kind="gbt", rounds=15, depth=4)
    flat = fitted.rule
    assert len(flat.roots) == len(fitted.regressor.trees) and flat.depth <= 4
    scored = fitted.regressor.transform(rows.withColumn("features", array_to_vector("seq"))).withColumn("walked", flat.predict(F.col("seq")))
    found = np.array([(r["prediction"], r["walked"]) for r in scored.collect()])
    np.testing.assert_allclose(found[:, 0], found[:, 1], rtol=1e-12, atol=1e-15)


def test_a_forest_of_leaves(spark):
    leaf = forest.Forest((0, 1), (-1, -1), (0.0, 0.0), (-1, -1), (-1, -1), (1.5, -0.25))
    assert leaf.depth == 0
    assert spark.range(1).select(leaf.predict(F.array(F.lit(1.0))).alias("v")).first()["v"] == 1.25


def test_short_series_keep_their_stand_in(data, model):
    states = forecasting.fit_parameters(data, ["City"], "sequence", sequence_model=model)
    rows = {r["City"]: r for r in states.collect()}
    assert set(rows) == set(SERIES) and {c for c, r in rows.items() if r["seq"] is None} == {"few", "one"}
    assert rows["few"]["model"] == "holt" and rows["one"]["model"] == "ses"


def test_refusals(spark, data):
    with pytest.raises(ValueError, match="train_sequence"):
        forecasting.fit_parameters(data, ["City"], "sequence")
    with pytest.raises(ValueError, match="load_sequence"):
        forecasting.forecast_parameters(data, ["City"], "sequence")
    with pytest.raises(ValueError, match="one row"):
        sequence.from_table(spark.createDataFrame([], sequence.MODEL_SCHEMA))
