import datetime as dt

import pytest

from panelcast.operators import metrics
from tests.helpers import months


def paired(spark, pairs, model="m"):
    rows = [(model, d, float(y), float(p)) for d, (y, p) in zip(months(len(pairs)), pairs, strict=True)]
    return spark.createDataFrame(rows, "model string, ds date, y double, yhat double")


def test_perfect_forecast(spark):
    got = metrics.score(paired(spark, [(1000, 1000), (2000, 2000), (3000, 3000)])).first()
    assert (got["mae"], got["rmse"], got["mape"]) == (0.0, 0.0, 0.0)


def test_known_percentage(spark):
    got = metrics.score(paired(spark, [(100, 110), (200, 180), (400, 420)]), digits=6).first()
    assert got["mape"] == pytest.approx(25 / 3, abs=1e-6)


def test_constant_error(spark):
    got = metrics.score(paired(spark, [(500, 510), (600, 610), (700, 710)])).first()
    assert got.asDict() == {"model": "m", "mae": 10.0, "rmse": 10.0, "mape": 1.7}


def test_zero_actuals(spark):
    assert metrics.score(paired(spark, [(0, 5), (10, 11)])).first()["mape"] == 10.0
    assert metrics.score(paired(spark, [(0, 5)])).first()["mape"] is None


def test_rounds_half_to_even(spark):
    got = [metrics.score(paired(spark, [(0, x)])).first()["mae"] for x in (0.125, 0.375, 2.675)]
    assert got == [0.12, 0.38, 2.68]


def test_leaderboard(spark):
    rows = [("x", "a", 1e7, 2.5e7, 5.0), ("x", "b", 2.0, 3.0, 5.0), ("x", "c", 2.0, 3.0, None), ("y", "c", 1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "City string, model string, mae double, rmse double, mape double")
    got = {(r["City"], r["model"]): r for r in metrics.leaderboard(df, ["City"], ["b", "a"]).collect()}
    assert {k for k, r in got.items() if r["is_best"]} == {("x", "b"), ("y", "c")}
    assert (got["x", "a"]["mae_text"], got["x", "a"]["rmse_text"]) == ("1.00Cr", "2.50Cr")


def test_alignment_is_by_date(spark):
    d = months(3)
    predictions = spark.createDataFrame([("m", d[0], 1.0), ("m", d[2], 3.0)], "model string, ds date, yhat double")
    actuals = spark.createDataFrame([(d[1], 20.0), (d[2], 30.0)], "period date, sales double")
    assert [(r["ds"], r["y"], r["yhat"]) for r in metrics.align(predictions, actuals).collect()] == [(d[2], 30.0, 3.0)]


def test_month_matching_and_coverage(spark):
    d = months(4)
    test = spark.createDataFrame([("a", d[1]), ("a", d[2]), ("b", d[1]), ("b", d[3])], "City string, period date")
    ends = {x: (x.replace(day=28)) for x in d}
    rows = [(c, "own", ends[x], 1.0) for c in "ab" for x in d[:3]]
    fc = spark.createDataFrame(rows, "City string, model string, ds date, yhat double")
    other = spark.createDataFrame([(c, "other", x, 2.0) for c in "ab" for x in d], fc.schema)
    kept = metrics.keep_test_months(fc, test, ["City"]).collect()
    assert sorted((r["City"], r["ds"].month) for r in kept) == [("a", 2), ("a", 3), ("b", 2)]
    chosen = metrics.choose_covering(fc, other, test, ["City"]).collect()
    assert sorted((r["City"], r["model"], r["ds"].month, r["covered"]) for r in chosen) == [
        ("a", "own", 2, True), ("a", "own", 3, True), ("b", "other", 2, False), ("b", "other", 4, False)]
    one = [x.where("City = 'b'").drop("City") for x in (fc, other, test)]
    assert {r["model"] for r in metrics.choose_covering(*one).collect()} == {"other"}


def test_band(spark):
    df = spark.createDataFrame([(100.0, dt.date(2024, 1, 1))], "yhat double, ds date")
    got = metrics.relative_band(df).first()
    assert (got["yhat_lower"], got["yhat_upper"]) == (92.0, 108.0)
