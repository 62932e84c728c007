import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest

from panelcast.operators import features, scale, split
from panelcast.operators.decompose import decompose
from tests.helpers import panel, seasonal_values


@pytest.fixture(scope="module")
def daily(spark):
    random.seed(7)
    rows = [(dt.date(2022, 1, 1) + dt.timedelta(days=i), random.random() * 10000) for i in range(90)]
    return spark.createDataFrame(rows, "period date, sales double")


def test_lag_columns(daily):
    rows = features.add_lags(daily, lags=[1, 7, 30]).orderBy("period").collect()
    for k, count in ((1, 89), (7, 83), (30, 60)):
        assert sum(r[f"lag_{k}"] is not None for r in rows) == count
        assert rows[k][f"lag_{k}"] == rows[0]["sales"]


def test_rolling_columns(daily):
    pdf = daily.orderBy("period").toPandas()
    got = features.add_rolling(daily, windows=[7, 14]).orderBy("period").toPandas()
    for w in (7, 14):
        past = pdf["sales"].shift(1).rolling(w)
        np.testing.assert_allclose(got[f"rolling_mean_{w}"], past.mean(), rtol=1e-12)
        np.testing.assert_allclose(got[f"rolling_std_{w}"], past.std(), rtol=1e-9)
    assert got["rolling_mean_7"].notna().sum() == 83 and got["rolling_std_14"].notna().sum() == 76


def test_rolling_needs_every_value(spark):
    values = [1.0, 2.0, None, 4.0, 5.0, 6.0, 7.0]
    rows = [(dt.date(2024, 1, i + 1), v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "period date, sales double")
    got = features.add_rolling(df, windows=[2, 3]).orderBy("period").collect()
    assert [r["rolling_mean_2"] for r in got] == [None, None, 1.5, None, None, 4.5, 5.5]
    assert [r["rolling_std_3"] for r in got] == [None] * 6 + [1.0]


def test_calendar(daily):
    rows = features.add_calendar(daily, month_flags={"is_winter": (12, 1, 2)}).collect()
    assert max(r["period"] for r in rows) == dt.date(2022, 3, 31)
    assert sum(r["is_weekend"] for r in rows) == 26
    assert sum(r["is_festive_month"] for r in rows) == 31
    assert {r["india_fy_quarter"] for r in rows} == {4}
    assert sum(r["is_winter"] for r in rows) == 59
    for r in rows:
        assert r["dayofweek"] == r["period"].weekday()
        assert r["dayofyear"] == r["period"].timetuple().tm_yday


def test_fiscal_quarters(spark):
    rows = [(dt.date(2024, m, 15), 1.0) for m in range(1, 13)]
    got = features.add_calendar(spark.createDataFrame(rows, "period date, sales double")).orderBy("period")
    assert [r["india_fy_quarter"] for r in got.collect()] == [4, 4, 4, 1, 1, 1, 2, 2, 2, 3, 3, 3]


def test_feature_table_drops_incomplete(spark):
    df = panel(spark, {"a": range(1, 21), "b": range(1, 6)})
    rows = features.feature_table(df, ["City"]).collect()
    assert {r["City"] for r in rows} == {"a"} and len(rows) == 14


@pytest.mark.parametrize(
    ("n", "ratio", "size"),
    [(5, 0.2, 4), (10, 0.2, 8), (15, 0.2, 12), (20, 0.2, 16), (35, 0.2, 28), (36, 0.2, 28), (80, 0.2, 64),
     (83, 0.2, 66), (10, 0.3, 7), (20, 0.3, 14), (30, 0.3, 21), (70, 0.3, 49)],
)
def test_split_sizes(spark, n, ratio, size):
    assert int(n * (1 - ratio)) == size
    rows = split.time_split(panel(spark, {"a": range(1, n + 1)}), ["City"], ratio).collect()
    train = [r["period"] for r in rows if r["split"] == "train"]
    test = [r["period"] for r in rows if r["split"] == "test"]
    assert len(train) == size and len(train) + len(test) == n and max(train) < min(test)


def test_split_too_short(spark):
    df = panel(spark, {"a": range(1, 5), "b": range(1, 11)})
    rows = split.time_split(df, ["City"]).collect()
    assert {(r["City"], r["status"], r["split"] is None) for r in rows} == {("a", "too_short", True), ("b", "ok", False)}
    with pytest.raises(Exception, match="not enough data points"):
        split.time_split(df.where("City = 'a'").drop("City")).collect()


def test_sequences(spark):
    df = panel(spark, {"a": range(1, 11), "b": range(1, 8), "c": range(1, 4)})
    rows = split.sequence_split(split.sequence_windows(df, ["City"], 6), ["City"]).orderBy("City", "period").collect()
    assert [(r["City"], list(r["seq"]), r["y"], r["seq_split"]) for r in rows] == [
        ("a", [1, 2, 3, 4, 5, 6], 7, "train"),
        ("a", [2, 3, 4, 5, 6, 7], 8, "train"),
        ("a", [3, 4, 5, 6, 7, 8], 9, "train"),
        ("a", [4, 5, 6, 7, 8, 9], 10, "test"),
        ("b", [1, 2, 3, 4, 5, 6], 7, "train"),
    ]
    last = {r["City"]: list(r["seq"]) for r in split.last_sequence(df, ["City"], 6).collect()}
    assert last == {"a": [5, 6, 7, 8, 9, 10], "b": [2, 3, 4, 5, 6, 7], "c": [1, 2, 3]}


def test_scaling_round_trip(spark):
    df = panel(spark, {"a": seasonal_values(30), "b": [7.0] * 5})
    rows = scale.scale_series(df, ["City"]).collect()
    assert min(r["scaled"] for r in rows) == 0.0 and max(r["scaled"] for r in rows) == 1.0
    assert all(r["scaled"] == 0.0 for r in rows if r["City"] == "b")
    for keys, data in ((["City"], df), ([], df.where("City = 'a'").drop("City"))):
        stats = scale.fit_scaler(data, keys)
        back = scale.invert_scaler(scale.apply_scaler(data, stats, keys), stats, keys).collect()
        assert all(math.isclose(r["unscaled"], r["sales"], rel_tol=1e-12) for r in back)


def test_decomposition_against_numpy(spark):
    ys = seasonal_values(40, seed=3)
    got = decompose(panel(spark, {"a": ys, "b": ys[:23]}), ["City"], 12).orderBy("City", "period").toPandas()
    a = got[got.City == "a"].reset_index()
    weights = np.array([0.5] + [1] * 11 + [0.5]) / 12
    trend = np.full(40, np.nan)
    trend[6:34] = np.convolve(ys, weights, "valid")
    detrended = pd.Series(ys - trend)
    means = detrended.groupby(np.arange(40) % 12).mean().to_numpy()
    seasonal = (means - means.mean())[np.arange(40) % 12]
    np.testing.assert_allclose(a.trend, trend, rtol=1e-12)
    np.testing.assert_allclose(a.seasonal, seasonal, rtol=1e-9, atol=1e-9)
    np.testing.assert_allclose(a.resid, ys - trend - seasonal, atol=1e-8)
    assert abs(a.seasonal[:12].sum()) < 1e-8
    b = got[got.City == "b"]
    assert set(b.status) == {"too_short"} and b.trend.isna().all() and b.seasonal.isna().all()


def test_decomposition_odd_period(spark):
    ys = seasonal_values(21, seed=4)
    got = decompose(panel(spark, {"a": ys}), ["City"], 7).orderBy("period").toPandas()
    np.testing.assert_allclose(got.trend[3:-3], np.convolve(ys, np.ones(7) / 7, "valid"), rtol=1e-12)
