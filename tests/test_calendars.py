"""Anchored, business-day, half-month and free-duration periods against pandas' resampling."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelcast.functions import calendar
from panelcast.functions.calendar import resolve_freq
from panelcast.operators import periods
from panelcast.plans import forecasting

DATES = [
    "MS", "ME", "QS", "QE", "YS", "YE", "QS-FEB", "QS-APR", "QE-JAN", "QE-FEB", "YS-APR", "YE-MAR", "YE-FEB", "W", "W-MON",
    "B", "SMS", "SME", "BMS", "BME", "BQS", "BQE", "BYS", "BYE", "BQS-APR", "BYE-MAR", "2MS", "2QS-APR", "3D", "2B", "3SMS",
]
DURATIONS = ["15min", "h", "6h", "5h", "7h", "36h", "24h", "48h", "50min", "77s"]


def by_pandas(times, values, freq):
    sums = pd.Series(values, index=pd.DatetimeIndex(times)).sort_index().resample(freq).sum()
    return {k.to_pydatetime(): v for k, v in sums[sums > 0].items()}


@pytest.fixture(scope="module")
def points(spark):
    """Days of three series; every month end and weekend of some years is met."""
    rng = random.Random(4)
    rows = [(k, dt.datetime(2019, 1, 1) + dt.timedelta(days=rng.randrange(1900)), float(rng.randrange(1, 99))) for k in "abc" for _ in range(900)]
    rows += [("d", dt.datetime(2024, 3, d), 1.0) for d in range(1, 32)] + [("e", dt.datetime(2024, 6, 1), 2.0)]
    return rows, spark.createDataFrame(rows, "City string, date timestamp_ntz, Revenue double").cache()


@pytest.fixture(scope="module")
def moments(spark):
    rng = random.Random(5)
    rows = [(k, dt.datetime(2024, 2, 26, 7, 11) + dt.timedelta(seconds=rng.randrange(900_000)), float(rng.randrange(1, 99))) for k in "ab" for _ in range(400)]
    return rows, spark.createDataFrame(rows, "City string, date timestamp_ntz, Revenue double").cache()


def compare(rows, df, freq):
    expected = {}
    for key in {k for k, *_ in rows}:
        own = [(t, v) for k, t, v in rows if k == key]
        expected |= {(key, label): total for label, total in by_pandas(*zip(*own, strict=True), freq).items()}
    found = periods.to_periods(df, ["City"], freq).collect()
    got = {(r["City"], dt.datetime.combine(r["period"], dt.time()) if not isinstance(r["period"], dt.datetime) else r["period"]): r["sales"] for r in found}
    assert got == expected


@pytest.mark.parametrize("freq", DATES)
def test_labels_of_days(points, freq):
    compare(*points, freq)


@pytest.mark.parametrize("freq", DURATIONS)
def test_labels_of_moments(moments, freq):
    compare(*moments, freq)


@pytest.mark.parametrize("freq", [f for f in DATES if f not in ("2MS", "2QS-APR", "3SMS", "2B", "3D")])
def test_steps_and_distances(spark, freq):
    begin = pd.date_range("2018-11-03", periods=1, freq=freq)[0]
    labels = pd.date_range(begin, periods=40, freq=freq)
    n = resolve_freq(freq)
    df = spark.createDataFrame([(x.date(), i) for i, x in enumerate(labels)], "p date, i int").withColumn("a", F.lit(begin.date()))
    df = df.withColumns({"moved": calendar.shift_label(F.col("a"), n, F.col("i")), "between": calendar.periods_between(F.col("a"), F.col("p"), n)})
    assert all(r["moved"] == r["p"] and r["between"] == r["i"] for r in df.collect())


def test_seasons_and_names():
    assert [resolve_freq(f).season_length for f in ("QS-APR", "YE-MAR", "B", "SMS", "BME", "2QS-FEB", "5h", "36h", "6h", "24h")] == [4, 1, 5, 24, 12, 2, 1, 1, 4, 1]
    assert resolve_freq("QS-APR").label == "Quarterly" and resolve_freq("2B").label == "2 x B" and resolve_freq("36h").label == "36h"
    assert resolve_freq("QE-MAR").first_month == 4 and resolve_freq("Y-DEC").first_month == 1


def test_gaps_of_business_days(spark):
    days = [dt.date(2024, 3, 1), dt.date(2024, 3, 5), dt.date(2024, 3, 11)]
    panel = spark.createDataFrame([(d, 1.0) for d in days], "period date, sales double")
    filled = [r["period"] for r in periods.fill_period_gaps(panel, [], "B").orderBy("period").collect()]
    assert filled == [d.date() for d in pd.bdate_range(days[0], days[-1])]


@pytest.mark.parametrize("freq", ["QS-APR", "YE-MAR", "B", "SMS", "BME", "5h", "36h"])
def test_forecasts_carry_the_labels(spark, freq):
    n = 40
    labels = pd.date_range("2015-01-01", periods=n + 3, freq=freq)
    values = 100 + np.arange(n) + 10 * np.sin(np.arange(n))
    kind = "timestamp_ntz" if freq.endswith("h") else "date"
    rows = [("x", t.to_pydatetime() if kind == "timestamp_ntz" else t.date(), float(v)) for t, v in zip(labels, values, strict=False)]
    panel = spark.createDataFrame(rows, f"City string, period {kind}, sales double")
    ahead = forecasting.forecast(panel, ["City"], freq, ["holt_winters", "arima", "additive", "sequence"], 3).orderBy("model", "ds").collect()
    expected = [t.to_pydatetime() if kind == "timestamp_ntz" else t.date() for t in labels[n:]]
    assert [r["ds"] for r in ahead] == expected * 4 and all(np.isfinite(r["yhat"]) for r in ahead)
    tested = forecasting.backtest(panel, ["City"], freq, ["holt_winters", "arima"]).collect()
    assert len(tested) == 16 and all(r["yhat"] is not None for r in tested)
