"""Moment tables against the batched kernels and their own additions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.models import arima, moments
from panelcast.models.series import series_arrays, with_horizon
from tests.helpers import panel, seasonal_values

SERIES = {
    "long": seasonal_values(60, 1), "other": seasonal_values(45, 2, slope=-3.0), "walk": list(np.cumsum(np.arange(1, 31) ** 1.5)),
    "flat": [5.0] * 30, "short": [1.0, 2.0, 4.0], "zero": [0.0] * 25,
}


@pytest.fixture(scope="module")
def data(spark):
    return panel(spark, SERIES)


@pytest.mark.parametrize("order", [(2, 1, 1), (1, 0, 0), (2, 0, 2), (0, 1, 1), (3, 2, 0), (1, 1, 2)])
def test_coefficients_are_the_kernels(data, order):
    fitted = {r["City"]: r for r in arima.estimate(with_horizon(series_arrays(data, ["City"]), 3), order).collect()}
    found = {r["City"]: r for r in moments.arima_coefficients(data, ["City"], order).collect()}
    assert set(found) == {c for c, ys in SERIES.items() if len(ys) >= arima.min_length(order)}
    for city, row in found.items():
        assert row["n"] == len(SERIES[city])
        assert row["coef"] == pytest.approx(fitted[city]["coef"], rel=1e-5, abs=1e-7)
        assert row["adjusted"] == fitted[city]["adjusted"]


def test_the_whole_panel_as_one_series(data):
    one = data.where("City = 'long'").drop("City")
    row = moments.arima_coefficients(one).first()
    keyed = moments.arima_coefficients(data, ["City"]).where("City = 'long'").first()
    assert row["coef"] == pytest.approx(keyed["coef"], rel=1e-9) and row["n"] == 60


def test_parts_add_up(data):
    rows = moments.lagged_rows(data, ["City"])
    names = ["w1", "w2", "w3", "w4"]
    whole = moments.moments(rows, ["City"], names, "w")
    parts = moments.moments(rows.withColumn("part", F.year("period") % 2), ["City", "part"], names, "w")
    merged = moments.merge(parts, ["City"])
    expected, got = ({r["City"]: r for r in t.collect()} for t in (whole, merged))
    for city, row in expected.items():
        for name in whole.columns[1:]:
            assert got[city][name] == pytest.approx(row[name], rel=1e-9, abs=1e-6)


def test_new_periods_update_a_stored_table(data):
    """Only the new periods' rows are aggregated; lags reach back over a few stored rows."""
    rows = moments.lagged_rows(data, ["City"])
    names = ["w1", "w2"]
    old, new = rows.where("period < '2022-06-01'"), rows.where("period >= '2022-06-01'")
    table = moments.moments(old, ["City"], names, "w").unionByName(moments.moments(new, ["City"], names, "w"))
    merged = {r["City"]: r["cross"] for r in moments.merge(table, ["City"]).collect()}
    whole = {r["City"]: r["cross"] for r in moments.moments(rows, ["City"], names, "w").collect()}
    assert {c: pytest.approx(x, rel=1e-9) for c, x in whole.items()} == merged


def test_one_exchange(data):
    plan = moments.moments(moments.lagged_rows(data, ["City"]), ["City"], ["w1", "w2"], "w")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "collect_list" not in text


def test_empty_panel(data):
    assert moments.arima_coefficients(data.limit(0), ["City"]).collect() == []
    assert moments.merge(moments.moments(moments.lagged_rows(data.limit(0), ["City"]), ["City"], ["w1"], "w"), ["City"]).collect() == []
