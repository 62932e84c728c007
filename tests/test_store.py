"""The forecast store: equal to a fresh forecast, and no more work than the changes ask for."""

import os

import pytest
from pyspark.sql import functions as F

from panelcast.plans import forecasting
from panelcast.plans.store import ForecastStore, history_digest
from tests.helpers import panel, seasonal_values

SERIES = {f"c{i}": seasonal_values(40, i) for i in range(12)} | {"short": [3.0, 4.0, 6.0], "one": [2.0]}
MODELS = ["arima", "holt_winters", "additive", "sequence"]


@pytest.fixture()
def data(spark):
    return panel(spark, SERIES)


def rows(df):
    return {(r["City"], r["model"], r["ds"]): (r["variant"], r["yhat"], r["yhat_lower"], r["yhat_upper"]) for r in df.collect()}


def files(path):
    """Folders by the files in them."""
    found = {}
    for folder, _, names in os.walk(f"{path}/forecasts"):
        if parts := {n for n in names if n.startswith("part-")}:
            found[os.path.relpath(folder, f"{path}/forecasts")] = parts
    return found


def same(found, expected):
    assert set(found) == set(expected)
    for k, (variant, *numbers) in expected.items():
        assert found[k][0] == variant and list(found[k][1:]) == pytest.approx(numbers, rel=1e-9)


def test_first_update_is_the_forecast(spark, data, tmp_path):
    store = ForecastStore(spark, str(tmp_path), ["City"], models=MODELS, horizon=4, buckets=4)
    with pytest.raises(FileNotFoundError):
        store.read()
    changes = store.update(data)
    assert changes.count() == len(SERIES) * 4 and {r["change"] for r in changes.collect()} == {"new"}
    expected = rows(forecasting.forecast(data, ["City"], "MS", MODELS, 4, sequence_model=store._sequence))
    same(rows(store.read()), expected)
    one = store.read(["holt_winters"], City="c3")
    assert rows(one) == {k: v for k, v in rows(store.read()).items() if k[:2] == ("c3", "holt_winters")}
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert store.next_periods(2).count() == len(SERIES) * 4 * 2
    with pytest.raises(ValueError, match="no keys"):
        store.read(Town="c3")


def test_one_changed_city_rewrites_one_folder(spark, data, tmp_path, monkeypatch):
    store = ForecastStore(spark, str(tmp_path), ["City"], models=["arima", "holt_winters"], horizon=3, buckets=16)
    store.update(data)
    before = files(tmp_path)
    grown = data.union(spark.createDataFrame([("c5", data.agg(F.add_months(F.max("period"), 1)).first()[0], 1234.0)], data.schema))
    fitted, plain = [], forecasting.forecast

    def spy(panel, *args, **options):
        fitted.append(sorted(r["City"] for r in panel.select("City").distinct().collect()))
        return plain(panel, *args, **options)

    monkeypatch.setattr(forecasting, "forecast", spy)
    changes = store.update(grown).collect()
    assert fitted == [["c5"], ["c5"]] and {(r["City"], r["change"]) for r in changes} == {("c5", "changed")}
    after = files(tmp_path)
    assert set(after) == set(before)
    rewritten = {k for k in after if after[k] != before[k]}
    assert rewritten == {f"model={m}/bucket={changes[0]['bucket']}" for m in ("arima", "holt_winters")}
    same(rows(store.read()), rows(plain(grown, ["City"], "MS", ["arima", "holt_winters"], 3)))
    fitted.clear()
    assert store.update(grown).count() == 0 and fitted == [] and files(tmp_path) == after


def test_series_come_and_go(spark, data, tmp_path):
    store = ForecastStore(spark, str(tmp_path), ["City"], models=["holt_winters"], horizon=2, buckets=64)
    store.update(data.where("City <> 'c1'"))
    changes = store.update(data.where("City <> 'c2'")).collect()
    assert {(r["City"], r["change"]) for r in changes} == {("c1", "new"), ("c2", "gone")}
    assert {k[0] for k in rows(store.read())} == set(SERIES) - {"c2"}
    store.update(data.limit(0))
    assert store.read().collect() == []


def test_settings_belong_to_the_digest(spark, data, tmp_path):
    few = data.where("City IN ('c1', 'c2')")
    ForecastStore(spark, str(tmp_path), ["City"], models=["arima", "holt_winters"]).update(few)
    other = ForecastStore(spark, str(tmp_path), ["City"], models=["holt_winters"], horizon=9)
    assert {(r["model"], r["change"]) for r in other.update(few).collect()} == {("holt_winters", "changed")}
    counts = {r["model"]: r["count"] for r in other.read().groupBy("model").count().collect()}
    assert counts == {"arima": 12, "holt_winters": 18}


def test_a_new_sequence_model_outdates_its_rows(spark, data, tmp_path):
    store = ForecastStore(spark, str(tmp_path), ["City"], models=["sequence"], horizon=2)
    store.update(data.where("City LIKE 'c1%'"))
    assert {r["change"] for r in store.update(data).collect()} == {"new"}  # the kept model serves the new ones
    again = ForecastStore(spark, str(tmp_path), ["City"], models=["sequence"], horizon=2)
    assert len({r["City"] for r in again.update(data, retrain=True).collect()}) == len(SERIES)


def test_the_whole_panel_as_one_series(spark, data, tmp_path):
    total = data.groupBy("period").agg(F.sum("sales").alias("sales"))
    store = ForecastStore(spark, str(tmp_path), models=["holt_winters"])
    store.update(total)
    expected = [r["yhat"] for r in forecasting.forecast(total, models=["holt_winters"]).orderBy("ds").collect()]
    found = store.read().orderBy("ds")
    assert found.columns == ["model", "variant", "ds", "yhat", "yhat_lower", "yhat_upper"]
    assert [r["yhat"] for r in found.collect()] == pytest.approx(expected)


def test_digest_sees_points_not_their_order(spark, data):
    def digests(df):
        return {r["City"]: r["history"] for r in history_digest(df, ["City"]).collect()}

    whole = digests(data)
    assert digests(data.orderBy(F.desc("period"))) == whole and len(set(whole.values())) == len(SERIES)
    moved = digests(data.withColumn("sales", F.when((F.col("City") == "c0") & (F.month("period") == 5), F.col("sales") + 1e-9).otherwise(F.col("sales"))))
    assert {c for c in whole if moved[c] != whole[c]} <= {"c0"}
