import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelcast.models import additive, arima, kernels, sequence, smoothing
from panelcast.models.series import explode_forecast, hold_out, series_arrays, with_horizon
from panelcast.operators import metrics, periods, split
from panelcast.plans import forecasting, reports
from tests.helpers import arima_by_hand, months, panel, search_by_hand, seasonal_values, smooth_by_hand

SERIES = {"long": seasonal_values(40, 1), "other": seasonal_values(40, 2, slope=-3.0), "mid": seasonal_values(20, 3),
          "two": [5.0, 8.0], "one": [4.0]}


@pytest.fixture(scope="module")
def data(spark):
    return panel(spark, SERIES)


@pytest.fixture(scope="module")
def series(data):
    return with_horizon(series_arrays(data, ["City"]), 14)


KIND = {"long": "holt_winters", "other": "holt_winters", "mid": "holt", "two": "ses", "one": "ses"}


@pytest.mark.parametrize("kind", ["holt_winters", "holt", "ses"])
def test_fixed_smoothing(series, kind):
    given = {"alpha": 0.3, "beta": 0.1, "gamma": 0.2}
    fitted = smoothing.fixed(series.where("n >= 24"), kind, 12, **given)
    rows = {r["City"]: r for r in smoothing.forecast_array(fitted).collect()}
    for city in ("long", "other"):
        gamma = 0.2 if kind == "holt_winters" else 0.0
        sse, _, ahead = smooth_by_hand(list(SERIES[city]), kind, 0.3, 0.1, gamma)
        assert rows[city]["final"]["sse"] == pytest.approx(sse, rel=1e-12)
        assert rows[city]["yhat"] == pytest.approx([ahead(h) for h in range(1, 15)], rel=1e-12)


def test_search_and_forecast(series):
    fitted = smoothing.forecast_array(smoothing.smooth(series, 12))
    rows = {r["City"]: r for r in fitted.collect()}
    assert {c: r["model"] for c, r in rows.items()} == KIND
    for city, kind in KIND.items():
        ys = list(map(float, SERIES[city]))
        sse, a, b, g = search_by_hand(ys, kind, *smoothing.SEARCH[kind])
        best = rows[city]["best"]
        assert (best["alpha"], best["beta"], best["gamma"]) == pytest.approx((a, b, g), abs=1e-12)
        assert rows[city]["final"]["sse"] == pytest.approx(sse, rel=1e-9)
        ahead = smooth_by_hand(ys, kind, a, b, g)[2]
        assert rows[city]["yhat"] == pytest.approx([ahead(h) for h in range(1, 15)], rel=1e-9)


def test_fitted_values(series):
    fitted = smoothing.smooth(series, 12)
    rows = smoothing.fitted_values(fitted, ["City"], 12).orderBy("City", "period").collect()
    best = {r["City"]: r["best"] for r in fitted.collect()}
    for city, kind in KIND.items():
        got = [r["fitted"] for r in rows if r["City"] == city]
        b = best[city]
        want = smooth_by_hand(list(SERIES[city]), kind, b["alpha"], b["beta"], b["gamma"])[1]
        assert len(got) == len(SERIES[city])
        assert got[: len(got) - len(want)] == [None] * (len(got) - len(want))
        assert got[len(got) - len(want) :] == pytest.approx(want, rel=1e-9)


def test_parameters_round_trip(spark, series, tmp_path):
    fitted = smoothing.smooth(series, 12)
    path = str(tmp_path / "params")
    smoothing.parameters(fitted, ["City"]).write.parquet(path)
    again = smoothing.forecast_parameters(spark.read.parquet(path), 14)
    want = {r["City"]: r["yhat"] for r in smoothing.forecast_array(fitted).collect()}
    assert {r["City"]: r["yhat"] for r in again.collect()} == want


@pytest.mark.parametrize("model", ["holt_winters", "arima", "additive"])
def test_stored_parameters_give_the_same_forecast(spark, data, tmp_path, model):
    path = str(tmp_path / model)
    forecasting.fit_parameters(data, ["City"], model).write.parquet(path)
    again = forecasting.forecast_parameters(spark.read.parquet(path), ["City"], model, horizon=4)
    direct = forecasting.forecast(data, ["City"], models=[model], horizon=4)
    assert again.columns == direct.columns
    want = {(r["City"], r["ds"]): (r["variant"], r["yhat"]) for r in direct.collect()}
    assert {(r["City"], r["ds"]): (r["variant"], r["yhat"]) for r in again.collect()} == want
    assert len(want) == 4 * len(SERIES)


def test_sequence_without_history_is_smoothed(spark):
    rows = forecasting.forecast(panel(spark, {"a": [1, 2, 3]}), ["City"], models=["sequence"]).collect()
    assert len(rows) == 6 and {r["variant"] for r in rows} == {"holt"} and {r["model"] for r in rows} == {"sequence"}


def test_values_that_are_not_numbers_fail(spark):
    for bad in (float("nan"), None):
        rows = [("a", dt.date(2020, i, 1), v) for i, v in ((1, 1.0), (2, bad), (3, 3.0))]
        df = spark.createDataFrame(rows, "City string, period date, sales double")
        with pytest.raises(Exception, match="no value at 2020-02-01"):
            series_arrays(df, ["City"]).collect()


def test_every_series_is_answered(spark):
    lengths = {"forty": 40, "five": 5, "four": 4, "two": 2}
    data = panel(spark, {k: seasonal_values(n) for k, n in lengths.items()})
    ahead = forecasting.forecast(data, ["City"], horizon=3).collect()
    assert {(r["City"], r["model"]) for r in ahead} == {(c, m) for c in lengths for m in forecasting.MODELS}
    assert len(ahead) == 3 * len(lengths) * len(forecasting.MODELS) and all(r["yhat"] is not None for r in ahead)
    back = forecasting.backtest(data, ["City"]).collect()
    assert {(r["City"], r["model"]) for r in back} == {(c, m) for c in lengths for m in forecasting.MODELS}
    dates = {m: sorted((r["City"], r["ds"]) for r in back if r["model"] == m and r["status"] == "ok") for m in forecasting.MODELS}
    assert len(set(map(str, dates.values()))) == 1 and len(dates["arima"]) == 9
    assert {r["City"] for r in back if r["status"] == "too_short"} == {"four", "two"}


def test_level_search_of_a_broken_fit():
    plans = smoothing.SEARCH
    ys = pd.Series([np.array([1e200 if i % 7 else -1e200 for i in range(30)]), seasonal_values(30)])
    found = kernels.search_rows(plans, 12, 1)(pd.Series(["holt_winters", "holt_winters"]), ys)
    assert list(found["kind"]) == ["ses", "holt_winters"] and found["beta"][0] == found["gamma"][0] == 0.0


def test_blocks_are_bounded(monkeypatch):
    monkeypatch.setattr(kernels, "CELLS", 1000)
    ys = pd.Series([np.arange(50.0) + i for i in range(30)])
    blocks = list(kernels.by_length(ys, cells=5))
    assert max(len(rows) for rows, _ in blocks) == 4 and sum(len(rows) for rows, _ in blocks) == 30


def test_failed_solves_have_no_coefficients():
    bad, good = np.full(30, np.inf), np.sin(np.arange(30.0)) + np.arange(30) % 3
    with np.errstate(all="ignore"):
        found = kernels.arma_rows(2, 1)(pd.Series([bad, good]))
    assert found["coef"][0] is None and len(found["coef"][1]) == 3


def test_infinite_error_falls_back(spark):
    wild = with_horizon(series_arrays(panel(spark, {"a": [1e200 if i % 7 else -1e200 for i in range(30)]}), ["City"]), 2)
    row = smoothing.forecast_array(smoothing.smooth(wild, 12)).first()
    assert row["model"] == "ses" and len(row["yhat"]) == 2


@pytest.mark.parametrize("order", [(2, 1, 1), (1, 0, 0), (0, 1, 1), (2, 0, 2), (1, 2, 1), (3, 1, 0)])
def test_arima_against_loops(series, order):
    fitted = arima.forecast_array(arima.fit(series, order), order)
    rows = {r["City"]: r for r in fitted.collect()}
    for city in ("long", "other", "mid"):
        ys = list(map(float, SERIES[city]))
        if len(ys) < arima.min_length(order):
            assert rows[city]["model"] == "holt"
            continue
        coef, path = arima_by_hand(ys, *order, 14)
        assert rows[city]["model"] == "arima"
        assert rows[city]["coef"] == pytest.approx(list(coef), rel=1e-6, abs=1e-9)
        assert rows[city]["yhat"] == pytest.approx(list(path), rel=1e-6)
    assert rows["two"]["model"] == ("arima" if arima.min_length(order) <= 2 else "ses")
    assert rows["two"]["yhat"][0] is not None


def test_arima_without_terms(series):
    rows = {r["City"]: r for r in arima.forecast_array(arima.fit(series, (0, 1, 0)), (0, 1, 0)).collect()}
    assert rows["long"]["yhat"] == pytest.approx([SERIES["long"][-1]] * 14)


def test_root_limits():
    phi, theta = kernels.stable(np.array([[1.5, 0.2], [0.3, 0.1]]), np.array([[1.6], [-0.5]]))
    assert kernels.largest_root(phi)[0] == pytest.approx(0.98)
    assert phi[1].tolist() == [0.3, 0.1]
    assert theta[:, 0].tolist() == [1 / 1.6, -0.5]


def test_explosive_series_is_adjusted(spark):
    grows = [float(1.3**i + (i % 3)) for i in range(40)]
    row = arima.fit(with_horizon(series_arrays(panel(spark, {"a": grows}), ["City"]), 3)).first()
    assert row["adjusted"] is True
    assert kernels.largest_root(np.array([row["coef"][:2]]))[0] <= 0.98 + 1e-9


def test_additive_solves_its_normal_equations(series):
    row = {r["City"]: r["curve"] for r in additive.fit(series).collect()}["long"]
    days = np.array([(d - dt.date(1970, 1, 1)).days for d in months(40)], dtype=float)
    ys = np.array(SERIES["long"])
    changes = kernels.changepoint_days(days)
    assert len(changes) == 25 and set(changes) <= set(days[:32])
    design = kernels.design_matrix(days, days[0], days[-1] - days[0], changes)
    assert design.shape == (40, 53)
    prior = np.concatenate([[5.0, 5.0], [0.05] * 25, [10.0] * 26])
    # The solution is a stationary point: X'(y - Xb)/sigma^2 = b/prior^2.
    beta = np.concatenate([row["trend"], row["hinges"], row["season"]])
    left = design.T @ (ys / row["scale"] - design @ beta) / row["sigma"] ** 2
    np.testing.assert_allclose(left, beta / prior**2, rtol=1e-5, atol=1e-5)
    assert row["sigma"] > 0


def test_additive_forecast_matches_design(data):
    series = with_horizon(series_arrays(data.where("City in ('long', 'mid', 'two')"), ["City"]), 3)
    fitted = additive.fit(series)
    rows = additive.forecast(fitted, ["City"], "MS").orderBy("City", "ds").collect()
    curve = {r["City"]: r["curve"] for r in fitted.collect()}
    assert {r["City"] for r in rows} == {"long", "mid"}
    for city, n in (("long", 40), ("mid", 20)):
        got, c = [r for r in rows if r["City"] == city], curve[city]
        assert len(got) == n + 3
        days = np.array([(r["ds"] - dt.date(1970, 1, 1)).days for r in got], dtype=float)
        x = kernels.design_matrix(days, c["t0"], c["span"], np.array(c["changes"]))
        want = x @ np.concatenate([c["trend"], c["hinges"], c["season"]]) * c["scale"]
        assert [r["yhat"] for r in got] == pytest.approx(list(want), rel=1e-9)
        width = 2 * 1.2816 * c["sigma"] * c["scale"]
        assert got[0]["yhat_upper"] - got[0]["yhat_lower"] == pytest.approx(width)


def test_shared_calendar_equals_own_fit():
    days = np.arange(0.0, 900.0, 30.0)
    ys = np.stack([seasonal_values(30, s) for s in range(4)], axis=1)
    together = kernels.fit_calendar(days, ys)
    for j in range(4):
        alone = kernels.fit_calendar(days, ys[:, [j]])[0]
        np.testing.assert_allclose(np.concatenate(together[j][4:]), np.concatenate(alone[4:]), rtol=1e-9, atol=1e-12)


def test_given_noise_is_the_posterior_mean():
    rng = np.random.default_rng(2)
    days, ys = np.arange(40) * 30.4, rng.standard_normal((40, 3))
    design = kernels.design_matrix(days, 0.0, float(days[-1]), kernels.changepoint_days(days, 4), ((365.25, 2),))
    prior = kernels.prior_scales(4, ((365.25, 2),))
    beta, sigma = kernels.posterior_fit(design, prior, ys, 0.3)
    direct = np.linalg.solve(design.T @ design / 0.09 + np.diag(1 / prior**2), design.T @ ys / 0.09)
    np.testing.assert_allclose(beta, direct, rtol=1e-8, atol=1e-10)
    assert list(sigma) == [0.3] * 3


def test_one_failed_curve_leaves_the_others(spark, monkeypatch):
    days = pd.Series([np.arange(30) * 30.0] * 3)
    good = seasonal_values(30, 5)
    ys = pd.Series([good, [np.inf, *good[1:]], good[::-1]])
    for noise in (None, 0.1):
        found = kernels.curve_rows(noise=noise)(days, ys)
        assert found["scale"].notna().tolist() == [True, False, True]
        alone = kernels.curve_rows(noise=noise)(days[:1], ys[:1])
        np.testing.assert_allclose(found["season"][0], alone["season"][0])
    broken = panel(spark, {"good": good, "bad": [np.inf, *good[1:]]})
    rows = forecasting.forecast(broken, ["City"], "MS", ["additive"], 2).collect()
    assert {r["City"]: r["variant"] for r in rows} == {"good": "additive", "bad": "ses"}
    stored = forecasting.fit_parameters(broken, ["City"], "additive")
    again = forecasting.forecast_parameters(stored, ["City"], "additive", horizon=2).collect()
    assert {(r["City"], r["ds"], r["variant"]) for r in again} == {(r["City"], r["ds"], r["variant"]) for r in rows}
    tested = forecasting.backtest(broken, ["City"], "MS", ["additive"]).collect()
    assert {r["City"]: r["variant"] for r in tested}["good"] == "additive" and len(tested) == 12



def test_linear_sequence_model(series):
    long = series.where("n = 40")
    rows = sequence.training_rows(long, ["City"])
    got = rows.orderBy("City", "target").collect()
    assert len(got) == 68 and sum(r["is_val"] for r in got) == 2 * (34 - 27)
    model = sequence.fit(rows, kind="linear")
    x = np.array([list(r["seq"]) + [1.0] for r in got])
    y = np.array([r["y"] for r in got])
    want, *_ = np.linalg.lstsq(x, y, rcond=None)
    np.testing.assert_allclose(list(model.regressor.coefficients), want[:6], atol=1e-3)
    path = {r["City"]: r["yhat"] for r in sequence.forecast_array(model, long, 5).collect()}
    ys = np.array(SERIES["long"])
    low, high = ys.min(), ys.max()
    seq = list((ys[-6:] - low) / (high - low))
    for h in range(5):
        nxt = float(np.dot(seq, list(model.regressor.coefficients)) + model.regressor.intercept)
        assert path["long"][h] == pytest.approx(nxt * (high - low) + low, rel=1e-9)
        seq = seq[1:] + [nxt]


def test_boosted_sequence_recursion(series):
    long = series.where("n = 40")
    model = sequence.fit(sequence.training_rows(long, ["City"]), rounds=10)
    full = {r["City"]: r["yhat"] for r in sequence.forecast_array(model, long, 6).collect()}
    short = {r["City"]: r["yhat"] for r in sequence.forecast_array(model, long, 2).collect()}
    assert {c: v[:2] for c, v in full.items()} == short
    assert all(len(v) == 6 for v in full.values())
    low, high = min(SERIES["long"]), max(SERIES["long"])
    assert all(low - 1e-6 <= v <= high + 1e-6 for v in full["long"])


@pytest.mark.parametrize("kind", ["linear", "gbt"])
def test_calendar_inputs(series, kind):
    long = series.where("n = 40")
    rows = sequence.training_rows(long, ["City"])
    assert {r["ds"] for r in rows.where("City = 'long'").collect()} == set(months(40)[6:])
    model = sequence.fit(rows, kind=kind, rounds=5, calendar=True)
    path = {r["City"]: r["yhat"] for r in sequence.forecast_array(model, long, 3).collect()}
    # The same path, one prediction at a time from plain rows.
    ys = np.array(SERIES["long"])
    low, high = ys.min(), ys.max()
    seq = [float(v) for v in (ys[-6:] - low) / (high - low)]
    spark = series.sparkSession
    for h, ds in enumerate(months(43)[40:]):
        row = spark.createDataFrame([(seq, ds)], "seq array<double>, ds date")
        nxt = model.predict(row).first()["predicted"]
        assert path["long"][h] == pytest.approx(nxt * (high - low) + low, rel=1e-9)
        seq = seq[1:] + [nxt]


def test_sequence_holdout_uses_actual_history(data):
    held = hold_out(series_arrays(data.where("City in ('long', 'other')"), ["City"]), "MS")
    rows = sequence.test_rows(held, ["City"]).where("City = 'long'").orderBy("ds").collect()
    ys = np.array(SERIES["long"])
    low, high = ys[:32].min(), ys[:32].max()
    assert len(rows) == 8
    for i, r in enumerate(rows):
        assert r["y"] == ys[32 + i] and r["ds"] == months(40)[32 + i]
        np.testing.assert_allclose(r["seq"], (ys[26 + i : 32 + i] - low) / (high - low))


def test_hold_out_with_gaps(spark):
    labels = [d for i, d in enumerate(months(40)) if i not in (35, 36)]
    rows = [("a", d, float(v)) for d, v in zip(labels, seasonal_values(38), strict=True)]
    df = spark.createDataFrame(rows, "City string, period date, sales double")
    got = forecasting.backtest(df, ["City"], models=["holt_winters"]).orderBy("ds").collect()
    assert [r["ds"] for r in got] == labels[30:]
    ys = [r[2] for r in rows[:30]]
    _, a, b, g = search_by_hand(ys, "holt_winters", *smoothing.SEARCH["holt_winters"])
    ahead = smooth_by_hand(ys, "holt_winters", a, b, g)[2]
    # Steps count calendar months from the last fitted one, so the gap is skipped, not closed.
    steps = [(d.year - labels[29].year) * 12 + d.month - labels[29].month for d in labels[30:]]
    assert [r["yhat"] for r in got] == pytest.approx([ahead(h) for h in steps], rel=1e-9)


def test_backtest_scores_every_model_on_the_same_dates(data):
    rows = forecasting.backtest(data, ["City"]).where("status = 'ok'").collect()
    dates = {}
    for r in rows:
        dates.setdefault((r["City"], r["model"]), set()).add(r["ds"])
    assert {c for c, _ in dates} == {"long", "other", "mid"}
    for city in ("long", "other", "mid"):
        assert len({frozenset(dates[city, m]) for m in forecasting.MODELS}) == 1
    assert all(r["yhat"] is not None for r in rows)


def test_one_key_equals_the_keyless_run(data):
    only = data.where("City = 'long'").drop("City")
    models = ["arima", "holt_winters", "additive"]
    for rule in (forecasting.backtest, forecasting.forecast):
        whole = rule(data, ["City"], models=models).where("City = 'long'")
        a = {(r["model"], r["ds"]): r["yhat"] for r in whole.collect()}
        b = {(r["model"], r["ds"]): r["yhat"] for r in rule(only, (), models=models).collect()}
        assert a.keys() == b.keys()
        assert all(a[k] == pytest.approx(b[k], rel=1e-9) for k in a)


def test_forecast_shape(data):
    rows = forecasting.forecast(data, ["City"], horizon=3).collect()
    per = {}
    for r in rows:
        per.setdefault((r["City"], r["model"]), []).append(r)
    for (city, model), group in per.items():
        assert len(group) == 3, (city, model)
        assert all(r["yhat_lower"] <= r["yhat"] <= r["yhat_upper"] for r in group if r["yhat"] > 0)
    for city in SERIES:
        assert {m for c, m in per if c == city} == set(forecasting.MODELS)
    for model in ("additive", "sequence"):
        assert {r["variant"] for r in per["two", model]} == {"ses"}
    with pytest.raises(ValueError, match="choice of"):
        forecasting.forecast(data, ["City"], models=["prophecy"])


def test_full_scope(data):
    rows = forecasting.backtest(data, ["City"], models=["additive", "holt_winters"], fit_scope="all").where("status = 'ok'")
    got = {(r["City"], r["model"]) for r in rows.collect()}
    assert {("long", "additive"), ("long", "holt_winters"), ("mid", "additive")} <= got
    with pytest.raises(ValueError, match="fit_scope"):
        forecasting.backtest(data, ["City"], models=["arima"], fit_scope="all")


@pytest.mark.parametrize("freq", ["M", "QS", "W", "D", "6h"])
def test_other_frequencies(spark, freq):
    kind = "timestamp_ntz" if freq == "6h" else "date"
    first = dt.datetime(2020, 1, 5) if freq == "6h" else dt.date(2020, 1, 5)
    one = spark.createDataFrame([("a", first)], f"City string, period {kind}")
    label = one.select("City", F.explode(F.sequence(F.lit(0), F.lit(39))).alias("i"), "period")
    from panelcast.functions.calendar import period_label, shift_label

    df = label.select(
        "City",
        shift_label(period_label(F.col("period"), freq), freq, F.col("i")).alias("period"),
        (100 + F.col("i") * 2 + F.sin(F.col("i"))).alias("sales"),
    )
    models = ["arima", "holt_winters", "additive"]
    rows = forecasting.forecast(df, ["City"], freq, models, 4).collect()
    last = df.agg(F.max("period")).first()[0]
    assert len(rows) == 12 and min(r["ds"] for r in rows) > last
    tested = forecasting.backtest(df, ["City"], freq, models).collect()
    assert len(tested) == 3 * 8 and all(r["yhat"] is not None for r in tested)


def test_reports(spark):
    rows = [
        (city, "s1", cat, d, float(v) / 2)
        for city, seed in (("x", 1), ("y", 2))
        for cat in ("A", "B")
        for d, v in zip(months(36), seasonal_values(36, seed), strict=True)
    ]
    facts = spark.createDataFrame(rows, "City string, Store_ID string, Category string, date date, Revenue double")
    tables = reports.exploration(facts)
    assert set(tables) == {"trend", "decomposition", "year_month", "city_totals", "category_share"}
    assert tables["trend"].count() == 36
    run = reports.ModelComparison(facts, ["City"], models=["arima", "holt_winters"], horizon=2)
    assert run.panel.count() == 72 and run.features.count() == 60
    best = run.leaderboard.where("is_best").collect()
    assert len(best) == 2
    assert run.forecast.count() == 8
    assert {r["series"] for r in run.comparison.select("series").distinct().collect()} == {
        "train", "actual", "arima", "holt_winters"}
    whole = reports.ModelComparison(facts, horizon=2)
    assert whole.leaderboard.where("is_best").count() == 1 and whole.leaderboard.count() == 4
    assert whole.forecast.count() == 8
    page = reports.Dashboard(facts, city="x", horizon=3)
    assert page.kpi.first()["n_periods"] == 36
    assert page.forecast.count() == 6 and page.scores.count() == 2
    assert page.city_totals.count() == 2 and page.category_share.count() == 2


def test_future_dates_follow_the_label(data):
    ends = data.withColumn("period", F.last_day("period"))
    fitted = smoothing.forecast_array(smoothing.smooth(with_horizon(series_arrays(ends, ["City"]), 2), 12))
    rows = explode_forecast(fitted, ["City"], "M", ["model"]).where("City = 'mid'").orderBy("step").collect()
    assert [r["ds"] for r in rows] == [dt.date(2021, 9, 30), dt.date(2021, 10, 31)]


def test_scores_join_by_date(data):
    train = split.time_split(data.where("City = 'long'"), ["City"]).where("split = 'train'")
    future = forecasting.forecast(train.select("City", "period", "sales"), ["City"], models=["holt_winters"], horizon=8)
    scored = metrics.score(metrics.align(future, data, ["City"]), ["City"]).first()
    direct = metrics.score(forecasting.backtest(data, ["City"], models=["holt_winters"]), ["City"])
    assert scored["mape"] == direct.where("City = 'long'").first()["mape"]
    assert periods.horizon_calendar(data, ["City"], 2).count() == 10
