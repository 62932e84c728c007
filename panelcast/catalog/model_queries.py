"""Fits, forecasts and back-tests over the city panel."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from panelcast.catalog import facts as stand_in
from panelcast.catalog.registry import register
from panelcast.catalog.sql_text import (
    CITY_PANEL,
    NET,
    SPLIT,
    arima_211,
    cholesky,
    products,
    seasonal_search,
    series_cte,
)
from panelcast.models import additive, arima, moments, sequence, smoothing
from panelcast.models.series import explode_forecast, hold_out, series_arrays, with_horizon
from panelcast.operators import metrics, periods, split
from panelcast.plans import forecasting, reports
from panelcast.session import materialize, scratch_path

KEYS = ["City"]
HORIZON = 6
SEASON = 12
FIXED = {"alpha": 0.3, "beta": 0.1, "gamma": 0.2}


def _series(spark, sf_dir, horizon=HORIZON):
    return with_horizon(series_arrays(stand_in.city_panel(spark, sf_dir), KEYS), horizon)


def _rounded(df, digits=2, columns=("yhat", "yhat_lower", "yhat_upper", "y", "value", "fitted")):
    return df.withColumns({c: F.round(c, digits) for c in columns if c in df.columns})


def _search(series: str) -> str:
    return seasonal_search(series, (0.1, 0.3, 0.5, 0.7, 0.9), (0.05, 0.2, 0.4), (0.05, 0.2, 0.4))


_WHOLE = f"WITH RECURSIVE panel AS ({CITY_PANEL}), series AS ({series_cte('panel')})"
_TRAIN = f"""WITH RECURSIVE panel AS ({CITY_PANEL}), marked AS ({SPLIT}),
  train AS (SELECT City, period, sales FROM marked WHERE split = 'train'),
  test AS (SELECT City, period, sales FROM marked WHERE split = 'test'),
  series AS ({series_cte('train')})"""
_SEASONAL_AT = "l + h * b + s[((h - 1) % 12)::int + 1]"


# --- smoothing with given parameters ----------------------------------------------------


def _fixed_sql(kind: str) -> str:
    if kind == smoothing.SEASONAL:
        start = """list_sum(ys[1:12]) / 12.0::double AS l,
                   (list_sum(ys[13:24]) - list_sum(ys[1:12])) / 144.0::double AS b, 12 AS i"""
        first = "list_transform(ys[1:12], lambda y: y - l)"
    elif kind == smoothing.TREND:
        start, first = "ys[2] AS l, ys[2] - ys[1] AS b, 2 AS i", "[0.0::double]"
    else:
        start, first = "ys[1] AS l, 0.0::double AS b, 1 AS i", "[0.0::double]"
    level = "0.3::double * (y - s[1]) + (1 - 0.3::double) * (l + b)"
    trend = "b" if kind == smoothing.LEVEL else f"0.1::double * (({level}) - l) + (1 - 0.1::double) * b"
    season = (
        "list_concat(s[2:12], [0.2::double * (y - (l + b)) + (1 - 0.2::double) * s[1]])"
        if kind == smoothing.SEASONAL
        else "s"
    )
    return f"""{_WHOLE},
    run AS (
      SELECT City, i, l, b, {first} AS s, 0.0::double AS sse FROM (SELECT City, ys, {start} FROM series)
      UNION ALL
      SELECT City, i + 1 AS i, {level} AS l, {trend} AS b, {season} AS s,
             sse + (y - (l + b + s[1])) * (y - (l + b + s[1])) AS sse
      FROM (SELECT r.*, p.ys[r.i + 1] AS y FROM run r JOIN series p USING (City) WHERE r.i < p.n))
    SELECT City, '{kind}' AS model, h::int AS step, cast(last_period + to_months(h::int) AS date) AS ds,
           round(l + h * b + s[((h - 1) % len(s))::int + 1], 2) AS yhat, round(sse / 1e6, 2) AS sse
    FROM run JOIN series USING (City), (SELECT unnest(range(1, 7)) AS h) WHERE i = n
    """


def _register_fixed(name: str, kind: str) -> None:
    @register(name, _fixed_sql(kind))
    def run(spark, sf_dir):
        fitted = smoothing.fixed(_series(spark, sf_dir), kind, SEASON, **FIXED)
        rows = fitted.withColumn("sse", F.round(F.col("final.sse") / 1e6, 2))
        return _rounded(explode_forecast(smoothing.forecast_array(rows), KEYS, "MS", ["model", "sse"]))


_register_fixed("ses_fixed", smoothing.LEVEL)
_register_fixed("holt_fixed", smoothing.TREND)
_register_fixed("hw_fixed", smoothing.SEASONAL)


# --- seasonal smoothing ------------------------------------------------------------------


@register(
    "hw_parameters",
    f"""{_WHOLE}, {_search("series")}
    SELECT City, 'holt_winters' AS model, n::int AS n, last_period, round(alpha, 4) AS alpha, round(beta, 4) AS beta,
           round(gamma, 4) AS gamma, round(f.sse / 1e6, 2) AS sse, round(l, 2) AS level, round(b, 4) AS trend
    FROM final f JOIN series USING (City)
    """,
)
def hw_parameters(spark, sf_dir):
    params = smoothing.parameters(smoothing.smooth(_series(spark, sf_dir), SEASON), KEYS)
    return params.withColumns(
        {
            "alpha": F.round("alpha", 4),
            "beta": F.round("beta", 4),
            "gamma": F.round("gamma", 4),
            "sse": F.round(F.col("sse") / 1e6, 2),
            "level": F.round("level", 2),
            "trend": F.round("trend", 4),
        }
    ).drop("season")


_HW_AHEAD = f"""
    SELECT City, cast(last_period + to_months(h::int) AS date) AS ds, {_SEASONAL_AT} AS yhat
    FROM final JOIN series USING (City), (SELECT unnest(range(1, 7)) AS h)
"""


@register(
    "hw_panel_forecast",
    f"""{_WHOLE}, {_search("series")}, f AS ({_HW_AHEAD})
    SELECT City, 'holt_winters' AS model, 'holt_winters' AS variant, ds, round(yhat, 2) AS yhat,
           round(yhat * 0.92::double, 2) AS yhat_lower, round(yhat * 1.08::double, 2) AS yhat_upper
    FROM f
    """,
)
def hw_panel_forecast(spark, sf_dir):
    panel = stand_in.city_panel(spark, sf_dir)
    return _rounded(forecasting.forecast(panel, KEYS, "MS", ["holt_winters"], HORIZON))


@register(
    "hw_stored_forecast",
    f"""{_WHOLE}, {_search("series")}, f AS ({_HW_AHEAD})
    SELECT City, 'holt_winters' AS model, 'holt_winters' AS variant, ds, round(yhat, 2) AS yhat,
           round(yhat * 0.92::double, 2) AS yhat_lower, round(yhat * 1.08::double, 2) AS yhat_upper
    FROM f
    """,
)
def hw_stored_forecast(spark, sf_dir):
    """Parameters written as a table, forecasts read from it."""
    panel = stand_in.city_panel(spark, sf_dir)
    stored = materialize(forecasting.fit_parameters(panel, KEYS, "holt_winters"), "parameters")
    return _rounded(forecasting.forecast_parameters(stored, KEYS, "holt_winters"))


_FITTED = """
    fit AS (
      SELECT p.City, p.periods[r.i + 1] AS period, r.l + r.b + r.s[1] AS fitted
      FROM fine_run r JOIN best USING (City, alpha, beta, gamma) JOIN series p USING (City) WHERE r.i < p.n)
"""


@register(
    "hw_fitted",
    f"""{_WHOLE}, {_search("series")}, {_FITTED}
    SELECT City, 'holt_winters' AS model, period, sales, round(fitted, 2) AS fitted
    FROM panel LEFT JOIN fit USING (City, period)
    """,
)
def hw_fitted(spark, sf_dir):
    fitted = smoothing.smooth(_series(spark, sf_dir), SEASON)
    return _rounded(smoothing.fitted_values(fitted, KEYS, SEASON))


@register(
    "history_and_forecast",
    f"""{_WHOLE}, {_search("series")}, {_FITTED}, ahead AS ({_HW_AHEAD})
    SELECT City, ds, round(yhat, 2) AS yhat, round(yhat * 0.92::double, 2) AS yhat_lower,
           round(yhat * 1.08::double, 2) AS yhat_upper
    FROM (SELECT City, period AS ds, fitted AS yhat FROM panel LEFT JOIN fit USING (City, period)
          UNION ALL SELECT City, ds, yhat FROM ahead)
    """,
)
def history_and_forecast(spark, sf_dir):
    fitted = smoothing.smooth(_series(spark, sf_dir), SEASON)
    past = smoothing.fitted_values(fitted, KEYS, SEASON)
    future = explode_forecast(smoothing.forecast_array(fitted), KEYS, "MS", ["model"])
    return _rounded(forecasting.history_and_forecast(past, future, KEYS))


@register(
    "hw_full_fit_scores",
    f"""WITH RECURSIVE panel AS ({CITY_PANEL}), marked AS ({SPLIT}), series AS ({series_cte("panel")}),
      {_search("series")}, {_FITTED}
    SELECT City, 'holt_winters' AS model, 'holt_winters' AS variant, period AS ds, sales AS y, round(fitted, 2) AS yhat, 'ok' AS status
    FROM marked JOIN fit USING (City, period) WHERE split = 'test'
    """,
)
def hw_full_fit_scores(spark, sf_dir):
    """Whole-series fit read at the test dates."""
    panel = stand_in.city_panel(spark, sf_dir)
    return _rounded(forecasting.backtest(panel, KEYS, "MS", ["holt_winters"], fit_scope="all"))


# --- two-stage ARIMA ---------------------------------------------------------------------


@register(
    "arima_parameters",
    f"""{_WHOLE}, {arima_211("series")}
    SELECT City, 'arima' AS model, round(phi1, 6) AS phi1, round(phi2, 6) AS phi2, round(theta, 6) AS theta,
           adjusted, round(sse, 6) AS sse
    FROM arima
    """,
)
def arima_parameters(spark, sf_dir):
    fitted = arima.parameters(arima.fit(_series(spark, sf_dir)), KEYS)
    coef = [F.round(F.col("coef")[i], 6).alias(c) for i, c in enumerate(("phi1", "phi2", "theta"))]
    sse = F.col("sigma2") / F.col("scale") / F.col("scale") * (F.col("n") - 3)
    return fitted.select("City", "model", *coef, "adjusted", F.round(sse, 6).alias("sse"))


@register(
    "arima_panel_forecast",
    f"""{_WHOLE}, {arima_211("series")}
    SELECT City, 'arima' AS model, 'arima' AS variant, cast(last_period + to_months(step::int) AS date) AS ds,
           round(level * scale, 0) AS yhat, round(level * scale * 0.92::double, 0) AS yhat_lower,
           round(level * scale * 1.08::double, 0) AS yhat_upper
    FROM ahead JOIN series USING (City) WHERE step BETWEEN 1 AND 6
    """,
)
def arima_panel_forecast(spark, sf_dir):
    panel = stand_in.city_panel(spark, sf_dir)
    return _rounded(forecasting.forecast(panel, KEYS, "MS", ["arima"], HORIZON), 0)


# --- moments ------------------------------------------------------------------------------

_MOMENT_NAMES = ["w1", "w2", "w3", "w4"]
_MOMENT_CELLS = [f"a{i}{j}" for i in range(4) for j in range(i + 1)] + [f"r{i}" for i in range(4)]
_DIFFERENCES = f"""
    diffs AS (SELECT *, sales - lag(sales) OVER (PARTITION BY City ORDER BY period) AS w FROM panel),
    lags AS (SELECT *, {", ".join(f"lag(w, {i}) OVER (PARTITION BY City ORDER BY period) AS w{i}" for i in range(1, 5))} FROM diffs),
    peaks AS (SELECT City, max(sales) AS peak, count(*) AS points FROM panel GROUP BY 1),
    sums AS (SELECT City, count(*) AS n, {products(_MOMENT_NAMES, "w")} FROM lags WHERE w4 IS NOT NULL GROUP BY 1)"""
_MOMENTS = f"""WITH panel AS ({CITY_PANEL}), {_DIFFERENCES}
    SELECT City, points, n, {", ".join(f"round({c} / peak / peak, 9) AS {c}" for c in _MOMENT_CELLS)} FROM sums JOIN peaks USING (City)"""


def _moment_columns(table):
    """The moments in units of the peak, a column each."""
    flat = F.concat("cross", "target_cross")
    unit = F.col("peak") * F.col("peak")
    cells = [F.round(flat[i] / unit, 9).alias(c) for i, c in enumerate(_MOMENT_CELLS)]
    return table.select("City", "points", "n", *cells)


def _city_lags(spark, sf_dir):
    return moments.lagged_rows(stand_in.city_panel(spark, sf_dir), KEYS)


@register("arima_moments", _MOMENTS)
def arima_moments(spark, sf_dir):
    """Sums of products of the first regression, one partial and final aggregate for all series."""
    return _moment_columns(moments.moments(_city_lags(spark, sf_dir), KEYS, _MOMENT_NAMES, "w"))


@register("arima_moments_merged", _MOMENTS)
def arima_moments_merged(spark, sf_dir):
    """Moments stored by year, added up again."""
    rows = _city_lags(spark, sf_dir).withColumn("year", F.year("period"))
    by_year = materialize(moments.moments(rows, ["City", "year"], _MOMENT_NAMES, "w"), "moments")
    return _moment_columns(moments.merge(by_year, KEYS))


@register(
    "arima_moment_parameters",
    f"""{_WHOLE}, {arima_211("series")}
    SELECT City, n::bigint AS n, round(phi1, 6) AS phi1, round(phi2, 6) AS phi2, round(theta, 6) AS theta, adjusted
    FROM arima JOIN series USING (City)
    """,
)
def arima_moment_parameters(spark, sf_dir):
    """The two-stage fit without a series in a row."""
    found = moments.arima_coefficients(stand_in.city_panel(spark, sf_dir), KEYS)
    coef = [F.round(F.col("coef")[i], 6).alias(c) for i, c in enumerate(("phi1", "phi2", "theta"))]
    return found.select("City", "n", *coef, "adjusted")


# --- hold-out evaluation -----------------------------------------------------------------

_HW_TEST = f"""
    SELECT City, 'holt_winters' AS model, t.period AS ds, t.sales AS y, {_SEASONAL_AT} AS yhat
    FROM (SELECT t.*, datediff('month', p.last_period, t.period) AS h FROM test t JOIN series p USING (City)) t
      JOIN final USING (City)
"""
_ARIMA_TEST = """
    SELECT City, 'arima' AS model, t.period AS ds, t.sales AS y, a.level * a.scale AS yhat
    FROM (SELECT t.*, datediff('month', p.last_period, t.period) AS step FROM test t JOIN series p USING (City)) t
      JOIN ahead a USING (City, step)
"""


@register(
    "backtest_predictions",
    f"""{_TRAIN}, {_search("series")}, {arima_211("series")}
    SELECT City, model, model AS variant, ds, y, round(yhat, 0) AS yhat, 'ok' AS status
    FROM ({_HW_TEST} UNION ALL {_ARIMA_TEST})
    """,
)
def backtest_predictions(spark, sf_dir):
    panel = stand_in.city_panel(spark, sf_dir)
    return _rounded(forecasting.backtest(panel, KEYS, "MS", ["holt_winters", "arima"]), 0, ("yhat",))


@register(
    "backtest_leaderboard",
    f"""{_TRAIN}, {_search("series")}, {arima_211("series")},
    m AS (
      SELECT City, model, round(avg(abs(y - yhat)), 0) AS mae, round(sqrt(avg((y - yhat) * (y - yhat))), 0) AS rmse,
             round_even(avg(abs((y - yhat) / y)) * 100, 2) AS mape
      FROM ({_HW_TEST} UNION ALL {_ARIMA_TEST}) GROUP BY 1, 2)
    SELECT *, row_number() OVER (PARTITION BY City ORDER BY mape, model) = 1 AS is_best FROM m
    """,
)
def backtest_leaderboard(spark, sf_dir):
    panel = stand_in.city_panel(spark, sf_dir)
    scores = metrics.score(forecasting.backtest(panel, KEYS, "MS", ["arima", "holt_winters"]), KEYS)
    ranked = metrics.leaderboard(scores, KEYS, forecasting.MODELS).drop("mae_text", "rmse_text")
    return ranked.withColumns({"mae": F.round("mae", 0), "rmse": F.round("rmse", 0)})


@register(
    "comparison_series",
    f"""{_TRAIN}, {_search("series")}
    SELECT City, CASE WHEN split = 'train' THEN 'train' ELSE 'actual' END AS series, period AS ds, sales AS value
    FROM marked
    UNION ALL SELECT City, model, ds, round(yhat, 2) FROM ({_HW_TEST})
    """,
)
def comparison_series(spark, sf_dir):
    panel = stand_in.city_panel(spark, sf_dir)
    predictions = forecasting.backtest(panel, KEYS, "MS", ["holt_winters"])
    return _rounded(forecasting.comparison_series(split.time_split(panel, KEYS), predictions, KEYS))


def _train_forecasts(spark, sf_dir, horizon):
    """Split panel, and a forecast of ``horizon`` months fitted on the train rows."""
    panel = stand_in.city_panel(spark, sf_dir)
    marked = split.time_split(panel, KEYS)
    train = with_horizon(series_arrays(marked.where(F.col("split") == "train"), KEYS), horizon)
    test = marked.where(F.col("split") == "test")
    fitted = smoothing.fixed(train, smoothing.SEASONAL, SEASON, **FIXED)
    return train, test, explode_forecast(smoothing.forecast_array(fitted), KEYS, "MS", ["model"])


_FIXED_TRAIN = """
    hw AS (
      SELECT City, 12 AS i, l, b, list_transform(ys[1:12], lambda y: y - l) AS s FROM (
        SELECT City, ys, list_sum(ys[1:12]) / 12.0::double AS l,
               (list_sum(ys[13:24]) - list_sum(ys[1:12])) / 144.0::double AS b FROM series)
      UNION ALL
      SELECT City, i + 1 AS i, 0.3::double * (y - s[1]) + (1 - 0.3::double) * (l + b) AS l,
             0.1::double * ((0.3::double * (y - s[1]) + (1 - 0.3::double) * (l + b)) - l) + (1 - 0.1::double) * b AS b,
             list_concat(s[2:12], [0.2::double * (y - (l + b)) + (1 - 0.2::double) * s[1]]) AS s
      FROM (SELECT r.*, p.ys[r.i + 1] AS y FROM hw r JOIN series p USING (City) WHERE r.i < p.n)),
    long AS (
      SELECT City, 'holt_winters' AS model, h::int AS step, cast(last_period + to_months(h::int) AS date) AS ds,
             l + h * b + s[((h - 1) % 12)::int + 1] AS yhat
      FROM hw JOIN series USING (City), (SELECT unnest(range(1, 37)) AS h) WHERE i = n),
    months AS (SELECT DISTINCT City, date_trunc('month', period) AS m FROM test)
"""


@register(
    "forecast_month_semijoin",
    f"""{_TRAIN}, {_FIXED_TRAIN}
    SELECT City, model, step, ds, round(yhat, 2) AS yhat FROM long JOIN months ON months.City = long.City
      AND m = date_trunc('month', ds) WHERE step <= 36
    """.replace("SELECT City, model, step", "SELECT long.City, model, step"),
)
def forecast_month_semijoin(spark, sf_dir):
    _, test, future = _train_forecasts(spark, sf_dir, 36)
    return _rounded(metrics.keep_test_months(future, test, KEYS))


@register(
    "coverage_guard",
    f"""{_TRAIN}, {_FIXED_TRAIN},
    ses AS (
      SELECT City, 1 AS i, ys[1] AS l FROM series
      UNION ALL
      SELECT City, i + 1 AS i, 0.3::double * y + (1 - 0.3::double) * l AS l
      FROM (SELECT r.*, p.ys[r.i + 1] AS y FROM ses r JOIN series p USING (City) WHERE r.i < p.n)),
    flat AS (
      SELECT City, 'ses' AS model, h::int AS step, cast(last_period + to_months(h::int) AS date) AS ds, l AS yhat
      FROM ses JOIN series USING (City), (SELECT unnest(range(1, 37)) AS h) WHERE i = n),
    need AS (SELECT City, count(*) AS needed FROM test GROUP BY 1),
    have AS (
      SELECT need.City, needed, count(long.ds) AS have FROM need
        LEFT JOIN months ON months.City = need.City
        LEFT JOIN long ON long.City = need.City AND date_trunc('month', ds) = m AND step <= 16 GROUP BY 1, 2),
    pick AS (
      SELECT long.*, true AS covered FROM long JOIN have USING (City) WHERE step <= 16 AND have = needed
      UNION ALL
      SELECT flat.*, false AS covered FROM flat JOIN have USING (City) WHERE have <> needed)
    SELECT pick.City, model, ds, round(yhat, 2) AS yhat, covered FROM pick JOIN months
      ON months.City = pick.City AND m = date_trunc('month', ds)
    """,
)
def coverage_guard(spark, sf_dir):
    """A short horizon covers the test part only of series without late gaps."""
    train, test, future = _train_forecasts(spark, sf_dir, 16)
    level = smoothing.fixed(train.withColumn("steps", F.lit(36)), smoothing.LEVEL, SEASON, **FIXED)
    fallback = explode_forecast(smoothing.forecast_array(level), KEYS, "MS", ["model"])
    columns = ["City", "model", "ds", "yhat"]
    return _rounded(metrics.choose_covering(future.select(*columns), fallback.select(*columns), test, KEYS))


# --- one linear model over all sequences ------------------------------------------------

_PRODUCTS = products([f"f{i}" for i in range(7)], "v")
_STEP = " + ".join([f"x{i} * s[{i + 1}]" for i in range(6)] + ["x6"])


def _register_sequence(name: str, **options) -> None:
    @register(name, SEQUENCE_AHEAD)
    def run(spark, sf_dir):
        panel = stand_in.city_panel(spark, sf_dir)
        return _rounded(forecasting.forecast(panel, KEYS, "MS", ["sequence"], HORIZON, **options), 0)


_LAGS = ", ".join(f"lag(v, {6 - i}) OVER (PARTITION BY City ORDER BY period) AS f{i}" for i in range(6))
SEQUENCE_AHEAD = f"""WITH RECURSIVE panel AS ({CITY_PANEL}),
    bounds AS (SELECT City, min(sales) AS low, max(sales) AS high, max(period) AS last_period FROM panel GROUP BY 1),
    scaled AS (SELECT City, period, (sales - low) / (high - low) AS v FROM panel JOIN bounds USING (City)),
    rows AS (SELECT v, 1.0::double AS f6, {_LAGS} FROM scaled),
    weights AS ({cholesky(f"SELECT {_PRODUCTS} FROM rows WHERE f0 IS NOT NULL", 7)}),
    ahead AS (
      SELECT City, 0 AS step, list(v ORDER BY period)[-6:] AS s FROM scaled GROUP BY City
      UNION ALL
      SELECT City, step + 1 AS step, list_concat(s[2:6], [{_STEP}]) AS s FROM ahead, weights WHERE step < 6),
    f AS (
      SELECT City, cast(last_period + to_months(step::int) AS date) AS ds, s[6] * (high - low) + low AS yhat
      FROM ahead JOIN bounds USING (City) WHERE step > 0)
    SELECT City, 'sequence' AS model, 'sequence' AS variant, ds, round(yhat, 0) AS yhat,
           round(yhat * 0.92::double, 0) AS yhat_lower, round(yhat * 1.08::double, 0) AS yhat_upper
    FROM f
    """
_register_sequence("sequence_linear_forecast", sequence_kind="linear")
_register_sequence("sequence_forecast")


@register("sequence_stored_forecast", SEQUENCE_AHEAD)
def sequence_stored_forecast(spark, sf_dir):
    """Model and states written as tables; the forecast reads these and trains nothing."""
    panel = stand_in.city_panel(spark, sf_dir)
    path = scratch_path(spark, "sequence_model")
    model = forecasting.train_sequence(panel, KEYS)
    forecasting.save_sequence(model, path)
    states = materialize(forecasting.fit_parameters(panel, KEYS, "sequence", sequence_model=model), "states")
    again = forecasting.load_sequence(spark, path)
    return _rounded(forecasting.forecast_parameters(states, KEYS, "sequence", sequence_model=again), 0)


# One tree with one cut: of 31 candidates a feature at equal shares of the rows, that of the largest gain.
_STUMP_AHEAD = f"""WITH RECURSIVE panel AS ({CITY_PANEL}),
    bounds AS (SELECT City, min(sales) AS low, max(sales) AS high, max(period) AS last_period FROM panel GROUP BY 1),
    scaled AS (SELECT City, period, (sales - low) / (high - low) AS v FROM panel JOIN bounds USING (City)),
    rows AS (
      SELECT *, row_number() OVER (PARTITION BY City ORDER BY period) AS pos, count(*) OVER (PARTITION BY City) AS n
      FROM (SELECT City, period, v, {_LAGS} FROM scaled) WHERE f0 IS NOT NULL),
    train AS (SELECT * FROM rows WHERE pos <= greatest(1, floor(n * 0.8::double))),
    long AS (SELECT v AS y, unnest([0, 1, 2, 3, 4, 5]) AS feature, unnest([f0, f1, f2, f3, f4, f5]) AS x FROM train),
    steps AS (
      SELECT feature, x, sum(count(*)) OVER (PARTITION BY feature ORDER BY x) AS upto, (SELECT count(*) FROM train) / 32.0::double AS share,
             lead(x) OVER (PARTITION BY feature ORDER BY x) AS following, lead(count(*)) OVER (PARTITION BY feature ORDER BY x) AS more
      FROM long GROUP BY feature, x),
    passed AS (SELECT *, ceil((upto + more / 2.0::double) / share) - 1 AS e FROM steps WHERE following IS NOT NULL),
    cuts AS (
      SELECT feature, (x + following) / 2 AS cut FROM (
        SELECT *, coalesce(lag(e) OVER (PARTITION BY feature ORDER BY x), 0) AS before FROM passed) WHERE e > before),
    sides AS (
      SELECT c.feature, cut, sum(y) FILTER (x <= cut) AS sl, count(*) FILTER (x <= cut) AS nl, sum(y) FILTER (x > cut) AS sr, count(*) FILTER (x > cut) AS nr
      FROM cuts c JOIN long l ON l.feature = c.feature GROUP BY 1, 2),
    tree AS (SELECT feature, cut, sl / nl AS low_value, sr / nr AS high_value FROM sides ORDER BY sl * sl / nl + sr * sr / nr DESC, feature LIMIT 1),
    ahead AS (
      SELECT City, 0 AS step, list(v ORDER BY period)[-6:] AS s FROM scaled GROUP BY City
      UNION ALL
      SELECT City, step + 1 AS step, list_concat(s[2:6], [CASE WHEN s[feature + 1] <= cut THEN low_value ELSE high_value END]) AS s
      FROM ahead, tree WHERE step < 6),
    f AS (
      SELECT City, cast(last_period + to_months(step::int) AS date) AS ds, s[6] * (high - low) + low AS yhat
      FROM ahead JOIN bounds USING (City) WHERE step > 0)
    SELECT City, 'sequence' AS model, 'sequence' AS variant, ds, round(yhat, 0) AS yhat,
           round(yhat * 0.92::double, 0) AS yhat_lower, round(yhat * 1.08::double, 0) AS yhat_upper
    FROM f
    """


@register("sequence_stump_forecast", _STUMP_AHEAD)
def sequence_stump_forecast(spark, sf_dir):
    """The recursion over trees, with the smallest tree."""
    panel = stand_in.city_panel(spark, sf_dir)
    model = forecasting.train_sequence(panel, KEYS, "gbt", rounds=1, depth=1)
    return _rounded(forecasting.forecast(panel, KEYS, "MS", ["sequence"], HORIZON, sequence_model=model), 0)


_CALENDAR = (
    "(isodow({d}) - 1)::double", "month({d})::double", "quarter({d})::double",
    "(month({d}) IN (3, 9, 10, 11))::int::double", "(floor(((month({d}) + 8) % 12) / 3) + 1)::double",
)
_CAL_ROWS = ", ".join(f"{c.format(d='period')} AS f{6 + i}" for i, c in enumerate(_CALENDAR))
_CAL_STEP = " + ".join(
    [f"x{i} * s[{i + 1}]" for i in range(6)] + [f"x{6 + i} * {c.format(d='ds')}" for i, c in enumerate(_CALENDAR)] + ["x11"]
)


@register(
    "sequence_calendar_forecast",
    f"""WITH RECURSIVE panel AS ({CITY_PANEL}),
    bounds AS (SELECT City, min(sales) AS low, max(sales) AS high, max(period) AS last_period FROM panel GROUP BY 1),
    scaled AS (SELECT City, period, (sales - low) / (high - low) AS v FROM panel JOIN bounds USING (City)),
    rows AS (SELECT v, 1.0::double AS f11, {_LAGS}, {_CAL_ROWS} FROM scaled),
    weights AS ({cholesky(f"SELECT {products([f'f{i}' for i in range(12)], 'v')} FROM rows WHERE f0 IS NOT NULL", 12)}),
    ahead AS (
      SELECT City, 0 AS step, list(v ORDER BY period)[-6:] AS s, cast(max(period) + to_months(1) AS date) AS ds
      FROM scaled GROUP BY City
      UNION ALL
      SELECT City, step + 1 AS step, list_concat(s[2:6], [{_CAL_STEP}]) AS s, cast(ds + to_months(1) AS date) AS ds
      FROM ahead, weights WHERE step < 6),
    f AS (
      SELECT City, cast(last_period + to_months(step::int) AS date) AS ds, s[6] * (high - low) + low AS yhat
      FROM ahead JOIN bounds USING (City) WHERE step > 0)
    SELECT City, 'sequence' AS model, 'sequence' AS variant, ds, round(yhat, 0) AS yhat,
           round(yhat * 0.92::double, 0) AS yhat_lower, round(yhat * 1.08::double, 0) AS yhat_upper
    FROM f
    """,
)
def sequence_calendar_forecast(spark, sf_dir):
    panel = stand_in.city_panel(spark, sf_dir)
    rows = forecasting.forecast(panel, KEYS, "MS", ["sequence"], HORIZON, sequence_kind="linear", calendar=True)
    return _rounded(rows, 0)


_SEQUENCE_TEST = f"""
    bounds AS (SELECT City, min(sales) AS low, max(sales) AS high FROM train GROUP BY 1),
    scaled AS (SELECT City, period, sales, split, low, high, (sales - low) / (high - low) AS v FROM marked JOIN bounds USING (City)),
    rows AS (SELECT *, 1.0::double AS f6, {_LAGS} FROM scaled),
    weights AS ({cholesky(f"SELECT {_PRODUCTS} FROM rows WHERE f0 IS NOT NULL AND split = 'train'", 7)}),
    sequences AS (
      SELECT City, 'sequence' AS model, period AS ds, sales AS y,
             ({" + ".join(f"x{i} * f{i}" for i in range(7))}) * (high - low) + low AS yhat
      FROM rows, weights WHERE split = 'test')
"""


@register(
    "sequence_holdout",
    f"""{_TRAIN}, {_SEQUENCE_TEST}
    SELECT City, model, ds, y, round(yhat, 0) AS yhat FROM sequences
    """,
)
def sequence_holdout(spark, sf_dir):
    series = hold_out(series_arrays(stand_in.city_panel(spark, sf_dir), KEYS), "MS")
    model = sequence.fit(sequence.training_rows(series, KEYS))
    return _rounded(sequence.predict_test(model, series, KEYS), 0, ("yhat",))


_BOARD = f"""{_TRAIN}, {_search("series")}, {arima_211("series")}, {_SEQUENCE_TEST},
    m AS (
      SELECT City, model, round_even(avg(abs(y - yhat)), 0) AS mae, round_even(sqrt(avg((y - yhat) * (y - yhat))), 0) AS rmse,
             round_even(avg(abs((y - yhat) / y)) * 100, 2) AS mape
      FROM ({_HW_TEST} UNION ALL {_ARIMA_TEST} UNION ALL SELECT * FROM sequences) GROUP BY 1, 2)
    SELECT *, row_number() OVER (PARTITION BY City ORDER BY mape, model) = 1 AS is_best FROM m
    """
_CLOSED = ["arima", "holt_winters", "sequence"]


def _board(ranked):
    ranked = ranked.drop("mae_text", "rmse_text")
    return ranked.withColumns({"mae": F.round("mae", 0), "rmse": F.round("rmse", 0)})


@register("backtest_closed_models", _BOARD)
def backtest_closed_models(spark, sf_dir):
    """The three models that SQL can state, on one board."""
    panel = stand_in.city_panel(spark, sf_dir)
    scores = metrics.score(forecasting.backtest(panel, KEYS, "MS", _CLOSED), KEYS)
    return _board(metrics.leaderboard(scores, KEYS, _CLOSED))


@register("model_comparison_closed", _BOARD)
def model_comparison_closed(spark, sf_dir):
    facts = stand_in.city_facts(spark, sf_dir)
    return _board(reports.ModelComparison(facts, KEYS, models=_CLOSED, sales_col="Revenue").leaderboard)


@register(
    "dashboard_arima_forecast",
    f"""WITH RECURSIVE panel AS (
      SELECT City, last_day(period) AS period, sales FROM ({CITY_PANEL}) WHERE City = 'NATION_7'),
    series AS ({series_cte("panel")}), {arima_211("series")}
    SELECT 'arima' AS model, 'arima' AS variant, last_day(cast(last_period + to_months(step::int) AS date)) AS ds,
           round(level * scale, 0) AS yhat, round(level * scale * 0.92::double, 0) AS yhat_lower,
           round(level * scale * 1.08::double, 0) AS yhat_upper
    FROM ahead JOIN series USING (City) WHERE step BETWEEN 1 AND 6
    """,
)
def dashboard_arima_forecast(spark, sf_dir):
    facts = stand_in.city_facts(spark, sf_dir)
    return _rounded(reports.Dashboard(facts, city="NATION_7", models=["arima"], horizon=HORIZON).forecast, 0)


_WAVES = " + ".join(
    f"0.01::double * {place + 1} * {trig}(d * {2 * math.pi * k / period!r}::double)"
    for place, (trig, period, k) in enumerate(
        (trig, period, k) for period, pairs in ((365.25, 10), (30.5, 3)) for trig in ("sin", "cos") for k in range(1, pairs + 1)
    )
)


@register(
    "additive_given_curve",
    f"""{_WHOLE},
    c AS (
      SELECT City, last_period, list_max(ys) AS scale, datediff('day', DATE '1970-01-01', periods[1])::double AS t0,
             datediff('day', periods[1], last_period)::double AS span FROM series),
    p AS (
      SELECT *, datediff('day', DATE '1970-01-01', ds)::double AS d
      FROM (SELECT c.*, cast(last_period + to_months(h::int) AS date) AS ds FROM c, (SELECT unnest(range(1, 7)) AS h))),
    v AS (
      SELECT *, scale * (0.5::double + 0.2::double * ((d - t0) / span)
             + 0.1::double * greatest((d - t0) / span - 0.5::double, 0) + {_WAVES}) AS yhat FROM p)
    SELECT City, 'additive' AS model, 'additive' AS variant, ds, round(yhat, 2) AS yhat,
           round(yhat - 0.05::double * scale * 1.2816::double, 2) AS yhat_lower,
           round(yhat + 0.05::double * scale * 1.2816::double, 2) AS yhat_upper
    FROM v
    """,
)
def additive_given_curve(spark, sf_dir):
    """Curve and band of stored additive parameters that are given instead of fitted."""
    first = F.expr("unix_date(periods[0])").cast("double")
    span = F.expr("date_diff(last_period, periods[0])").cast("double")
    curve = F.struct(
        first.alias("t0"),
        span.alias("span"),
        F.array_max("ys").alias("scale"),
        F.lit(0.05).alias("sigma"),
        F.array(F.lit(0.5), F.lit(0.2)).alias("trend"),
        F.array(first + span / 2).alias("changes"),
        F.array(F.lit(0.1)).alias("hinges"),
        F.array(*[F.lit(0.01 * (i + 1)) for i in range(26)]).alias("season"),
    )
    state = [F.lit(None).cast(t).alias(c) for c, t in (("level", "double"), ("trend", "double"), ("season", "array<double>"))]
    params = _series(spark, sf_dir).select("City", F.lit("additive").alias("model"), "n", "last_period", curve.alias("curve"), *state)
    return _rounded(forecasting.forecast_parameters(params, KEYS, "additive"))


# One yearly pair, one change of slope, noise given: the posterior mean by normal equations.
_PRIORS = (5.0, 5.0, 0.05, 10.0, 10.0)
_TURN = f"(d * {2 * math.pi / 365.25!r}::double)"
_REDUCED_X = ("1.0::double", "(d - t0) / span", "greatest((d - c0) / span, 0)", f"sin({_TURN})", f"cos({_TURN})")


@register(
    "additive_reduced",
    f"""{_WHOLE},
    c AS (
      SELECT City, last_period, list_max(ys) AS scale, datediff('day', DATE '1970-01-01', periods[1])::double AS t0,
             datediff('day', periods[1], last_period)::double AS span,
             datediff('day', DATE '1970-01-01', periods[floor(0.8::double * n)::int])::double AS c0 FROM series),
    p AS (
      SELECT City, scale, t0, span, c0, sales / scale AS v, datediff('day', DATE '1970-01-01', period)::double AS d FROM panel JOIN c USING (City)),
    x AS (SELECT City, v, {", ".join(f"{w!r}::double * ({e}) AS f{i}" for i, (w, e) in enumerate(zip(_PRIORS, _REDUCED_X, strict=True)))} FROM p),
    b AS ({cholesky(f"SELECT City, {products([f'f{i}' for i in range(5)], 'v', ' + 0.0025::double')} FROM x GROUP BY City", 5)}),
    a AS (
      SELECT *, datediff('day', DATE '1970-01-01', ds)::double AS d
      FROM (SELECT c.*, cast(last_period + to_months(h::int) AS date) AS ds FROM c, (SELECT unnest(range(1, 7)) AS h)) c),
    f AS (
      SELECT City, ds, scale, scale * ({" + ".join(f"x{i} * {w!r}::double * ({e})" for i, (w, e) in enumerate(zip(_PRIORS, _REDUCED_X, strict=True)))}) AS yhat
      FROM a JOIN b USING (City))
    SELECT City, 'additive' AS model, ds, round(yhat, 0) AS yhat, round(yhat - 0.05::double * scale * 1.2816::double, 0) AS yhat_lower,
           round(yhat + 0.05::double * scale * 1.2816::double, 0) AS yhat_upper
    FROM f
    """,
)
def additive_reduced(spark, sf_dir):
    """The fit itself, small enough for SQL: given noise, one yearly pair and one change of slope."""
    seasons = ((365.25, 1),)
    fitted = additive.fit(_series(spark, sf_dir), seasons, changes=1, noise=0.05)
    return _rounded(additive.forecast(fitted, KEYS, "MS", history=False, seasons=seasons), 0)


# --- models without a SQL equivalent -----------------------------------------------------


@register("additive_forecast")
def additive_forecast(spark, sf_dir):
    """The forecast of the whole API, so that short series have their stand-in."""
    return forecasting.forecast(stand_in.city_panel(spark, sf_dir), KEYS, "MS", ["additive"], HORIZON)


@register("sequence_tree_forecast")
def sequence_tree_forecast(spark, sf_dir):
    panel = stand_in.city_panel(spark, sf_dir)
    return forecasting.forecast(panel, KEYS, "MS", ["sequence"], HORIZON, sequence_kind="gbt")


@register("backtest_all_models")
def backtest_all_models(spark, sf_dir):
    panel = stand_in.city_panel(spark, sf_dir)
    scores = metrics.score(forecasting.backtest(panel, KEYS, "MS"), KEYS)
    return metrics.leaderboard(scores, KEYS, forecasting.MODELS)


@register("model_comparison")
def model_comparison(spark, sf_dir):
    facts = stand_in.city_facts(spark, sf_dir)
    return reports.ModelComparison(facts, KEYS, sales_col="Revenue").leaderboard


@register("dashboard_forecast")
def dashboard_forecast(spark, sf_dir):
    facts = stand_in.city_facts(spark, sf_dir)
    return reports.Dashboard(facts, city="NATION_7", horizon=HORIZON).forecast


# --- many series -------------------------------------------------------------------------


def _store_panel(spark, sf_dir):
    return periods.to_periods(stand_in.line_facts(spark, sf_dir), ["Store_ID"], "MS")


# The store takes the place of the city in the shared fragments.
_STORES = f"""WITH RECURSIVE panel AS (
    SELECT l_suppkey AS City, cast(date_trunc('month', l_shipdate) AS date) AS period,
           cast(sum({NET}) AS double) AS sales
    FROM lineitem GROUP BY 1, 2 HAVING sum({NET}) > 0),
  series AS ({series_cte("panel")})"""


@register(
    "store_hw_forecast",
    f"""{_STORES}, {_search("series")}, f AS ({_HW_AHEAD})
    SELECT City AS Store_ID, 'holt_winters' AS model, 'holt_winters' AS variant, ds, round(yhat, 2) AS yhat,
           round(yhat * 0.92::double, 2) AS yhat_lower, round(yhat * 1.08::double, 2) AS yhat_upper
    FROM f
    """,
)
def store_hw_forecast(spark, sf_dir):
    return _rounded(forecasting.forecast(_store_panel(spark, sf_dir), ["Store_ID"], "MS", ["holt_winters"]))


@register(
    "store_arima_forecast",
    f"""{_STORES}, {arima_211("series")}
    SELECT City AS Store_ID, 'arima' AS model, 'arima' AS variant, cast(last_period + to_months(step::int) AS date) AS ds,
           round(level * scale, 0) AS yhat, round(level * scale * 0.92::double, 0) AS yhat_lower,
           round(level * scale * 1.08::double, 0) AS yhat_upper
    FROM ahead JOIN series USING (City) WHERE step BETWEEN 1 AND 6
    """,
)
def store_arima_forecast(spark, sf_dir):
    return _rounded(forecasting.forecast(_store_panel(spark, sf_dir), ["Store_ID"], "MS", ["arima"]), 0)


@register("store_additive_forecast")
def store_additive_forecast(spark, sf_dir):
    return forecasting.forecast(_store_panel(spark, sf_dir), ["Store_ID"], "MS", ["additive"])


# --- short series ------------------------------------------------------------------------

CUSTOMERS = ["o_custkey"]
_QUARTERS = """
    panel AS (
      SELECT o_custkey, cast(date_trunc('quarter', o_orderdate) AS date) AS period FROM orders
      GROUP BY 1, 2 HAVING sum(cast(o_totalprice AS decimal(18,2))) > 0),
    counts AS (SELECT o_custkey, count(*) AS n FROM panel GROUP BY 1),
    models AS (SELECT unnest(['arima', 'holt_winters', 'additive', 'sequence']) AS model)"""


def _variant(n: str) -> str:
    """The kind that serves a quarterly series of ``n`` fitted points."""
    smoother = f"CASE WHEN {n} >= 8 THEN 'holt_winters' WHEN {n} >= 3 THEN 'holt' ELSE 'ses' END"
    return f"""CASE model
        WHEN 'arima' THEN CASE WHEN {n} >= 9 THEN 'arima' WHEN {n} >= 3 THEN 'holt' ELSE 'ses' END
        WHEN 'additive' THEN CASE WHEN {n} >= 5 THEN 'additive' ELSE {smoother} END
        WHEN 'sequence' THEN CASE WHEN {n} >= 6 THEN 'sequence' ELSE {smoother} END
        ELSE {smoother} END"""


def _customer_panel(spark, sf_dir):
    return periods.to_periods(stand_in.order_facts(spark, sf_dir), CUSTOMERS, "QS", sales_col="Revenue", scale=2)


@register(
    "customer_forecast_variants",
    f"""WITH {_QUARTERS}
    SELECT o_custkey, model, {_variant("n")} AS variant, 6::bigint AS n_rows, 6::bigint AS n_values FROM counts, models
    """,
)
def customer_forecast_variants(spark, sf_dir):
    """Every model answers for every customer, however few quarters there are."""
    rows = forecasting.forecast(_customer_panel(spark, sf_dir), CUSTOMERS, "QS")
    return rows.groupBy("o_custkey", "model", "variant").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("yhat").alias("n_values")
    )


@register(
    "customer_backtest_status",
    f"""WITH {_QUARTERS},
    cuts AS (SELECT *, floor(n * (1 - 0.2::double))::bigint AS k FROM counts)
    SELECT o_custkey, model, CASE WHEN n < 5 THEN NULL ELSE {_variant("k")} END AS variant,
           CASE WHEN n < 5 THEN 'too_short' ELSE 'ok' END AS status, CASE WHEN n < 5 THEN 0 ELSE n - k END::bigint AS n_scored
    FROM cuts, models
    """,
)
def customer_backtest_status(spark, sf_dir):
    """Every model is scored on the same dates; series too short to be cut say so."""
    rows = forecasting.backtest(_customer_panel(spark, sf_dir), CUSTOMERS, "QS")
    return rows.groupBy("o_custkey", "model", "variant", "status").agg(F.count("yhat").alias("n_scored"))


def _short_search(kind: str) -> str:
    """CTEs that end in ``{kind}_final(o_custkey, l, b)``: the grid search of a smoother without a season, one pass
    around the winner, and the last state under the winning parameters."""
    trend = kind == smoothing.TREND
    start = "ys[2] AS l, ys[2] - ys[1] AS b, 2 AS i" if trend else "ys[1] AS l, 0.0::double AS b, 1 AS i"
    level = "alpha * y + (1 - alpha) * (l + b)"
    slope = f"beta * (({level}) - l) + (1 - beta) * b" if trend else "b"
    grid = ", ".join(f"({round(0.1 * i, 1)}::double)" for i in range(1, 10))
    betas = grid if trend else "(0.0::double)"
    moves = "(-0.05::double), (0.0::double), (0.05::double)"
    clip = "greatest(0.01::double, least(0.99::double, {}))"
    around = clip.format("beta + db") if trend else "beta"

    def run(name: str, candidates: str) -> str:
        return f"""
    {name} AS (
      SELECT o_custkey, alpha, beta, i, l, b, 0.0::double AS sse FROM {kind}_start JOIN {candidates} USING (o_custkey)
      UNION ALL
      SELECT o_custkey, alpha, beta, i + 1 AS i, {level} AS l, {slope} AS b, sse + (y - (l + b)) * (y - (l + b)) AS sse
      FROM (SELECT r.*, p.ys[r.i + 1] AS y FROM {name} r JOIN {kind}_series p USING (o_custkey) WHERE r.i < p.n))"""

    def winner(name: str, source: str) -> str:
        return f"""
    {name} AS (
      SELECT * FROM (
        SELECT r.*, row_number() OVER (PARTITION BY r.o_custkey ORDER BY sse, alpha, beta) AS place
        FROM {source} r JOIN {kind}_series p USING (o_custkey) WHERE r.i = p.n) WHERE place = 1)"""

    return f"""
    {kind}_series AS (SELECT * FROM series WHERE {"n BETWEEN 3 AND 7" if trend else "n < 3"}),
    {kind}_start AS (SELECT o_custkey, {start} FROM {kind}_series),
    {kind}_coarse AS (SELECT o_custkey, alpha, beta FROM {kind}_series, (VALUES {grid}) x(alpha), (VALUES {betas}) y(beta)),
    {run(f"{kind}_run", f"{kind}_coarse")}, {winner(f"{kind}_best", f"{kind}_run")},
    {kind}_fine AS (
      SELECT DISTINCT o_custkey, {clip.format("alpha + da")} AS alpha, {around} AS beta
      FROM {kind}_best, (VALUES {moves}) x(da), (VALUES {moves}) y(db)),
    {run(f"{kind}_fine_run", f"{kind}_fine")}, {winner(f"{kind}_final", f"{kind}_fine_run")}"""


@register(
    "customer_short_values",
    f"""
    WITH RECURSIVE panel AS (
      SELECT o_custkey, cast(date_trunc('quarter', o_orderdate) AS date) AS period, cast(sum(cast(o_totalprice AS decimal(18,2))) AS double) AS sales
      FROM orders GROUP BY 1, 2 HAVING sum(cast(o_totalprice AS decimal(18,2))) > 0),
    series AS (
      SELECT o_custkey, list(sales ORDER BY period) AS ys, count(*) AS n, max(period) AS last_period FROM panel GROUP BY 1),
    {_short_search(smoothing.TREND)}, {_short_search(smoothing.LEVEL)}
    SELECT o_custkey, kind AS variant, cast(last_period + to_months((3 * h)::int) AS date) AS ds, round(l + h * b, 1) AS yhat
    FROM (SELECT o_custkey, 'holt' AS kind, l, b FROM holt_final UNION ALL SELECT o_custkey, 'ses', l, b FROM ses_final)
      JOIN series USING (o_custkey), (SELECT unnest(range(1, 7)) AS h)
    """,
)
def customer_short_values(spark, sf_dir):
    """Forecasts of the customers too short for a season: the searched trend, and the level below three quarters."""
    rows = forecasting.forecast(_customer_panel(spark, sf_dir), CUSTOMERS, "QS", ["holt_winters"])
    short = rows.where(F.col("variant").isin(smoothing.TREND, smoothing.LEVEL))
    return short.select("o_custkey", "variant", "ds", F.round("yhat", 1).alias("yhat"))
