"""Period aggregation, features, splits, scaling, decomposition and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.catalog import facts as stand_in
from panelcast.catalog.registry import register
from panelcast.catalog.sql_text import CITY_JOIN, CITY_PANEL, NET, ORDER_SUM, PERIOD_SQL, SPLIT, TOTAL_PANEL
from panelcast.functions import money
from panelcast.operators import features, metrics, periods, scale, split, summaries
from panelcast.operators.decompose import decompose
from panelcast.session import scratch_path
from panelcast.sources import sinks

KEYS = ["City"]


def _register_order_period(freq: str) -> None:
    label = PERIOD_SQL[freq].format(d="o_orderdate")

    @register(
        f"period_{freq.lower()}" if freq not in ("M", "Q", "Y") else f"period_{freq.lower()}_end",
        f"SELECT cast({label} AS date) AS period, cast({ORDER_SUM} AS double) AS sales "
        f"FROM orders GROUP BY 1 HAVING {ORDER_SUM} > 0",
    )
    def run(spark, sf_dir):
        return stand_in.total_panel(spark, sf_dir, freq)


for _freq in ("MS", "QS", "YS", "M", "Q", "Y", "D", "W"):
    _register_order_period(_freq)


def _register_event_period(freq: str, name: str) -> None:
    label = PERIOD_SQL[freq].format(d="ts")
    total = "sum(cast(value AS decimal(18,2)))"

    @register(
        name,
        f"SELECT event_type AS Category, cast({label} AS timestamp) AS period, cast({total} AS double) AS sales "
        f"FROM events GROUP BY 1, 2 HAVING {total} > 0",
    )
    def run(spark, sf_dir):
        return periods.to_periods(
            stand_in.event_facts(spark, sf_dir), ["Category"], freq, sales_col="Revenue", scale=2
        )


def _register_multiple(freq: str, label: str) -> None:
    @register(
        f"period_{freq.lower().replace('-', '_')}",
        f"""
        WITH base AS (SELECT {label.format(d="o_orderdate")} AS p, {ORDER_SUM} AS total FROM orders GROUP BY 1),
        f AS (SELECT min(p) AS first FROM base)
        SELECT cast({_MULTIPLES[freq]} AS date) AS period, cast(sum(total) AS double) AS sales
        FROM base, f GROUP BY 1 HAVING sum(total) > 0
        """,
    )
    def run(spark, sf_dir):
        return stand_in.total_panel(spark, sf_dir, freq)


_MULTIPLES = {
    "2MS": "first + to_months((datediff('month', first, p) // 2 * 2)::int)",
    "2W": "first + to_days((ceil(datediff('day', first, p) / 14.0) * 14)::int)",
    "W-MON": "p",
}
_register_multiple("2MS", "cast(date_trunc('month', {d}) AS date)")
_register_multiple("2W", "cast(date_trunc('week', {d}) AS date) + 6")
_register_multiple("W-MON", "cast(date_trunc('week', cast({d} AS date) - 1) AS date) + 7")

_register_event_period("15min", "period_15min")
_register_event_period("h", "period_hour")


@register("period_by_city", CITY_PANEL)
def period_by_city(spark, sf_dir):
    return stand_in.city_panel(spark, sf_dir)


@register(
    "period_by_store",
    f"""
    SELECT l_suppkey AS Store_ID, cast(date_trunc('quarter', l_shipdate) AS date) AS period,
           cast(sum({NET}) AS double) AS sales
    FROM lineitem GROUP BY 1, 2 HAVING sum({NET}) > 0
    """,
)
def period_by_store(spark, sf_dir):
    return periods.to_periods(stand_in.line_facts(spark, sf_dir), ["Store_ID"], "QS")


@register("period_city", f"SELECT period, sales FROM ({CITY_PANEL}) WHERE City = 'NATION_7'")
def period_city(spark, sf_dir):
    facts = stand_in.city_facts(spark, sf_dir)
    return periods.to_periods(facts, (), "MS", {"City": "NATION_7"}, "Revenue", scale=2)


@register(
    "period_store",
    f"""
    SELECT cast(date_trunc('month', l_shipdate) AS date) AS period, cast(sum({NET}) AS double) AS sales
    FROM lineitem WHERE l_suppkey = 42 GROUP BY 1
    """,
)
def period_store(spark, sf_dir):
    return periods.to_periods(stand_in.line_facts(spark, sf_dir), (), "MS", {"Store_ID": 42}, "Revenue")


@register(
    "period_gaps_filled",
    f"""
    WITH w AS (
      SELECT o_custkey, cast(date_trunc('month', o_orderdate) AS date) AS period,
             cast({ORDER_SUM} AS double) AS sales FROM orders GROUP BY 1, 2),
    cal AS (
      SELECT o_custkey, unnest(generate_series(min(period), max(period), INTERVAL 1 MONTH))::date AS period
      FROM w GROUP BY 1)
    SELECT o_custkey, period, coalesce(sales, 0.0) AS sales FROM cal LEFT JOIN w USING (o_custkey, period)
    """,
)
def period_gaps_filled(spark, sf_dir):
    return periods.to_periods(
        stand_in.order_facts(spark, sf_dir), ["o_custkey"], "MS", sales_col="Revenue", scale=2, fill_gaps=True
    )


@register("series_preview", f"SELECT period, sales FROM ({TOTAL_PANEL}) ORDER BY period LIMIT 8")
def series_preview(spark, sf_dir):
    return periods.preview(stand_in.total_panel(spark, sf_dir), 8)


@register(
    "kpi_row",
    f"""
    SELECT City, count(*) AS n_periods, round(sum(sales), 2) AS total_sales, round(avg(sales), 6) AS mean_sales,
           max(sales) AS peak_sales, arg_max(period, (sales, -epoch(period))) AS peak_period
    FROM ({CITY_PANEL}) GROUP BY City
    """,
)
def kpi_row(spark, sf_dir):
    kpi = summaries.kpi_row(stand_in.city_panel(spark, sf_dir), KEYS)
    return kpi.withColumns({"total_sales": F.round("total_sales", 2), "mean_sales": F.round("mean_sales", 6)})


@register(
    "kpi_total",
    f"""
    SELECT count(*) AS n_periods, format('{{:,.0f}}', sum(sales)) AS total_text,
           format('{{:.2f}}', sum(sales) / 1e7) || 'Cr' AS total_crore, max(sales) AS peak_sales,
           arg_max(period, (sales, -epoch(period))) AS peak_period
    FROM ({TOTAL_PANEL})
    """,
)
def kpi_total(spark, sf_dir):
    kpi = summaries.kpi_row(stand_in.total_panel(spark, sf_dir))
    return kpi.select(
        "n_periods",
        money.with_separators(F.col("total_sales")).alias("total_text"),
        money.in_crore(F.col("total_sales")).alias("total_crore"),
        "peak_sales",
        "peak_period",
    )


@register(
    "calendar_features",
    f"""
    SELECT period, sales, (isodow(period) - 1)::int AS dayofweek, day(period)::int AS day, month(period)::int AS month,
           quarter(period)::int AS quarter, year(period)::int AS year, dayofyear(period)::int AS dayofyear,
           (isodow(period) >= 6)::int AS is_weekend, (month(period) IN (3, 9, 10, 11))::int AS is_festive_month,
           CASE WHEN month(period) BETWEEN 4 AND 6 THEN 1 WHEN month(period) BETWEEN 7 AND 9 THEN 2
                WHEN month(period) >= 10 THEN 3 ELSE 4 END AS india_fy_quarter,
           (month(period) IN (4, 5, 6))::int AS is_summer, (month(period) IN (12, 1, 2))::int AS is_winter
    FROM (SELECT cast(o_orderdate AS date) AS period, cast({ORDER_SUM} AS double) AS sales FROM orders GROUP BY 1)
    """,
)
def calendar_features(spark, sf_dir):
    daily = stand_in.total_panel(spark, sf_dir, "D")
    flags = {"is_summer": (4, 5, 6), "is_winter": (12, 1, 2)}
    return features.add_calendar(daily, month_flags=flags)


def _lag_sql(lags) -> str:
    return ", ".join(f"lag(sales, {k}) OVER w AS lag_{k}" for k in lags)


def _rolling_sql(windows) -> str:
    cells = []
    for n in windows:
        frame = f"OVER (PARTITION BY City ORDER BY period ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
        for name, rule in (("mean", "avg"), ("std", "stddev_samp")):
            cells.append(
                f"CASE WHEN count(sales) {frame} = {n} THEN round({rule}(sales) {frame}, 4) END AS rolling_{name}_{n}"
            )
    return ", ".join(cells)


def _rounded_rolling(df):
    return df.withColumns({c: F.round(c, 4) for c in df.columns if c.startswith("rolling_")})


@register(
    "lag_features",
    f"SELECT *, {_lag_sql((1, 7, 14, 30))} FROM ({CITY_PANEL}) WINDOW w AS (PARTITION BY City ORDER BY period)",
)
def lag_features(spark, sf_dir):
    return features.add_lags(stand_in.city_panel(spark, sf_dir), KEYS)


@register("rolling_features", f"SELECT *, {_rolling_sql((7, 14, 30))} FROM ({CITY_PANEL})")
def rolling_features(spark, sf_dir):
    return _rounded_rolling(features.add_rolling(stand_in.city_panel(spark, sf_dir), KEYS))


_CALENDAR_SQL = """
    (isodow(period) - 1)::int AS dayofweek, day(period)::int AS day, month(period)::int AS month,
    quarter(period)::int AS quarter, year(period)::int AS year, dayofyear(period)::int AS dayofyear,
    (isodow(period) >= 6)::int AS is_weekend, (month(period) IN (3, 9, 10, 11))::int AS is_festive_month,
    (((month(period) + 8) % 12) // 3 + 1)::int AS india_fy_quarter
"""


@register(
    "complete_features",
    f"""
    WITH f AS (
      SELECT *, {_CALENDAR_SQL}, {_lag_sql((1, 2, 3, 6))}, {_rolling_sql((3, 6))}
      FROM ({CITY_PANEL}) WINDOW w AS (PARTITION BY City ORDER BY period))
    SELECT * FROM f WHERE lag_6 IS NOT NULL AND rolling_std_6 IS NOT NULL
    """,
)
def complete_features(spark, sf_dir):
    return _rounded_rolling(features.feature_table(stand_in.city_panel(spark, sf_dir), KEYS))


@register(
    "time_split",
    f"""
    WITH panel AS ({CITY_PANEL})
    SELECT City, period, sales, cnt::int AS n, 'ok' AS status, split FROM ({SPLIT})
    """,
)
def time_split(spark, sf_dir):
    return split.time_split(stand_in.city_panel(spark, sf_dir), KEYS)


@register(
    "time_split_short",
    f"""
    WITH panel AS (
      SELECT o_custkey AS City, make_date(year(o_orderdate), 12, 31) AS period, cast({ORDER_SUM} AS double) AS sales
      FROM orders GROUP BY 1, 2)
    SELECT City AS o_custkey, period, sales, cnt::int AS n, CASE WHEN cnt < 5 THEN 'too_short' ELSE 'ok' END AS status,
           CASE WHEN cnt >= 5 THEN split END AS split
    FROM ({SPLIT})
    """,
)
def time_split_short(spark, sf_dir):
    """Yearly series per customer: many are under the minimum length."""
    panel = periods.to_periods(
        stand_in.order_facts(spark, sf_dir), ["o_custkey"], "Y", sales_col="Revenue", scale=2
    )
    return split.time_split(panel, ["o_custkey"])


@register(
    "split_ranges",
    f"""
    WITH panel AS (SELECT 'all' AS City, period, sales FROM ({TOTAL_PANEL}))
    SELECT split, count(*)::int AS n_periods, min(period) AS first_period, max(period) AS last_period
    FROM ({SPLIT}) GROUP BY 1
    """,
)
def split_ranges(spark, sf_dir):
    return split.split_ranges(split.time_split(stand_in.total_panel(spark, sf_dir)))


_SEQ = ", ".join(f"lag(sales, {7 - i}) OVER w AS x{i}" for i in range(1, 7))


@register(
    "sequence_windows",
    f"""
    WITH s AS (
      SELECT City, period, sales AS y, {_SEQ} FROM ({CITY_PANEL}) WINDOW w AS (PARTITION BY City ORDER BY period)),
    k AS (SELECT * FROM s WHERE x1 IS NOT NULL)
    SELECT *, CASE WHEN row_number() OVER (PARTITION BY City ORDER BY period)
                        <= greatest(1, floor(count(*) OVER (PARTITION BY City) * 0.8::double))
                   THEN 'train' ELSE 'test' END AS seq_split
    FROM k
    """,
)
def sequence_windows(spark, sf_dir):
    rows = split.sequence_windows(stand_in.city_panel(spark, sf_dir), KEYS, 6)
    marked = split.sequence_split(rows, KEYS)
    cells = [F.col("seq")[i].alias(f"x{i + 1}") for i in range(6)]
    return marked.select("City", "period", "y", *cells, "seq_split")


@register(
    "last_sequence",
    f"""
    SELECT City, max(period) AS last_period, {", ".join(f"list(sales ORDER BY period)[-{6 - i}] AS x{i + 1}" for i in range(6))}
    FROM ({CITY_PANEL}) GROUP BY City
    """,
)
def last_sequence(spark, sf_dir):
    rows = split.last_sequence(stand_in.city_panel(spark, sf_dir), KEYS, 6)
    return rows.select("City", "last_period", *[F.col("seq")[i].alias(f"x{i + 1}") for i in range(6)])


@register(
    "minmax_scaled",
    f"""
    SELECT City, period, sales, low, high,
           round((sales - low) / CASE WHEN high = low THEN 1.0 ELSE high - low END, 9) AS scaled
    FROM (SELECT *, min(sales) OVER (PARTITION BY City) AS low, max(sales) OVER (PARTITION BY City) AS high
          FROM ({CITY_PANEL}))
    """,
)
def minmax_scaled(spark, sf_dir):
    rows = scale.scale_series(stand_in.city_panel(spark, sf_dir), KEYS)
    return rows.withColumn("scaled", F.round("scaled", 9))


@register(
    "inverse_scaled",
    f"""
    WITH panel AS ({CITY_PANEL}), s AS ({SPLIT}),
    stats AS (SELECT City, min(sales) AS low, max(sales) AS high FROM s WHERE split = 'train' GROUP BY 1)
    SELECT City, period, sales, round((sales - low) / (high - low), 9) AS scaled, round(sales, 2) AS unscaled
    FROM panel JOIN stats USING (City)
    """,
)
def inverse_scaled(spark, sf_dir):
    """Statistics of the train rows applied to every row, and undone again."""
    panel = stand_in.city_panel(spark, sf_dir)
    train = split.time_split(panel, KEYS).where(F.col("split") == "train")
    stats = scale.fit_scaler(train, KEYS)
    back = scale.invert_scaler(scale.apply_scaler(panel, stats, KEYS), stats, KEYS)
    return back.withColumns({"scaled": F.round("scaled", 9), "unscaled": F.round("unscaled", 2)})


@register(
    "decomposition",
    f"""
    WITH panel AS ({CITY_PANEL}),
    a AS (
      SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY City) AS n,
             CASE WHEN count(*) OVER f = 13
                  THEN (sum(sales) OVER f - 0.5 * (lag(sales, 6) OVER w + lead(sales, 6) OVER w)) / 12 END AS trend
      FROM panel WINDOW w AS (PARTITION BY City ORDER BY period),
                        f AS (PARTITION BY City ORDER BY period ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING)),
    b AS (SELECT City, (rn - 1) % 12 AS pos, avg(sales - trend) AS m FROM a GROUP BY 1, 2),
    c AS (SELECT City, pos, m - avg(m) OVER (PARTITION BY City) AS seasonal FROM b)
    SELECT City, period, sales, 'ok' AS status, round(trend, 5) AS trend, round(seasonal, 5) AS seasonal,
           round(sales - trend - seasonal, 5) AS resid
    FROM a JOIN c USING (City) WHERE pos = (rn - 1) % 12
    """,
)
def decomposition(spark, sf_dir):
    rows = decompose(stand_in.city_panel(spark, sf_dir), KEYS, 12)
    return rows.withColumns({c: F.round(c, 5) for c in ("trend", "seasonal", "resid")})


def _feature_predictions(panel):
    """Features read as predictions of the test rows; enough to exercise the metrics."""
    wide = features.add_rolling(features.add_lags(split.time_split(panel, KEYS), KEYS, (1, 12)), KEYS, (3,))
    test = wide.where(F.col("split") == "test")
    long = F.stack(
        F.lit(3), F.lit("lag_1"), "lag_1", F.lit("lag_12"), "lag_12", F.lit("rolling_mean_3"), "rolling_mean_3"
    ).alias("model", "yhat")
    return test.select("City", F.col("period").alias("ds"), long)


_PREDICTIONS_SQL = f"""
    panel AS ({CITY_PANEL}), s AS ({SPLIT}),
    f AS (
      SELECT *, lag(sales, 1) OVER w AS lag_1, lag(sales, 12) OVER w AS lag_12,
             avg(sales) OVER (PARTITION BY City ORDER BY period ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS mean_3
      FROM s WINDOW w AS (PARTITION BY City ORDER BY period)),
    p AS (
      SELECT City, 'lag_1' AS model, sales AS y, lag_1 AS yhat FROM f WHERE split = 'test' UNION ALL
      SELECT City, 'lag_12', sales, lag_12 FROM f WHERE split = 'test' UNION ALL
      SELECT City, 'rolling_mean_3', sales, mean_3 FROM f WHERE split = 'test'),
    m AS (
      SELECT City, model, round_even(avg(abs(y - yhat)), 2) AS mae, round_even(sqrt(avg((y - yhat) * (y - yhat))), 2) AS rmse,
             round_even(avg(CASE WHEN y <> 0 THEN abs((y - yhat) / y) END) * 100, 2) AS mape
      FROM p GROUP BY 1, 2)
"""


@register("prediction_metrics", f"WITH {_PREDICTIONS_SQL} SELECT * FROM m")
def prediction_metrics(spark, sf_dir):
    panel = stand_in.city_panel(spark, sf_dir)
    return metrics.score(metrics.align(_feature_predictions(panel), panel, KEYS), KEYS)


@register(
    "leaderboard",
    f"""
    WITH {_PREDICTIONS_SQL}
    SELECT *, row_number() OVER (PARTITION BY City ORDER BY mape, model) = 1 AS is_best,
           format('{{:.2f}}', mae / 1e7) || 'Cr' AS mae_text, format('{{:.2f}}', rmse / 1e7) || 'Cr' AS rmse_text
    FROM m
    """,
)
def leaderboard(spark, sf_dir):
    panel = stand_in.city_panel(spark, sf_dir)
    scores = metrics.score(metrics.align(_feature_predictions(panel), panel, KEYS), KEYS)
    return metrics.leaderboard(scores, KEYS, ("lag_1", "lag_12", "rolling_mean_3"))


@register(
    "horizon_calendar",
    f"""
    SELECT City, step::int AS step, last_day(last_period + to_months(step::int)) AS ds
    FROM (SELECT n_name AS City, last_day(max(cast(o_orderdate AS date))) AS last_period FROM {CITY_JOIN} GROUP BY 1),
         (SELECT unnest(range(1, 7)) AS step)
    """,
)
def horizon_calendar(spark, sf_dir):
    return periods.horizon_calendar(stand_in.city_panel(spark, sf_dir, "M"), KEYS, 6, "M")


@register(
    "relative_band",
    f"SELECT City, period, sales, sales * 0.92::double AS yhat_lower, sales * 1.08::double AS yhat_upper FROM ({CITY_PANEL})",
)
def relative_band(spark, sf_dir):
    return metrics.relative_band(stand_in.city_panel(spark, sf_dir), "sales", 0.08)




# --- branches that the plain tables do not enter -------------------------------------------

_SIGNED = "CASE WHEN o_orderstatus = 'F' THEN -o_totalprice ELSE o_totalprice END"


@register(
    "period_returns",
    f"""
    SELECT o_custkey, cast(date_trunc('quarter', o_orderdate) AS date) AS period,
           cast(sum(cast({_SIGNED} AS decimal(18,2))) AS double) AS sales
    FROM orders GROUP BY 1, 2 HAVING sum(cast({_SIGNED} AS decimal(18,2))) > 0
    """,
)
def period_returns(spark, sf_dir):
    """Orders of one status count as returns, so that some periods sum to zero or less and go."""
    orders = stand_in.table(spark, sf_dir, "orders").select(
        "o_custkey", F.col("o_orderdate").alias("date"), F.expr(_SIGNED).alias("Revenue")
    )
    return periods.to_periods(orders, ["o_custkey"], "QS", sales_col="Revenue", scale=2)


@register(
    "metrics_zero_actuals",
    f"""
    WITH w AS (
      SELECT o_custkey, cast(date_trunc('month', o_orderdate) AS date) AS period,
             cast({ORDER_SUM} AS double) AS sales FROM orders GROUP BY 1, 2),
    cal AS (
      SELECT o_custkey, unnest(generate_series(min(period), max(period), INTERVAL 1 MONTH))::date AS period
      FROM w GROUP BY 1),
    f AS (SELECT o_custkey, period, coalesce(sales, 0.0::double) AS y FROM cal LEFT JOIN w USING (o_custkey, period)),
    p AS (SELECT *, lag(y, 1) OVER (PARTITION BY o_custkey ORDER BY period) AS yhat FROM f)
    SELECT o_custkey, 'lag_1' AS model, round_even(avg(abs(y - yhat)), 6) AS mae,
           round_even(sqrt(avg((y - yhat) * (y - yhat))), 6) AS rmse,
           round_even(avg(CASE WHEN y <> 0 THEN abs((y - yhat) / y) END) * 100, 6) AS mape
    FROM p WHERE yhat IS NOT NULL GROUP BY 1
    """,
)
def metrics_zero_actuals(spark, sf_dir):
    """Months without sales are zero actuals, which the percentage error leaves out."""
    panel = periods.to_periods(
        stand_in.order_facts(spark, sf_dir), ["o_custkey"], "MS", sales_col="Revenue", scale=2, fill_gaps=True
    )
    lagged = features.add_lags(panel, ["o_custkey"], (1,))
    rows = lagged.where("lag_1 is not null").select(
        "o_custkey", F.lit("lag_1").alias("model"), F.col("sales").alias("y"), F.col("lag_1").alias("yhat")
    )
    return metrics.score(rows, ["o_custkey"], digits=6)


@register(
    "kpi_hourly",
    """
    WITH p AS (
      SELECT event_type AS Category, date_trunc('hour', ts) AS period, cast(sum(cast(value AS decimal(18,2))) AS double) AS sales
      FROM events GROUP BY 1, 2 HAVING sum(cast(value AS decimal(18,2))) > 0)
    SELECT Category, count(*) AS n_periods, round(sum(sales), 2) AS total_sales, round(avg(sales), 6) AS mean_sales,
           max(sales) AS peak_sales, cast(arg_min(period, (-sales, epoch(period))) AS timestamp) AS peak_period
    FROM p GROUP BY 1
    """,
)
def kpi_hourly(spark, sf_dir):
    panel = periods.to_periods(stand_in.event_facts(spark, sf_dir), ["Category"], "h", sales_col="Revenue", scale=2)
    kpi = summaries.kpi_row(panel, ["Category"])
    return kpi.withColumns({"total_sales": F.round("total_sales", 2), "mean_sales": F.round("mean_sales", 6)})


@register("stored_panel", f"SELECT City, period, sales FROM ({CITY_PANEL})")
def stored_panel(spark, sf_dir):
    """The panel through the table sink, one folder per city."""
    path = scratch_path(spark, "stored-panel")
    sinks.write_table(stand_in.city_panel(spark, sf_dir), path, ["City"])
    return spark.read.parquet(path).select("City", "period", "sales")
