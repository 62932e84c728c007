"""Fiscal, business-day, half-month and free-duration panels, and forecasts that carry their labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.catalog import facts as stand_in
from panelcast.catalog.registry import register
from panelcast.catalog.sql_text import CITY_JOIN, ORDER_SUM
from panelcast.functions.calendar import resolve_freq
from panelcast.models import smoothing
from panelcast.models.series import explode_forecast, explode_test, hold_out, series_arrays, with_horizon
from panelcast.operators import periods

FIXED = {"alpha": 0.3, "beta": 0.1, "gamma": 0.2}
EVENT_SUM = "sum(cast(value AS decimal(18,2)))"

# The label of each frequency for a date or timestamp column named {d}.
_MONTH = "cast(date_trunc('month', {d}) AS date)"
_LAST = "last_day(cast({d} AS date))"
_LAST_BUSINESS = f"({_LAST} - greatest(isodow({_LAST}) - 5, 0)::int)"
LABELS = {
    "QS-APR": f"cast({_MONTH} - to_months(((month({{d}}) + 8) % 3)::int) AS date)",
    "YE-MAR": "make_date(year({d}) + (month({d}) > 3)::int, 3, 31)",
    "B": "(cast({d} AS date) - greatest(isodow({d}) - 5, 0)::int)",
    "SMS": f"({_MONTH} + CASE WHEN day({{d}}) >= 15 THEN 14 ELSE 0 END)",
    # After the last business day of a month its days belong to the next month.
    "BME": f"""CASE WHEN cast({{d}} AS date) <= {_LAST_BUSINESS} THEN {_LAST_BUSINESS}
        ELSE {_LAST_BUSINESS.replace("{d}", f"({_MONTH} + to_months(1))")} END""",
}


def _register_period(name: str, freq: str) -> None:
    label = LABELS[freq].format(d="o_orderdate")

    @register(
        name,
        f"SELECT cast({label} AS date) AS period, cast({ORDER_SUM} AS double) AS sales FROM orders GROUP BY 1 HAVING {ORDER_SUM} > 0",
    )
    def run(spark, sf_dir):
        return stand_in.total_panel(spark, sf_dir, freq)


_register_period("period_fiscal_q", "QS-APR")
_register_period("period_fiscal_y", "YE-MAR")
_register_period("period_business_day", "B")
_register_period("period_half_month", "SMS")
_register_period("period_business_month", "BME")


def _duration_sql(hours: int) -> str:
    """Buckets from the midnight of each category's first day."""
    return f"""
      SELECT Category, origin + to_hours((date_diff('second', origin, ts) // {hours * 3600} * {hours})::int) AS period, cast({EVENT_SUM} AS double) AS sales
      FROM (SELECT event_type AS Category, ts, value, date_trunc('day', min(ts) OVER (PARTITION BY event_type))::timestamp AS origin FROM events)
      GROUP BY 1, 2 HAVING {EVENT_SUM} > 0"""


def _event_panel(spark, sf_dir, freq: str) -> DataFrame:
    return periods.to_periods(stand_in.event_facts(spark, sf_dir), ["Category"], freq, sales_col="Revenue", scale=2)


def _register_duration(hours: int) -> None:
    @register(f"period_{hours}h", _duration_sql(hours))
    def run(spark, sf_dir):
        return _event_panel(spark, sf_dir, f"{hours}h")


_register_duration(5)
_register_duration(36)


# --- forecasts ---------------------------------------------------------------------------

_FISCAL = f"""
  SELECT n_name AS City, cast({LABELS["QS-APR"].format(d="o_orderdate")} AS date) AS period, cast({ORDER_SUM} AS double) AS sales
  FROM {CITY_JOIN} GROUP BY 1, 2 HAVING {ORDER_SUM} > 0"""
_BUSINESS = f"""
  SELECT event_type AS Category, cast({LABELS["B"].format(d="ts")} AS date) AS period, cast({EVENT_SUM} AS double) AS sales
  FROM events GROUP BY 1, 2 HAVING {EVENT_SUM} > 0"""


def _day_number(day: str) -> str:
    """Number of a business day; five of a week, counted from a Monday."""
    days = f"(datediff('day', DATE '1969-12-29', {day}))"
    return f"({days} // 7 * 5 + {days} % 7)"


def _business_day(number: str) -> str:
    return f"(DATE '1969-12-29' + ({number} // 5 * 7 + {number} % 5)::int)"


def _trend_sql(key: str, panel: str, first: str = "true") -> str:
    """CTEs that end in ``run``: the trend recursion over the rows of ``panel`` that ``first`` admits."""
    level = "0.3::double * y + (1 - 0.3::double) * (l + b)"
    return f"""
    WITH RECURSIVE panel AS ({panel}),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY period) AS rn, count(*) OVER (PARTITION BY {key}) AS cnt FROM panel),
    series AS (
      SELECT {key}, list(sales ORDER BY period) AS ys, count(*) AS n, max(period) AS last_period FROM ranked WHERE {first} GROUP BY 1),
    run AS (
      SELECT {key}, 2 AS i, ys[2] AS l, ys[2] - ys[1] AS b FROM series
      UNION ALL
      SELECT {key}, i + 1 AS i, {level} AS l, 0.1::double * (({level}) - l) + (1 - 0.1::double) * b AS b
      FROM (SELECT r.*, p.ys[r.i + 1] AS y FROM run r JOIN series p USING ({key}) WHERE r.i < p.n))"""


def _ahead_sql(key: str, panel: str, label: str) -> str:
    return f"""{_trend_sql(key, panel)}
    SELECT {key}, 'holt' AS model, h::int AS step, {label} AS ds, round(l + h * b, 2) AS yhat
    FROM run JOIN series USING ({key}), (SELECT unnest(range(1, 7)) AS h) WHERE i = n"""


def _trend(series: DataFrame) -> DataFrame:
    return smoothing.forecast_array(smoothing.fixed(series, smoothing.TREND, 1, **FIXED))


def _ahead(panel: DataFrame, key: str, freq: str) -> DataFrame:
    rows = explode_forecast(_trend(with_horizon(series_arrays(panel, [key]), 6)), [key], freq, ["model"])
    return rows.withColumn("yhat", F.round("yhat", 2))


@register("fiscal_quarter_forecast", _ahead_sql("City", _FISCAL, "cast(last_period + to_months((3 * h)::int) AS date)"))
def fiscal_quarter_forecast(spark, sf_dir):
    return _ahead(stand_in.city_panel(spark, sf_dir, "QS-APR"), "City", "QS-APR")


@register("business_day_forecast", _ahead_sql("Category", _BUSINESS, _business_day(f"({_day_number('last_period')} + h)")))
def business_day_forecast(spark, sf_dir):
    return _ahead(_event_panel(spark, sf_dir, "B"), "Category", "B")


@register("five_hour_forecast", _ahead_sql("Category", _duration_sql(5), "last_period + to_hours((5 * h)::int)"))
def five_hour_forecast(spark, sf_dir):
    return _ahead(_event_panel(spark, sf_dir, "5h"), "Category", "5h")


@register(
    "business_day_holdout",
    f"""{_trend_sql("Category", _BUSINESS, "rn <= floor(cnt * (1 - 0.2::double))")}
    SELECT Category, 'holt' AS model, t.period AS ds, t.sales AS y,
           round(l + ({_day_number("t.period")} - {_day_number("last_period")}) * b, 2) AS yhat
    FROM ranked t JOIN series USING (Category) JOIN run USING (Category) WHERE i = n AND rn > floor(cnt * (1 - 0.2::double))""",
)
def business_day_holdout(spark, sf_dir):
    """Test days are paired by business days, so a weekend is no step."""
    series = hold_out(series_arrays(_event_panel(spark, sf_dir, "B"), ["Category"]), "B")
    return explode_test(_trend(series), ["Category"], "B", F.col("model")).withColumn("yhat", F.round("yhat", 2))


# --- names -------------------------------------------------------------------------------

_NAMES = {
    "MS": ("Monthly", 12), "QS-APR": ("Quarterly", 4), "YE-MAR": ("Yearly", 1), "W": ("Weekly", 52), "D": ("Daily", 7),
    "B": ("B", 5), "SMS": ("SMS", 24), "BME": ("BME", 12),
}
_COUNTED = {"MS": _MONTH, "W": "cast(date_trunc('week', {d}) AS date) + 6", "D": "cast({d} AS date)"} | LABELS


@register(
    "frequency_names",
    " UNION ALL ".join(
        f"SELECT '{f}' AS freq, '{name}' AS label, {season} AS season_length, count(DISTINCT {_COUNTED[f].format(d='o_orderdate')}) AS n_periods FROM orders"
        for f, (name, season) in _NAMES.items()
    ),
)
def frequency_names(spark, sf_dir):
    """Display name, season and number of periods of the orders at each frequency."""
    days = stand_in.order_facts(spark, sf_dir).groupBy(F.col("date").cast("date").alias("date")).agg(F.sum("Revenue").alias("Revenue"))

    def counted(freq: str) -> DataFrame:
        f = resolve_freq(freq)
        n = periods.to_periods(days, (), freq, sales_col="Revenue").agg(F.count(F.lit(1)).alias("n_periods"))
        return n.select(F.lit(freq).alias("freq"), F.lit(f.label).alias("label"), F.lit(f.season_length).alias("season_length"), "n_periods")

    return reduce(DataFrame.unionByName, [counted(f) for f in _NAMES])
