"""The forecast store: updates of changed series only, and reads by model and city."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.catalog import facts as stand_in
from panelcast.catalog.model_queries import HORIZON, KEYS
from panelcast.catalog.registry import ENTRIES, register
from panelcast.plans.store import ForecastStore
from panelcast.session import materialize, scratch_path

# Between the two updates of the store the cities of this rule get their last quarters.
_LATE = "NATION_1%"


def _updated(spark, sf_dir, models):
    """A store filled from a panel without the last months of some cities, then from the whole panel."""
    panel = materialize(stand_in.city_panel(spark, sf_dir), "panel")
    late = F.col("City").like(_LATE) & (F.col("period") >= "2001-01-01")
    store = ForecastStore(spark, scratch_path(spark, "store"), KEYS, "MS", models, HORIZON, buckets=8)
    store.update(panel.where(~late))
    return store, store.update(panel)


def _rounded(rows, digits):
    return rows.withColumns({c: F.round(c, digits) for c in ("yhat", "yhat_lower", "yhat_upper")})


@register("forecast_store", ENTRIES["hw_panel_forecast"].sql)
def forecast_store(spark, sf_dir):
    """After the second update every city has the forecast of its whole history."""
    return _rounded(_updated(spark, sf_dir, ["holt_winters"])[0].read(), 2)


@register(
    "forecast_store_changes",
    f"""
    SELECT model, n_name AS City, 'changed' AS change
    FROM (SELECT DISTINCT n_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
          WHERE n_name LIKE '{_LATE}' AND o_orderdate >= '2001-01-01'), (VALUES ('arima'), ('holt_winters')) m(model)""",
)
def forecast_store_changes(spark, sf_dir):
    """What the second update fitted: the cities whose history had grown."""
    return _updated(spark, sf_dir, ["arima", "holt_winters"])[1].select("model", "City", "change")


@register("forecast_store_city", f"SELECT * FROM ({ENTRIES['arima_panel_forecast'].sql}) WHERE City = 'NATION_7'")
def forecast_store_city(spark, sf_dir):
    """One city and one model of a store of several."""
    store, _ = _updated(spark, sf_dir, ["arima", "holt_winters"])
    return _rounded(store.read(["arima"], City="NATION_7"), 0)
