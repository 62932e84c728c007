"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from panelcast.catalog import ENTRIES, facts
from panelcast.operators import enrich, features, periods, split

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count(plan, node):
    return len(re.findall(rf"\b{node}\b", plan))


@pytest.mark.parametrize("name", sorted(set(ENTRIES) - {"csv_load_periods"}))
def test_no_cross_join_or_row_python(name, spark, sf_dir):
    plan = plan_of(ENTRIES[name].run(spark, sf_dir))
    assert not [node for node in FORBIDDEN if node in plan]


def test_filter_and_columns_reach_the_scan(spark, sf_dir):
    plan = plan_of(ENTRIES["period_store"].run(spark, sf_dir))
    assert "PushedFilters: [IsNotNull(l_suppkey), IsNotNull(l_shipdate), EqualTo(l_suppkey,42)]" in plan or (
        "EqualTo(l_suppkey,42)" in plan
    )
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"l_suppkey", "l_extendedprice", "l_discount", "l_shipdate"}


def test_features_share_one_exchange(spark, sf_dir):
    panel = facts.city_panel(spark, sf_dir)
    wide = features.feature_table(split.time_split(panel, ["City"]), ["City"], complete=False)
    plan = plan_of(wide)
    # One for the sums by customer, one for the panel, one for every window of the features and the split.
    assert count(plan, "Exchange hashpartitioning") == 3


def test_decomposition_shares_one_exchange(spark, sf_dir):
    assert count(plan_of(ENTRIES["decomposition"].run(spark, sf_dir)), "Exchange hashpartitioning") == 3


def test_model_fit_adds_one_exchange(spark, sf_dir):
    for name in ("hw_panel_forecast", "arima_panel_forecast"):
        plan = plan_of(ENTRIES[name].run(spark, sf_dir))
        # The panel is a stored table; packing its series is the only exchange left.
        assert count(plan, "Exchange") == 1 and "struct<City:string,period:date,sales:double>" in plan
        # The stand-in of a failed ARIMA solve is searched after the solve.
        assert count(plan, "ArrowEvalPython") == (2 if name == "arima_panel_forecast" else 1)


def test_curve_and_stand_in_are_one_projection(spark, sf_dir):
    """Curve and smoother are worked out row by row, so no series is packed or fitted twice."""
    plan = plan_of(ENTRIES["additive_forecast"].run(spark, sf_dir))
    assert count(plan, "Exchange") == 1 and count(plan, "ArrowEvalPython") == 2 and "Union" not in plan


def test_aggregation_is_partial_first(spark, sf_dir):
    plan = plan_of(periods.to_periods(facts.order_facts(spark, sf_dir), freq="W", sales_col="Revenue"))
    assert "partial_sum" in plan and count(plan, "Exchange") == 1


JOINING = ["load_summary", "city_list", "city_first_seen", "sales_by_city", "category_share", "period_by_city", "period_city", "kpi_row"]


def outcome(spark, sf_dir):
    """Schemas and rows of the joined tables and of the queries over them."""
    found = {n: ENTRIES[n].run(spark, sf_dir) for n in JOINING if n in ENTRIES}
    found |= {
        "facts": facts.city_facts(spark, sf_dir),
        "sums": facts.city_sums(spark, sf_dir, "YS"),
        "categories": facts.category_sums(spark, sf_dir),
    }
    return {k: (df.schema, sorted(map(str, df.collect()))) for k, df in found.items()}


def test_table_size_does_not_change_results(spark, sf_dir):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    small = outcome(spark, sf_dir)
    try:
        spark.conf.set(key, "-1")
        plan = plan_of(facts.city_panel(spark, sf_dir))
        assert count(plan, "SortMergeJoin") == 2 and "BroadcastHashJoin" not in plan
        assert outcome(spark, sf_dir) == small
    finally:
        spark.conf.set(key, before)
    pairs = facts.order_facts(spark, sf_dir).select("o_custkey", F.year("date")).distinct().count()
    assert facts.city_sums(spark, sf_dir, "YS").count() == pairs
    assert len(small["facts"][1]) == facts.order_facts(spark, sf_dir).count()


def test_unmatched_facts_are_kept(spark):
    rows = spark.createDataFrame([(1, 2.0), (9, 3.0)], "k int, Revenue double")
    dim = spark.createDataFrame([(1, "x")], "pk int, City string")
    assert sorted(map(str, (r["City"] for r in enrich.attach(rows, dim, "k", "pk").collect()))) == ["None", "x"]
