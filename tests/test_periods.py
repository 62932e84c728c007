import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelcast.functions import calendar
from panelcast.operators import enrich, periods, summaries
from tests.helpers import panel

D = dt.date


@pytest.fixture(scope="module")
def facts(spark):
    rows = [
        (dt.datetime(2024, 1, 1), 1.0),
        (dt.datetime(2024, 1, 7), 2.0),
        (dt.datetime(2024, 1, 8), 4.0),
        (dt.datetime(2024, 1, 31, 23), 8.0),
        (dt.datetime(2024, 3, 1), 16.0),
        (dt.datetime(2024, 4, 30), -5.0),
    ]
    return spark.createDataFrame(rows, "date timestamp_ntz, Revenue double")


@pytest.mark.parametrize(
    ("freq", "expected"),
    [
        ("MS", [(D(2024, 1, 1), 15), (D(2024, 3, 1), 16)]),
        ("M", [(D(2024, 1, 31), 15), (D(2024, 3, 31), 16)]),
        ("QS", [(D(2024, 1, 1), 31)]),
        ("Q", [(D(2024, 3, 31), 31)]),
        ("YS", [(D(2024, 1, 1), 26)]),
        ("Y", [(D(2024, 12, 31), 26)]),
        ("W", [(D(2024, 1, 7), 3), (D(2024, 1, 14), 4), (D(2024, 2, 4), 8), (D(2024, 3, 3), 16)]),
        ("D", [(D(2024, 1, 1), 1), (D(2024, 1, 7), 2), (D(2024, 1, 8), 4), (D(2024, 1, 31), 8), (D(2024, 3, 1), 16)]),
    ],
)
def test_period_labels(facts, freq, expected):
    got = periods.to_periods(facts, freq=freq, scale=2).orderBy("period").collect()
    assert [(r["period"], r["sales"]) for r in got] == expected


def test_durations(facts):
    got = periods.to_periods(facts, freq="6h").orderBy("period").collect()
    assert got[3]["period"] == dt.datetime(2024, 1, 31, 18) and got[3]["sales"] == 8
    for bad in ("0D", "W-ANY", "fortnight", "0min", "0h", "MS-APR", "B-MON", "QS-ANY", "5x"):
        with pytest.raises(ValueError, match="unsupported frequency"):
            calendar.resolve_freq(bad)


def test_labels_and_seasons():
    assert {f: calendar.resolve_freq(f).label for f in ("M", "QS", "Y", "D", "W")} == {
        "M": "Monthly", "QS": "Quarterly", "Y": "Yearly", "D": "Daily", "W": "Weekly"}
    assert [calendar.resolve_freq(f).season_length for f in ("MS", "Q", "Y", "W", "D", "15min")] == [12, 4, 1, 52, 7, 96]


@pytest.mark.parametrize(
    ("freq", "last", "expected"),
    [
        ("MS", D(2024, 1, 1), [D(2024, 2, 1), D(2024, 3, 1)]),
        ("M", D(2024, 1, 31), [D(2024, 2, 29), D(2024, 3, 31)]),
        ("QS", D(2024, 10, 1), [D(2025, 1, 1), D(2025, 4, 1)]),
        ("Q", D(2024, 3, 31), [D(2024, 6, 30), D(2024, 9, 30)]),
        ("Y", D(2024, 12, 31), [D(2025, 12, 31), D(2026, 12, 31)]),
        ("W", D(2024, 1, 7), [D(2024, 1, 14), D(2024, 1, 21)]),
        ("D", D(2024, 2, 28), [D(2024, 2, 29), D(2024, 3, 1)]),
        ("15min", dt.datetime(2024, 1, 1, 23, 45), [dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2, 0, 15)]),
    ],
)
def test_horizon(spark, freq, last, expected):
    kind = "timestamp_ntz" if isinstance(last, dt.datetime) else "date"
    df = spark.createDataFrame([(last, 1.0)], f"period {kind}, sales double")
    rows = periods.horizon_calendar(df, [], 2, freq).orderBy("step").collect()
    assert [r["ds"] for r in rows] == expected
    back = spark.createDataFrame([(last, expected[-1])], f"a {kind}, b {kind}")
    assert back.select(calendar.periods_between(F.col("a"), F.col("b"), freq).alias("n")).first()["n"] == 2


def test_gap_fill(spark):
    rows = [("a", D(2024, 1, 31), 1.0), ("a", D(2024, 4, 30), 2.0), ("b", D(2024, 2, 29), 3.0)]
    df = spark.createDataFrame(rows, "City string, period date, sales double")
    got = periods.fill_period_gaps(df, ["City"], "M").orderBy("City", "period").collect()
    assert [(r["City"], r["period"], r["sales"]) for r in got] == [
        ("a", D(2024, 1, 31), 1.0), ("a", D(2024, 2, 29), 0.0), ("a", D(2024, 3, 31), 0.0),
        ("a", D(2024, 4, 30), 2.0), ("b", D(2024, 2, 29), 3.0)]


def test_filters(facts):
    tagged = facts.withColumn("City", F.when(F.col("Revenue") > 3, "x").otherwise("y"))
    assert periods.to_periods(tagged, where={"City": "x", "Store_ID": None}).count() == 2
    assert periods.to_periods(tagged, where={"City": ""}).count() == 2
    with pytest.raises(ValueError, match="not found"):
        periods.to_periods(facts, where={"City": "x"})


def test_values_that_are_not_numbers(spark):
    rows = [(D(2024, 1, 1), float("nan")), (D(2024, 1, 2), 3.0), (D(2024, 2, 1), None), (None, 9.0)]
    df = spark.createDataFrame(rows, "date date, Sales double")
    for scale in (None, 2):
        got = periods.to_periods(df, scale=scale).collect()
        assert [(r["period"], r["sales"]) for r in got] == [(D(2024, 1, 1), 3.0)]


def test_null_keys_are_left_out(spark):
    rows = [("x", D(2024, 1, 1), 1.0), (None, D(2024, 1, 1), 2.0)]
    df = spark.createDataFrame(rows, "City string, date date, Revenue double")
    assert [r["City"] for r in periods.to_periods(df, ["City"]).collect()] == ["x"]
    assert periods.to_periods(df).first()["sales"] == 3.0


def test_hot_key_is_summed_before_the_join(spark):
    facts = spark.createDataFrame(
        [(1 if i % 3 == 0 else i, dt.datetime(2024, 1 + i % 12, 1 + i % 28), float(i)) for i in range(600)],
        "k int, date timestamp_ntz, Revenue double",
    )
    dim = spark.range(600).selectExpr("cast(id AS int) AS pk", "concat('c', id % 4) AS City")

    def run():
        small = enrich.summed(facts, ["k"], "Revenue", 2, "MS")
        joined = enrich.attach(small, dim, "k", "pk")
        return joined, periods.to_periods(joined, ["City"], "MS", sales_col="Revenue", scale=2)

    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "-1")
        joined, summed = run()
        large = sorted(map(tuple, summed.collect()))
        assert joined.count() < facts.count()
        assert "SortMergeJoin" in summed._jdf.queryExecution().executedPlan().toString()
        spark.conf.set(key, "10MB")
        again, summed = run()
        assert again.schema == joined.schema and again.count() == joined.count()
        assert sorted(map(tuple, summed.collect())) == large
    finally:
        spark.conf.set(key, before)


def test_summaries(spark):
    rows = [("x", "A", D(2024, 1, 5), 10.0), ("y", "A", D(2024, 1, 6), 30.0), (None, "B", D(2025, 3, 1), 60.0)]
    df = spark.createDataFrame(rows, "City string, Category string, date date, Revenue double")
    assert [tuple(r) for r in summaries.ranked_totals(df, "City").collect()] == [("y", 30.0), ("x", 10.0)]
    shares = {r["Category"]: r["share"] for r in summaries.category_share(df).collect()}
    assert shares == {"A": 40.0, "B": 60.0}
    assert summaries.category_share(df.drop("Category")) is None
    table = {r["year"]: r for r in summaries.year_month_pivot(df).collect()}
    assert table[2024]["Jan"] == 40.0 and table[2024]["Feb"] is None and table[2025]["Mar"] == 60.0
    assert [r["City"] for r in summaries.distinct_sorted(df).collect()] == ["x", "y"]
    assert [r["City"] for r in summaries.distinct_first_seen(df).collect()] == ["x", "y", None]
    assert summaries.count_distinct_values(df, "City").first()[0] == 2
    assert summaries.count_distinct_values(df, "City", approximate=True).first()[0] == 2
    with pytest.raises(ValueError, match="not found"):
        summaries.distinct_sorted(df, "Town")


def test_kpi_peak_is_the_first_of_equals(spark):
    kpi = summaries.kpi_row(panel(spark, {"a": [1, 9, 9, 2]}), ["City"]).first()
    assert (kpi["n_periods"], kpi["total_sales"], kpi["mean_sales"], kpi["peak_sales"]) == (4, 21.0, 5.25, 9.0)
    assert kpi["peak_period"] == D(2020, 2, 1)


@pytest.mark.parametrize("freq", ["2MS", "3M", "2W", "W-MON", "2W-WED", "2QS", "2D"])
def test_multiples_and_anchors_against_pandas(spark, freq):
    import pandas as pd

    days = [dt.date(2024, 1, 10) + dt.timedelta(days=int(k)) for k in (0, 3, 4, 5, 11, 12, 19, 40, 75, 110, 111, 260, 401)]
    df = spark.createDataFrame([(d, float(i + 1)) for i, d in enumerate(days)], "date date, Revenue double")
    got = {r["period"]: r["sales"] for r in periods.to_periods(df, freq=freq, sales_col="Revenue").collect()}
    code = {"3M": "3ME"}.get(freq, freq)
    want = pd.Series(range(1, len(days) + 1), index=pd.to_datetime(days)).resample(code).sum()
    assert got == {k.date(): float(v) for k, v in want.items() if v > 0}
    f = calendar.resolve_freq(freq)
    steps = spark.createDataFrame([(min(got),)], "p date").select(calendar.shift_label(F.col("p"), f, F.lit(1)).alias("q")).first()["q"]
    assert steps == want.index[1].date()


def test_peak_tie_is_the_earliest_hour(spark):
    hours = [dt.datetime(2024, 1, 1, h) for h in (2, 5, 7)]
    panel = spark.createDataFrame([(h, s) for h, s in zip(hours, (9.0, 9.0, 1.0), strict=True)], "period timestamp_ntz, sales double")
    assert summaries.kpi_row(panel).first()["peak_period"] == hours[0]


def test_large_amounts_are_summed_or_fail(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), 2e16), (D(2024, 1, 2), 5.0)], "date date, Revenue double")
    assert periods.to_periods(df, sales_col="Revenue", scale=2).first()["sales"] == 2e16 + 5
    bad = spark.createDataFrame([(D(2024, 1, 1), float("inf"))], "date date, Revenue double")
    with pytest.raises(Exception, match="out of range"):
        periods.to_periods(bad, sales_col="Revenue", scale=2).collect()
