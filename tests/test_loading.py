"""Loads that report what they drop, mergeable distinct counts, and tasks by work."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelcast.models.series import series_arrays, work_partitions
from panelcast.operators import sketches
from panelcast.operators.periods import to_periods
from panelcast.sources import readers


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "a.csv").write_text(
        "Month,Year,City,Revenue\nJan,2022,x,1\n,2022,x,2\njune,2022,x,3\n13,2022,x,4\nFeb,,x,5\nMar,20x2,x,6\nApr,2022,x,n/a\n"
    )
    (tmp_path / "b.csv").write_text("Month,Year,City,Revenue\nMay,2022,y,8,extra\nxx,2022,y,9,extra\nJun,2022\nJul,0,y,3\n8,2022,y,\n")
    return str(tmp_path)


EXPECTED = {
    "n_rows": 12, "n_kept": 5, "rejected_malformed": 1, "rejected_missing": 2, "rejected_unreadable": 2, "rejected_out_of_range": 2,
    "kept_malformed": 2, "unreadable_amounts": 1,
}


def test_counts_come_with_the_first_action(spark, folder):
    facts, report = readers.observed_sales(spark, folder)
    panel = to_periods(facts, ["City"], "MS", scale=2)
    plan = panel._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1
    tracker, before = spark.sparkContext.statusTracker(), None
    totals = {(r["City"], r["period"].month): r["sales"] for r in panel.collect()}
    before = len(tracker.getJobIdsForGroup(None))
    assert report.counts() == EXPECTED
    assert len(tracker.getJobIdsForGroup(None)) == before  # the counts were there already
    assert totals == {("x", 1): 1.0, ("y", 5): 8.0}
    plain = readers.load_sales(spark, folder)
    assert sorted(map(tuple, facts.select("date", "City", "Revenue").collect()), key=repr) == sorted(
        map(tuple, plain.select("date", "City", "Revenue").collect()), key=repr
    )


def test_reasons_of_rows(spark, folder):
    rows = readers.labelled_sales(spark, folder).groupBy("reject_reason").count().collect()
    assert {r["reject_reason"]: r["count"] for r in rows} == {None: 5, "malformed": 1, "missing": 2, "unreadable": 2, "out_of_range": 2}
    dropped = readers.labelled_sales(spark, folder).where("reject_reason IS NOT NULL")
    assert dropped.count() == readers.rejected_rows(spark, folder).count()
    assert "_malformed" not in dropped.columns


def test_reasons_of_other_shapes(spark, tmp_path):
    def reasons(name, text, **options):
        (tmp_path / name).mkdir()
        (tmp_path / name / "f.csv").write_text(text)
        rows = readers.labelled_sales(spark, str(tmp_path / name), **options).collect()
        return [r["reject_reason"] for r in rows]

    assert reasons("quarter", "Quarter,Year,Sales\nQ1,2022,1\nQ5,2022,2\n,2022,3\nQ2,0,4\n") == [None, "unreadable", "missing", "out_of_range"]
    assert reasons("free", "order_date,Sales\n2024-01-02,1\nlater,2\n,3\n2024-02-31,4\n") == [None, "unreadable", "missing", "unreadable"]
    assert reasons("named", "sold_on,Sales\n2024-01-02,1\nx,2\n", date_col="sold_on") == [None, "unreadable"]
    spark.createDataFrame([(3, 2024), (14, 2024), (None, 2024)], "Month int, Year int").write.parquet(str(tmp_path / "p"))
    found = readers.labelled_sales(spark, str(tmp_path / "p"), source="parquet").collect()
    assert sorted(str(r["reject_reason"]) for r in found) == ["None", "missing", "out_of_range"]


def test_sketches_merge(spark):
    rows = [("x" if i % 2 else "y", dt.date(2024, 1 + i % 12, 1 + i % 28), i % 5000) for i in range(60_000)]
    facts = spark.createDataFrame(rows, "City string, date date, item int")
    table = sketches.distinct_sketches(facts, "item", ["City"])
    assert table.count() == 12
    spring = (dt.date(2024, 3, 1), dt.date(2024, 5, 1))
    exact = {r["City"]: r["n"] for r in facts.where("month(date) BETWEEN 3 AND 5").groupBy("City").agg(F.count_distinct("item").alias("n")).collect()}
    for keys, expected in ((["City"], exact), ([], {None: facts.where("month(date) BETWEEN 3 AND 5").select("item").distinct().count()})):
        for r in sketches.count_between(table, keys, spring).collect():
            want = expected[r["City"] if keys else None]
            assert abs(r["n_distinct"] - want) <= 0.03 * want
    again = sketches.merged(table.unionByName(table), ["City"])  # a value seen twice is one value
    assert all(abs(r["e"] - 2500) <= 75 for r in again.select(sketches.estimate().alias("e")).collect())


def test_sketch_edges(spark):
    facts = spark.createDataFrame([("x", dt.date(2024, 1, 1), None), ("x", None, "a"), ("y", dt.date(2024, 1, 9), "b")], "City string, date date, v string")
    table = sketches.distinct_sketches(facts, "v", ["City"])
    assert {r["City"]: r["n_distinct"] for r in sketches.count_between(table, ["City"]).collect()} == {"x": 0, "y": 1}
    nothing = sketches.count_between(table, [], (dt.date(1990, 1, 1), dt.date(1990, 2, 1))).collect()
    assert [r["n_distinct"] for r in nothing] == [0]
    amounts = facts.withColumn("amount", F.lit(2.5))
    assert sketches.count_between(sketches.distinct_sketches(amounts, "amount"), []).first()["n_distinct"] == 1


def test_tasks_follow_the_points(spark):
    assert [work_partitions(n) for n in (0, 1, 20_000, 20_001, 83_000_000)] == [1, 1, 1, 2, 4150]

    def tasks(series):
        panel = spark.range(series * 4).selectExpr("id DIV 4 AS City", "date_add(DATE'2024-01-01', int(id % 4)) AS period", "double(id) AS sales")
        return series_arrays(panel, ["City"]).rdd.getNumPartitions()

    # The session's setting is 8 throughout.
    assert (tasks(1000), tasks(100_000), tasks(1_000_000)) == (1, 20, 200)
    panel = spark.range(40).selectExpr("id AS City", "DATE'2024-01-01' AS period", "1D AS sales")
    assert series_arrays(panel, ["City"], partitions=3).rdd.getNumPartitions() == 3
