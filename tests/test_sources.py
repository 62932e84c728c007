import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelcast.operators import roles
from panelcast.operators.periods import to_periods
from panelcast.session import materialize, shared_dir
from panelcast.sources import profile, readers, sinks


def write(folder, name, text):
    (folder / name).write_text(text)
    return str(folder)


def test_month_and_year(spark, tmp_path):
    path = write(tmp_path, "a.csv", "Month,Year,City,Revenue\nJan,2022,x,1.5\n3,2022,x,2\n3.7,2022,y,4\nMay,2022.0,y,8\n")
    write(tmp_path, "b.csv", "Month,Year,City,Revenue\njune,2022,x,16\n13,2022,x,32\nDecember,2023,x,oops\n 7 ,2023,x,64\n")
    (tmp_path / "notes.txt").write_text("not a table")
    rows = readers.load_sales(spark, path).orderBy("date", "Revenue").collect()
    assert [(r["month_num"], r["date"], r["Revenue"]) for r in rows] == [
        (1, dt.date(2022, 1, 1), 1.5), (3, dt.date(2022, 3, 1), 2.0), (3, dt.date(2022, 3, 1), 4.0),
        (5, dt.date(2022, 5, 1), 8.0), (7, dt.date(2023, 7, 1), 64.0), (12, dt.date(2023, 12, 1), None)]
    assert sorted(r["Month"] for r in readers.rejected_rows(spark, path).collect()) == ["13", "june"]
    with pytest.raises(Exception, match="unreadable Month/Year"):
        readers.load_sales(spark, path, mode="strict").collect()
    one = readers.load_sales(spark, f"{path}/a.csv", mode="strict")
    assert one.count() == 4
    totals = to_periods(one, ["City"], "YS", scale=2).orderBy("City").collect()
    assert [(r["City"], r["sales"]) for r in totals] == [("x", 3.5), ("y", 12.0)]


def test_parquet_facts(spark, tmp_path):
    df = spark.createDataFrame([(3, 2024, 5.0), (14, 2024, 6.0)], "Month int, Year int, Revenue double")
    df.write.parquet(str(tmp_path / "p"))
    rows = readers.load_sales(spark, str(tmp_path / "p"), source="parquet").collect()
    assert [(r["date"], r["Revenue"]) for r in rows] == [(dt.date(2024, 3, 1), 5.0)]
    assert readers.rejected_rows(spark, str(tmp_path / "p"), source="parquet").count() == 1


def test_quarter_and_year(spark, tmp_path):
    path = write(tmp_path, "q.csv", "Quarter,Year,Sales\nQ1,2022,1\n2,2022,2\nQ3,2022,3\n4,2022,4\nQ5,2022,5\nq1,2022,6\n")
    rows = readers.load_sales(spark, path).orderBy("date").collect()
    assert [(r["month_num"], r["date"].month) for r in rows] == [(1, 1), (4, 4), (7, 7), (10, 10)]


def test_free_dates(spark, tmp_path):
    text = "id,order_time,Total\n1,2024-01-02,1\n2,2024-01-13,2\n3,01/02/2024,3\n4,13/02/2024,4\n5,later,5\n6,2024-01-02 10:30:00,6\n"
    path = write(tmp_path, "f.csv", text)
    rows = {r["id"]: r["date"] for r in readers.load_sales(spark, path).collect()}
    assert rows == {"1": dt.date(2024, 1, 2), "2": dt.date(2024, 1, 13), "3": dt.date(2024, 2, 1),
                    "4": dt.date(2024, 2, 13), "6": dt.date(2024, 1, 2)}
    legacy = {r["id"]: r["date"] for r in readers.load_sales(spark, path, legacy_dayfirst=True).collect()}
    assert legacy["1"] == dt.date(2024, 2, 1) and "2" not in legacy
    assert legacy["3"] == dt.date(2024, 2, 1) and legacy["4"] == dt.date(2024, 2, 13)


def test_explicit_date_column(spark, tmp_path):
    path = write(tmp_path, "e.csv", "Update_Count,sold_on,Revenue\n1,2024-05-06,2\n")
    assert readers.load_sales(spark, path).count() == 0  # the name rule takes Update_Count
    assert readers.load_sales(spark, path, date_col="sold_on").first()["date"] == dt.date(2024, 5, 6)


def test_missing_input(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.load_sales(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        readers.load_sales(spark, str(tmp_path / "nowhere"))
    path = write(tmp_path, "n.csv", "a,b\n1,2\n")
    with pytest.raises(ValueError, match="no date column"):
        readers.load_sales(spark, path)


def test_role_names():
    columns = ["Lifetime", "order_DATE", "Sales_Tax", "Unit_Price", "net_income", "price"]
    assert roles.detect_date_column(columns) == "Lifetime"
    assert roles.date_candidates(columns) == ["Lifetime", "order_DATE"]
    assert roles.detect_sales_column(columns) == "Unit_Price"
    assert roles.detect_sales_column(["x", "net_income"]) == "net_income"
    assert roles.sales_candidates(columns) == ["Sales_Tax", "Unit_Price", "price"]
    with pytest.raises(ValueError, match="no sales column"):
        roles.detect_sales_column(["x", "price"])


def test_profile(spark):
    df = spark.createDataFrame([(2, "b"), (1, None), (3, "c")], "k int, v string")
    rows = profile.table_profile(df, "k").orderBy("position").collect()
    assert [(r["column_name"], r["dtype"], r["sample"], r["n_rows"], r["n_columns"]) for r in rows] == [
        ("k", "int", "1", 3, 2), ("v", "string", None, 3, 2)]


def test_load_summary(spark):
    rows = [("x", "s1", dt.date(2024, 1, 1)), ("x", "s2", dt.date(2024, 5, 1)), (None, "s1", dt.date(2023, 1, 1))]
    df = spark.createDataFrame(rows, "City string, Store_ID string, date date")
    got = profile.load_summary(df).first()
    assert tuple(got) == (3, 3, dt.date(2023, 1, 1), dt.date(2024, 5, 1), 1, 2)
    assert profile.load_summary(df.drop("City")).columns == ["n_rows", "n_columns", "first_date", "last_date", "n_stores"]
    assert profile.load_summary(df.where("false")).first()["n_rows"] == 0


def test_sinks(spark, tmp_path):
    df = spark.range(10).withColumn("City", (F.col("id") % 2).cast("string"))
    sinks.write_table(df, str(tmp_path / "t"), ["City"])
    assert spark.read.parquet(str(tmp_path / "t")).where("City = '1'").count() == 5
    paths = sinks.write_tables({"a": df, "b": df.limit(3)}, str(tmp_path / "all"))
    assert spark.read.parquet(paths["b"]).count() == 3


def test_materialize_cuts_lineage(spark):
    df = spark.range(5).selectExpr("id", "id * 2 AS twice")
    stored = materialize(df, "probe")
    assert sorted(map(tuple, stored.collect())) == [(i, 2 * i) for i in range(5)]
    assert stored.inputFiles()[0].startswith("file:" + shared_dir(spark)) or shared_dir(spark) in stored.inputFiles()[0]
