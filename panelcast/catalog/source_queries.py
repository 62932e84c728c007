"""Loading, profiling, role inference and date construction."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from panelcast.catalog import facts as stand_in
from panelcast.catalog.registry import register
from panelcast.catalog.sql_text import NET
from panelcast.operators import roles, sketches, summaries
from panelcast.operators.periods import to_periods
from panelcast.session import materialize, scratch_path
from panelcast.sources import profile, readers


@register(
    "table_profile",
    """
    WITH t AS (SELECT count(*) AS n_rows, arg_min(orders, o_orderkey) AS r FROM orders)
    SELECT n_rows, 6 AS n_columns, v.position, v.column_name, v.dtype, v.sample FROM t, LATERAL (VALUES
      (0, 'o_orderkey', 'bigint', cast(r.o_orderkey AS varchar)),
      (1, 'o_custkey', 'bigint', cast(r.o_custkey AS varchar)),
      (2, 'o_orderstatus', 'string', r.o_orderstatus),
      (3, 'o_totalprice', 'double', cast(r.o_totalprice AS varchar)),
      (4, 'o_orderdate', 'timestamp_ntz', cast(r.o_orderdate AS varchar)),
      (5, 'o_orderpriority', 'string', r.o_orderpriority)) v(position, column_name, dtype, sample)
    """,
)
def table_profile(spark, sf_dir):
    return profile.table_profile(stand_in.table(spark, sf_dir, "orders"), "o_orderkey")


@register(
    "load_summary",
    """
    SELECT count(*) AS n_rows, 4 AS n_columns, cast(min(l_shipdate) AS date) AS first_date,
           cast(max(l_shipdate) AS date) AS last_date, count(DISTINCT n_name) AS n_cities,
           count(DISTINCT l_suppkey) AS n_stores
    FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey
    """,
)
def load_summary(spark, sf_dir):
    """Lines are reduced to one row per store before the store's city is looked up."""
    stores = profile.summary_parts(stand_in.line_facts(spark, sf_dir), ["Store_ID"])
    parts = stand_in.with_store_city(spark, sf_dir, stores)
    return profile.summary_from_parts(parts, 4, {"City": "n_cities", "Store_ID": "n_stores"})


def _mixed_orders(spark, sf_dir):
    """Orders as an untidy file would hold them: text dates in several shapes, and a name that
    only looks like a date column."""
    orders = stand_in.table(spark, sf_dir, "orders")
    day = F.col("o_orderdate")
    text = (
        F.when(F.col("o_orderstatus") == "O", F.date_format(day, "yyyy-MM-dd"))
        .when(F.col("o_orderstatus") == "F", F.date_format(day, "dd/MM/yyyy"))
        .when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("week of "), F.date_format(day, "yyyy-MM-dd")))
    )
    return orders.select(
        text.alias("order_date"),
        F.col("o_custkey").alias("Update_Count"),
        F.col("o_totalprice").alias("Revenue"),
        F.format_number("o_totalprice", 2).alias("total_text"),
        "o_orderstatus",
    )


_MIXED_SQL = """
    SELECT CASE WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y-%m-%d')
                WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%d/%m/%Y')
                WHEN o_orderpriority = '5-LOW' THEN NULL
                ELSE 'week of ' || strftime(o_orderdate, '%Y-%m-%d') END AS order_date, o_orderdate,
           o_custkey, o_totalprice, o_orderstatus
    FROM orders
"""


@register(
    "role_profile",
    f"""
    WITH m AS ({_MIXED_SQL}),
    c AS (
      SELECT count(*) AS n,
             count(CASE WHEN regexp_matches(order_date, '^[0-9]') THEN 1 END) AS ok_date, count(order_date) AS some_date,
             count(CASE WHEN o_totalprice < 1000 THEN 1 END) AS ok_text
      FROM m)
    SELECT v.column_name, v.role, v.name_match, v.parse_rate, v.null_rate FROM c, LATERAL (VALUES
      ('order_date', 'date', true, cast(ok_date AS double) / n, 1 - cast(some_date AS double) / n),
      ('Update_Count', 'date', false, 0.0::double, 0.0::double),
      ('Revenue', 'sales', true, 1.0::double, 0.0::double),
      ('total_text', 'sales', false, cast(ok_text AS double) / n, 0.0::double))
      v(column_name, role, name_match, parse_rate, null_rate)
    """,
)
def role_profile(spark, sf_dir):
    return roles.role_profile(_mixed_orders(spark, sf_dir))


@register(
    "date_free_text",
    f"""
    WITH m AS ({_MIXED_SQL})
    SELECT o_orderstatus, cast(o_orderdate AS date) AS date, count(*) AS n_rows
    FROM m WHERE order_date IS NOT NULL AND regexp_matches(order_date, '^[0-9]') GROUP BY 1, 2
    """,
)
def date_free_text(spark, sf_dir):
    dated = readers.with_dates(_mixed_orders(spark, sf_dir))
    kept = dated.where(F.col("date").isNotNull())
    return kept.groupBy("o_orderstatus", "date").agg(F.count(F.lit(1)).alias("n_rows"))


@register(
    "date_free_text_legacy",
    f"""
    WITH m AS ({_MIXED_SQL}),
    d AS (
      SELECT CASE WHEN o_orderstatus = 'F' THEN cast(o_orderdate AS date)
                  WHEN day(o_orderdate) <= 12 THEN make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate))
             END AS date
      FROM m WHERE order_date IS NOT NULL AND regexp_matches(order_date, '^[0-9]'))
    SELECT date, count(*) AS n_rows FROM d WHERE date IS NOT NULL GROUP BY 1
    """,
)
def date_free_text_legacy(spark, sf_dir):
    dated = readers.with_dates(_mixed_orders(spark, sf_dir), legacy_dayfirst=True)
    return dated.where(F.col("date").isNotNull()).groupBy("date").agg(F.count(F.lit(1)).alias("n_rows"))


def _month_text(spark, sf_dir):
    """Orders with Month and Year text; the way a month is written varies by priority and one of
    the spellings is not a month name."""
    orders = stand_in.table(spark, sf_dir, "orders")
    day, how = F.col("o_orderdate"), F.substring("o_orderpriority", 1, 1)
    month = (
        F.when(how == "1", F.date_format(day, "MMMM"))
        .when(how == "2", F.date_format(day, "MMM"))
        .when(how == "3", F.month(day).cast("string"))
        .when(how == "4", F.concat(F.month(day).cast("string"), F.lit(".7")))
        .otherwise(F.lower(F.date_format(day, "MMMM")))
    )
    return orders.select(
        month.alias("Month"),
        F.year(day).cast("string").alias("Year"),
        F.col("o_orderpriority").alias("City"),
        F.col("o_custkey").cast("string").alias("Store_ID"),
        F.col("o_orderstatus").alias("Category"),
        F.col("o_totalprice").alias("Revenue"),
    )


@register(
    "date_from_month_year",
    """
    SELECT o_orderpriority AS City, month(o_orderdate)::int AS month_num,
           cast(date_trunc('month', o_orderdate) AS date) AS date, count(*) AS n_rows
    FROM orders WHERE o_orderpriority NOT LIKE '5%' GROUP BY 1, 2, 3
    """,
)
def date_from_month_year(spark, sf_dir):
    dated = readers.with_dates(_month_text(spark, sf_dir)).where(F.col("date").isNotNull())
    return dated.groupBy("City", "month_num", "date").agg(F.count(F.lit(1)).alias("n_rows"))


@register(
    "date_from_quarter",
    """
    SELECT cast(date_trunc('quarter', o_orderdate) AS date) AS date,
           (quarter(o_orderdate) * 3 - 2)::int AS month_num, count(*) AS n_rows
    FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1, 2
    """,
)
def date_from_quarter(spark, sf_dir):
    orders = stand_in.table(spark, sf_dir, "orders")
    q = F.quarter("o_orderdate").cast("string")
    text = (
        F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("Q"), q))
        .when(F.col("o_orderstatus") == "F", q)
        .otherwise(F.concat(F.lit("quarter "), q))
    )
    facts = orders.select(text.alias("Quarter"), F.year("o_orderdate").alias("Year"))
    dated = readers.with_dates(facts).where(F.col("date").isNotNull())
    return dated.groupBy("date", "month_num").agg(F.count(F.lit(1)).alias("n_rows"))


@register(
    "csv_load_periods",
    """
    SELECT o_orderpriority AS City, cast(date_trunc('month', o_orderdate) AS date) AS period,
           cast(sum(cast(o_totalprice AS decimal(18,2))) AS double) AS sales
    FROM orders WHERE o_orderpriority NOT LIKE '5%' GROUP BY 1, 2
    """,
)
def csv_load_periods(spark, sf_dir):
    """Orders written as CSV files, then loaded and aggregated the way a CSV user would."""
    path = scratch_path(spark, "orders-csv")
    _month_text(spark, sf_dir).write.option("header", True).csv(path)
    return to_periods(readers.load_sales(spark, path), ["City"], "MS", scale=2)


def _defective_csv(spark, sf_dir) -> str:
    """Orders as lines of a CSV file, with blank, unreadable and impossible months, amounts that are no numbers, and
    records of five fields under a header of four."""
    orders = stand_in.table(spark, sf_dir, "orders")
    day, status, how = F.col("o_orderdate"), F.col("o_orderstatus"), F.substring("o_orderpriority", 1, 1)
    month = (
        F.when((how == "2") & (status == "F"), F.lit(" "))
        .when((how == "3") & (status == "O"), F.lit("13"))
        .when((how == "4") & (status == "P"), F.lit("xx"))
        .when(how == "5", F.lit("someday"))
        .when(how == "1", F.date_format(day, "MMMM"))
        .otherwise(F.month(day).cast("string"))
    )
    amount = F.when((how == "1") & (status == "P"), F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    fields = [month, F.year(day).cast("string"), F.col("o_orderstatus"), amount, F.when(how == "4", F.lit("beyond"))]
    line = F.concat_ws(",", *fields).alias("Month,Year,City,Revenue")
    path = scratch_path(spark, "defects-csv")
    # One column, written as it is: its name is the header line.
    orders.select(line).write.options(header=True, sep="\u0001", quote="\u0000").csv(path)
    return path


_DEFECTS = """
    SELECT CASE WHEN how = '2' AND o_orderstatus = 'F' THEN 'missing' WHEN how = '3' AND o_orderstatus = 'O' THEN 'out_of_range'
                WHEN how = '4' AND o_orderstatus = 'P' THEN 'malformed' WHEN how = '5' THEN 'unreadable' END AS reject_reason,
           how = '4' AND o_orderstatus <> 'P' AS kept_malformed, how = '1' AND o_orderstatus = 'P' AS bad_amount
    FROM (SELECT *, substr(o_orderpriority, 1, 1) AS how FROM orders)"""


@register("load_reasons", f"SELECT reject_reason, count(*) AS n_rows FROM ({_DEFECTS}) GROUP BY 1")
def load_reasons(spark, sf_dir):
    """Kept (null) and dropped rows of a load by reason."""
    rows = readers.labelled_sales(spark, _defective_csv(spark, sf_dir))
    return rows.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n_rows"))


@register(
    "load_report",
    f"""SELECT count(*) AS n_rows, count(*) FILTER (reject_reason IS NULL) AS n_kept,
           {", ".join(f"count(*) FILTER (reject_reason = '{r}') AS rejected_{r}" for r in readers.REASONS)},
           count(*) FILTER (kept_malformed) AS kept_malformed, count(*) FILTER (bad_amount) AS unreadable_amounts
    FROM ({_DEFECTS})""",
)
def load_report(spark, sf_dir):
    """The numbers that came by while the panel was written, without another scan."""
    facts, report = readers.observed_sales(spark, _defective_csv(spark, sf_dir))
    materialize(to_periods(facts, ["City"], "MS", scale=2), "panel")
    counts = report.counts()
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{c} long" for c in counts))


@register("city_list", "SELECT DISTINCT n_name AS City FROM nation JOIN customer ON c_nationkey = n_nationkey "
          "JOIN orders ON o_custkey = c_custkey")
def city_list(spark, sf_dir):
    customers = stand_in.order_facts(spark, sf_dir).select("o_custkey").distinct()
    return summaries.distinct_sorted(stand_in.with_city(spark, sf_dir, customers), "City")


@register(
    "city_first_seen",
    """
    SELECT n_name AS City, cast(min(o_orderdate) AS date) AS first_date
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey GROUP BY 1
    """,
)
def city_first_seen(spark, sf_dir):
    firsts = stand_in.order_facts(spark, sf_dir).groupBy("o_custkey").agg(F.min("date").alias("date"))
    return summaries.distinct_first_seen(stand_in.with_city(spark, sf_dir, firsts), "City")


@register("store_count", 'SELECT count(DISTINCT l_suppkey) AS "n_Store_ID" FROM lineitem')
def store_count(spark, sf_dir):
    return summaries.count_distinct_values(stand_in.line_facts(spark, sf_dir), "Store_ID")


@register(
    "part_count_sketches",
    """
    SELECT n_name AS City, count(DISTINCT l_partkey) AS n_parts, true AS within_3_percent
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
    WHERE l_shipdate >= '1996-01-01' AND l_shipdate < '1999-01-01' GROUP BY 1
    """,
)
def part_count_sketches(spark, sf_dir):
    """Sketches stored by store and month, merged to cities over three years, next to the exact counts."""
    lines = stand_in.line_facts(spark, sf_dir)
    by_store = materialize(sketches.distinct_sketches(lines, "l_partkey", ["Store_ID"]), "sketches")
    by_city = stand_in.with_store_city(spark, sf_dir, by_store)
    found = sketches.count_between(by_city, ["City"], (dt.date(1996, 1, 1), dt.date(1998, 12, 1)), "estimate")
    inside = lines.where((F.col("date") >= "1996-01-01") & (F.col("date") < "1999-01-01"))
    pairs = stand_in.with_store_city(spark, sf_dir, inside.select("Store_ID", "l_partkey").distinct())
    exact = pairs.groupBy("City").agg(F.count_distinct("l_partkey").alias("n_parts"))
    near = F.abs(F.col("estimate") - F.col("n_parts")) <= F.col("n_parts") * 0.03
    return exact.join(found, "City").select("City", "n_parts", near.alias("within_3_percent"))


@register(
    "sales_by_city",
    """
    SELECT n_name AS City, cast(sum(cast(o_totalprice AS decimal(18,2))) AS double) AS Revenue
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1
    """,
)
def sales_by_city(spark, sf_dir):
    return summaries.ranked_totals(stand_in.city_sums(spark, sf_dir), "City", scale=2)


@register(
    "category_share",
    f"""
    SELECT Category, Revenue, round(Revenue / sum(Revenue) OVER () * 100, 1) AS share FROM (
      SELECT p_type AS Category, cast(sum({NET}) AS double) AS Revenue
      FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)
    """,
)
def category_share(spark, sf_dir):
    return summaries.category_share(stand_in.category_sums(spark, sf_dir), "Category")


@register(
    "year_month_pivot",
    "SELECT year(o_orderdate)::int AS year, "
    + ", ".join(
        f"cast(sum(CASE WHEN month(o_orderdate) = {i} THEN cast(o_totalprice AS decimal(18,2)) END) AS double) "
        f"AS {label}"
        for i, label in enumerate(summaries.MONTH_LABELS, start=1)
    )
    + " FROM orders GROUP BY 1",
)
def year_month_pivot(spark, sf_dir):
    return summaries.year_month_pivot(stand_in.order_facts(spark, sf_dir), scale=2)
