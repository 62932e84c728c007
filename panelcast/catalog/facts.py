"""The sales facts of the test tables: which columns play date, revenue, city, store, category.

Dimensions are joined by plain equi-joins. A helper that promises facts gives every fact; one that
promises sums or a panel always sums by foreign key (and period) before the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.operators.enrich import attach, summed
from panelcast.operators.periods import to_periods


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``date, Revenue, o_custkey``: one row per order."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("date"), F.col("o_totalprice").alias("Revenue"), "o_custkey"
    )


def with_city(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """Rows keyed by ``o_custkey`` with ``City``, the nation of the customer."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("City"))
    rows = attach(rows, customer, "o_custkey", "c_custkey")
    return attach(rows, nation, "c_nationkey", "n_nationkey").drop("o_custkey", "c_nationkey")


def city_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``date, Revenue, City``: one row per order."""
    return with_city(spark, sf_dir, order_facts(spark, sf_dir))


def city_sums(spark: SparkSession, sf_dir: str, freq: str | None = None) -> DataFrame:
    """``Revenue, City`` (and ``date``, the period label): one row per customer (and period)."""
    return with_city(spark, sf_dir, summed(order_facts(spark, sf_dir), ["o_custkey"], "Revenue", 2, freq))


def city_panel(spark: SparkSession, sf_dir: str, freq: str = "MS") -> DataFrame:
    """``City, period, sales``."""
    return to_periods(city_sums(spark, sf_dir, freq), ["City"], freq, sales_col="Revenue", scale=2)


def total_panel(spark: SparkSession, sf_dir: str, freq: str = "MS") -> DataFrame:
    """``period, sales`` of all orders."""
    return to_periods(order_facts(spark, sf_dir), (), freq, sales_col="Revenue", scale=2)


def line_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``date, Store_ID, l_partkey, Revenue``: one row per order line, the supplier is the store.

    Net revenue is an exact four-digit decimal.
    """
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    net = F.lit(1).cast("decimal(3,2)") - F.col("l_discount").cast("decimal(3,2)")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("date"),
        F.col("l_suppkey").alias("Store_ID"),
        "l_partkey",
        (price * net).alias("Revenue"),
    )


def with_store_city(spark: SparkSession, sf_dir: str, stores: DataFrame) -> DataFrame:
    """Rows keyed by ``Store_ID`` with ``City``, the nation of the supplier."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("City"))
    stores = attach(stores, supplier, "Store_ID", "s_suppkey")
    return attach(stores, nation, "s_nationkey", "n_nationkey").drop("s_nationkey")


def category_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``Category, Revenue``: one row per part; the part type is the category."""
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("Category"))
    sums = summed(line_facts(spark, sf_dir).select("l_partkey", "Revenue"), ["l_partkey"], "Revenue")
    return attach(sums, part, "l_partkey", "p_partkey").select("Category", "Revenue")


def event_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``date`` (a timestamp), ``Revenue`` and ``Category`` of the event stream table."""
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("date"), F.col("value").alias("Revenue"), F.col("event_type").alias("Category")
    )
