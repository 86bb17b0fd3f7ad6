"""The given tables, and the domain rows that stand on them.

Raw table -> domain: lineitem + orders are sales order lines, part is the product list, customer the
customer list, events are sensor readings (or device activity).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PENDING = "P"  # an order in this status has no order time yet


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_time_text(order_time: str | Column, status: str | Column) -> Column:
    """Order time as text, NULL while the order is pending."""
    return F.when(F.col(status) != PENDING, F.date_format(order_time, "yyyy-MM-dd HH:mm:ss"))


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines without what only the order itself knows: customer and order time."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("ProductID"),
        F.col("l_orderkey").alias("OrderNo"),
        F.col("l_linenumber").alias("LineNo"),
        F.lit("USD").alias("CurrencyCode"),
        F.col("l_extendedprice").alias("Price"),
        F.col("l_quantity").alias("Quantity"),
        (F.col("l_extendedprice") * F.col("l_quantity")).alias("OrderAmount"),
        F.col("l_linestatus").alias("UnitOfMeasure"),
    )


def with_order(lines: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines in the silver layout. Lines are the left side of the join, orders are unique."""
    orders = table(spark, sf_dir, "orders")
    joined = lines.join(orders, F.col("OrderNo") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("CustomerID"),
        order_time_text("o_orderdate", "o_orderstatus").alias("OrderDateTime"),
        *lines.columns,
    )
    return joined.select("CustomerID", "ProductID", "OrderDateTime", *[c for c in lines.columns if c != "ProductID"])


def sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_order(line_items(spark, sf_dir), spark, sf_dir)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product list with the price as DECIMAL(10,2)."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("ProductID"),
        F.col("p_type").alias("ProductCategory"),
        F.col("p_name").alias("ProductName"),
        F.col("p_brand").alias("UnitOfMeasure"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("SalePrice"),
    )


def bronze_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product list as its text file holds it: every column a string."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_type").alias("product_category"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("product_unit"),
        F.col("p_retailprice").cast("string").alias("sales_price"),
    )


def silver_products(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        F.col("product_id").cast("bigint").alias("ProductID"),
        F.col("product_category").alias("ProductCategory"),
        F.col("product_name").alias("ProductName"),
        F.col("product_unit").alias("UnitOfMeasure"),
        F.col("sales_price").cast("decimal(10,2)").alias("SalePrice"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("CustomerID"), F.col("c_name").alias("CustomerName")
    )


def readings_of(events: DataFrame) -> DataFrame:
    """Sensor readings out of event rows; the same code serves a table and a stream of events."""
    k = F.get_json_object("props", "$.k").cast("double")
    return events.select(
        F.col("event_id").alias("id"),
        F.col("ts").cast("timestamp").alias("reading_time"),
        F.when(F.col("user_id") % 2 == 0, "Transformer").otherwise("Rectifier").alias("device_type"),
        F.col("user_id").cast("string").alias("device_id"),
        F.col("event_type").alias("device_operational_status"),
        F.col("value").alias("reading_1"),
        k.alias("reading_2"),
        (F.col("value") * k / 100).alias("reading_3"),
    )


def sensor_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_of(table(spark, sf_dir, "events"))


# The same rows for the SQL side of a registered query; put in front of it as a WITH list.
LINES_SQL = """lines AS (
  SELECT o_custkey AS "CustomerID", l_partkey AS "ProductID",
         CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS "OrderDateTime",
         o_orderkey AS "OrderNo", l_linenumber AS "LineNo", 'USD' AS "CurrencyCode",
         l_extendedprice AS "Price", l_quantity AS "Quantity",
         l_extendedprice * l_quantity AS "OrderAmount", l_linestatus AS "UnitOfMeasure"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

READINGS_SQL = """readings AS (
  SELECT event_id AS id, ts AS reading_time,
         CASE WHEN user_id % 2 = 0 THEN 'Transformer' ELSE 'Rectifier' END AS device_type,
         CAST(user_id AS VARCHAR) AS device_id, event_type AS device_operational_status,
         value AS reading_1,
         CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS reading_2,
         value * CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) / 100 AS reading_3
  FROM events)"""
