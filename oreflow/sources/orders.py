"""Nested sales-order documents: one row per order with its lines as an array of structs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from oreflow.functions.time import epoch_text_to_time_text
from oreflow.sources.tables import PENDING, table

#: Line numbers that one document covers; an order with higher ones arrives in several documents.
LINES_PER_DOCUMENT = 10_000


def order_documents(
    spark: SparkSession, sf_dir: str, lines_per_document: int = LINES_PER_DOCUMENT
) -> DataFrame:
    """Order documents as a JSON feed would deliver them, built from the flat tables.

    Each document of an order covers a range of line numbers and carries its place among the order's documents and
    the number of lines before its first one, so no array grows with the size of an order, and lines keep their
    number within the order. A range holds as many lines as it has numbers, and copies of those. Orders without
    lines are kept with a NULL array.
    """
    lines = _numbered(spark, sf_dir, lines_per_document)
    # shuffled once as plain rows: lists gain nothing from being built before the shuffle
    rows = lines.select(F.col("l_orderkey").alias("key"), "range", _product().alias("product")).unionByName(
        _document_headers(spark, sf_dir, lines), allowMissingColumns=True
    )
    grouped = rows.repartition("key", "range").groupBy("key", "range")
    documents = grouped.agg(
        F.first("header", ignorenulls=True).alias("header"),
        F.sort_array(F.collect_list("product")).alias("products"),
    )
    return _business(
        documents.filter(F.col("header").isNotNull()).select(
            "header.*", F.when(F.size("products") > 0, F.col("products")).alias("ordered_products")
        )
    )


def order_headers(spark: SparkSession, sf_dir: str, lines_per_document: int = LINES_PER_DOCUMENT) -> DataFrame:
    """The documents without their arrays: lines are only counted."""
    headers = _document_headers(spark, sf_dir, _numbered(spark, sf_dir, lines_per_document))
    return _business(headers.select("header.*"))


def _numbered(spark: SparkSession, sf_dir: str, lines_per_document: int) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_linestatus",
        F.floor(F.col("l_linenumber") / lines_per_document).alias("range"),
    )


def _document_headers(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    """(key, range, header) of every document; the counts per document are added up along the order."""
    counts = lines.groupBy("l_orderkey", "range").agg(F.count("*").alias("n_lines"))
    along = Window.partitionBy("l_orderkey").orderBy(F.col("range").asc_nulls_first())
    before = F.sum("n_lines").over(along.rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.withColumns({"part": F.row_number().over(along) - 1, "first_line": F.coalesce(before, F.lit(0))})
    names = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    named = orders.join(names, F.col("o_custkey") == F.col("c_custkey"), "left")
    joined = named.join(counts, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    header = F.struct(
        "o_orderkey", "o_custkey", "c_name", "o_orderdate", "o_orderstatus",
        F.coalesce("part", F.lit(0)).alias("part"),
        F.coalesce("first_line", F.lit(0)).cast("bigint").alias("first_line"),
        F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
    )
    return joined.select(F.col("o_orderkey").alias("key"), "range", header.alias("header"))


def _product() -> Column:
    return F.struct(
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("id"),
        F.col("l_suppkey").alias("supplier"),
        F.lit("USD").alias("curr"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("qty"),
        F.col("l_linestatus").alias("unit"),
    )


def _business(documents: DataFrame) -> DataFrame:
    seconds = F.unix_timestamp(F.col("o_orderdate").cast("timestamp"))
    columns = [
        F.col("o_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.when(F.col("o_orderstatus") == PENDING, "").otherwise(seconds.cast("string")).alias("order_datetime"),
        F.col("o_orderkey").alias("order_number"),
        F.col("n_lines").alias("number_of_line_items"),
        F.col("part").alias("document_part"),
        F.col("first_line"),
    ]
    if "ordered_products" in documents.columns:
        columns.append(F.col("ordered_products"))
    return documents.select(*columns)


# Fields of an order document and the names they have in the bronze table.
BRONZE_NAMES = {
    "customer_id": "CustomerID",
    "customer_name": "CustomerName",
    "order_datetime": "OrderDateTime",
    "order_number": "OrderNo",
    "number_of_line_items": "LineItemCount",
    "document_part": "DocumentPart",
    "first_line": "FirstLine",
    "ordered_products": "OrderedProducts",
}


def bronze_orders(documents: DataFrame) -> DataFrame:
    """The business columns of order documents under their table names."""
    return documents.select(*[F.col(c).alias(BRONZE_NAMES[c]) for c in BRONZE_NAMES if c in documents.columns])


def order_lines(bronze: DataFrame) -> DataFrame:
    """One row per ordered product; an order without products gives one row with NULL product columns.

    The order time comes as text with unix seconds and may be empty, which becomes NULL. A table without ``FirstLine``
    has whole orders only.
    """
    if "FirstLine" not in bronze.columns:
        bronze = bronze.withColumn("FirstLine", F.lit(0).cast("bigint"))
    # converted per document, before there is one row per product
    timed = bronze.withColumn("OrderDateTime", epoch_text_to_time_text("OrderDateTime"))
    exploded = timed.select(
        "CustomerID",
        "OrderDateTime",
        "OrderNo",
        "FirstLine",
        F.posexplode_outer("OrderedProducts").alias("pos", "product"),
    )
    return exploded.select(
        "CustomerID",
        F.col("product.id").alias("ProductID"),
        "OrderDateTime",
        "OrderNo",
        (F.col("FirstLine") + F.col("pos") + 1).alias("LineNo"),
        F.col("product.curr").alias("CurrencyCode"),
        F.col("product.price").alias("Price"),
        F.col("product.qty").alias("Quantity"),
        (F.col("product.price") * F.col("product.qty")).alias("OrderAmount"),
        F.col("product.unit").alias("UnitOfMeasure"),
    )


def silver_customers(bronze: DataFrame) -> DataFrame:
    return bronze.select("CustomerID", "CustomerName").distinct()
