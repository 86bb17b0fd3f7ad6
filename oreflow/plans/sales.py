"""Sales: nested orders to bronze, silver, gold and the analytical queries on top."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.operators import relational as rel
from oreflow.registry import query
from oreflow.sources import orders as nested
from oreflow.sources import tables as src

GOLD_SQL = f"""WITH {src.LINES_SQL}, gold AS (
  SELECT p_type AS "ProductCategory", p_name AS "ProductName", c_name AS "CustomerName",
         "OrderDateTime", "Quantity", "OrderAmount"
  FROM lines LEFT JOIN part ON p_partkey = "ProductID" LEFT JOIN customer ON c_custkey = "CustomerID")"""

MONTHLY_SQL = GOLD_SQL + """, monthly AS (
  SELECT "ProductCategory", "ProductName", "CustomerName",
         CAST(date_trunc('month', CAST("OrderDateTime" AS TIMESTAMP)) AS DATE) AS "YearMonth",
         CAST(CAST(SUM(CAST("Quantity" AS DECIMAL(30,8))) AS DECIMAL(30,2)) AS DOUBLE) AS "Quantity",
         CAST(CAST(SUM(CAST("OrderAmount" AS DECIMAL(30,8))) AS DECIMAL(30,2)) AS DOUBLE) AS "OrderAmount"
  FROM gold GROUP BY 1, 2, 3, 4)"""

CATEGORY_TOTALS_SQL = """SELECT p_type AS "ProductCategory",
  CAST(CAST(SUM(CAST(l_extendedprice * l_quantity AS DECIMAL(30,8))) AS DECIMAL(30,2)) AS DOUBLE) AS "TotalSales",
  CAST(CAST(SUM(CAST(l_quantity AS DECIMAL(30,8))) AS DECIMAL(30,2)) AS DOUBLE) AS "TotalQuantity"
  FROM lineitem LEFT JOIN part ON p_partkey = l_partkey """

# Two of the product categories, as a user would pick them from the list.
CHOSEN_CATEGORIES = ["ECONOMY", "PROMO"]


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel.gold_lines(
        src.sales_lines(spark, sf_dir), src.customers(spark, sf_dir), src.products(spark, sf_dir)
    )


def _documents_sql(lines_per_document: int) -> str:
    """Documents with their place among those of the order and the lines before them."""
    return f"""documents AS (SELECT l_orderkey, COUNT(*) AS n,
        ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber // {lines_per_document}) - 1 AS part,
        COALESCE(SUM(COUNT(*)) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber // {lines_per_document}
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM lineitem GROUP BY l_orderkey, l_linenumber // {lines_per_document})"""


def _bronze_sql(lines_per_document: int) -> str:
    return f"""WITH {_documents_sql(lines_per_document)}
    SELECT o_custkey AS "CustomerID", c_name AS "CustomerName",
      CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(epoch(o_orderdate) AS BIGINT) AS VARCHAR) ELSE '' END AS "OrderDateTime",
      o_orderkey AS "OrderNo", COALESCE(n, 0) AS "LineItemCount", COALESCE(n, 0) AS "ProductRows",
      CAST(COALESCE(part, 0) AS INT) AS "DocumentPart", CAST(COALESCE(before, 0) AS BIGINT) AS "FirstLine"
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN documents ON l_orderkey = o_orderkey"""


@query(_bronze_sql(nested.LINES_PER_DOCUMENT))
def bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order documents under their table names; the array is shown by its size."""
    bronze = nested.bronze_orders(nested.order_documents(spark, sf_dir))
    rows = F.when(F.col("OrderedProducts").isNull(), 0).otherwise(F.size("OrderedProducts"))
    return bronze.withColumn("ProductRows", rows).drop("OrderedProducts")


NESTED_LINES_SQL = """SELECT o_custkey AS "CustomerID", l_partkey AS "ProductID",
      CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS "OrderDateTime",
      o_orderkey AS "OrderNo",
      CASE WHEN l_orderkey IS NOT NULL THEN ROW_NUMBER() OVER (PARTITION BY o_orderkey
        ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_linestatus) END AS "LineNo",
      CASE WHEN l_orderkey IS NOT NULL THEN 'USD' END AS "CurrencyCode",
      l_extendedprice AS "Price", l_quantity AS "Quantity", l_extendedprice * l_quantity AS "OrderAmount",
      l_linestatus AS "UnitOfMeasure"
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey"""


@query(NESTED_LINES_SQL)
def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per ordered product of the nested documents, orders without products kept."""
    return nested.order_lines(nested.bronze_orders(nested.order_documents(spark, sf_dir)))


@query(NESTED_LINES_SQL)
def order_lines_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from documents of two line numbers each: lines are numbered within the order, not the document."""
    return nested.order_lines(nested.bronze_orders(nested.order_documents(spark, sf_dir, lines_per_document=2)))


@query(_bronze_sql(2).replace('COALESCE(n, 0) AS "ProductRows",', ""))
def bronze_orders_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers of documents of two line numbers each."""
    return nested.bronze_orders(nested.order_headers(spark, sf_dir, lines_per_document=2))


FRACTIONS_SQL = """SELECT p_name AS "ProductName",
    CAST(CAST(SUM(CAST(l_quantity / 250 AS DECIMAL(30,8))) AS DECIMAL(30,2)) AS DOUBLE) AS "TotalQuantity"
  FROM lineitem LEFT JOIN part ON p_partkey = l_partkey GROUP BY 1"""


@query(FRACTIONS_SQL)
def popular_products_fractional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantity per product where lines hold thousandths: only the totals are rounded."""
    lines = src.line_items(spark, sf_dir).withColumn("Quantity", F.col("Quantity") / 250)
    return rel.popular_products(lines, src.products(spark, sf_dir))


@query(
    """SELECT o_custkey AS "CustomerID", c_name AS "CustomerName", COUNT(*) AS "NoOfOrders",
      CAST(SUM(COALESCE(n, 0)) AS BIGINT) AS "LineItemCount"
    FROM orders JOIN customer ON c_custkey = o_custkey
    LEFT JOIN (SELECT l_orderkey, COUNT(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
    GROUP BY 1, 2 ORDER BY "NoOfOrders" DESC"""
)
def orders_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and order lines per customer, most orders first; the product arrays are never built."""
    bronze = nested.bronze_orders(nested.order_headers(spark, sf_dir))
    return rel.orders_per_customer(bronze).orderBy(F.desc("NoOfOrders"))


@query("""SELECT DISTINCT o_custkey AS "CustomerID", c_name AS "CustomerName"
          FROM orders JOIN customer ON c_custkey = o_custkey""")
def silver_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct customers found in the orders."""
    orders = src.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("CustomerID"))
    # distinct before the join: the join then sees one row per customer however many orders one has
    return orders.distinct().join(src.customers(spark, sf_dir), "CustomerID")


@query("""SELECT p_partkey AS "ProductID", p_type AS "ProductCategory", p_name AS "ProductName",
          p_brand AS "UnitOfMeasure", CAST(p_retailprice AS DECIMAL(10,2)) AS "SalePrice" FROM part""")
def silver_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product list out of its all-text bronze rows, with typed key and price."""
    return src.silver_products(src.bronze_products(spark, sf_dir))


@query("""SELECT l_orderkey AS "OrderNo", l_linenumber AS "LineNo", COUNT(*) AS "Copies" FROM lineitem
          GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def find_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order line keys that occur more than once."""
    return rel.find_duplicates(src.line_items(spark, sf_dir), "OrderNo", "LineNo", count="Copies")


@query("WITH " + src.LINES_SQL + """ SELECT * EXCLUDE (r) FROM (SELECT *, ROW_NUMBER() OVER (
          PARTITION BY "CustomerID", "OrderNo", "LineNo" ORDER BY "ProductID", "Price", "Quantity", "UnitOfMeasure") AS r
          FROM lines) WHERE r = 1""")
def dedup_row_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One order line per customer, order and line number, ties broken by the remaining columns.

    An order has one customer, so lines are deduplicated before the order is joined to them: copies go
    before anything is shuffled.
    """
    tie_break = ["ProductID", "Price", "Quantity", "UnitOfMeasure"]
    single = rel.keep_first(src.line_items(spark, sf_dir), ["OrderNo", "LineNo"], tie_break)
    return src.with_order(single, spark, sf_dir)


@query(GOLD_SQL + "SELECT * FROM gold")
def gold_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with customer and product names."""
    return gold(spark, sf_dir)


@query(GOLD_SQL.replace("JOIN part ON", "JOIN (SELECT * FROM part WHERE p_size <= 25) ON") + "SELECT * FROM gold")
def gold_lines_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with products missing from the product list: their lines stay, names NULL."""
    small = src.table(spark, sf_dir, "part").filter("p_size <= 25").select(F.col("p_partkey").alias("ProductID"))
    known = src.products(spark, sf_dir).join(small, "ProductID", "left_semi")
    return rel.gold_lines(src.sales_lines(spark, sf_dir), src.customers(spark, sf_dir), known)


@query(MONTHLY_SQL + "SELECT * FROM monthly")
def monthly_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly totals per category, product and customer; undated lines form their own group."""
    return rel.monthly_sales(gold(spark, sf_dir))


@query(MONTHLY_SQL + """SELECT * FROM monthly ORDER BY "OrderAmount" DESC, "CustomerName", "ProductCategory",
          "ProductName", "YearMonth" NULLS FIRST LIMIT 10""")
def top_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten largest monthly amounts (a top-k report)."""
    order = [F.desc("OrderAmount"), "CustomerName", "ProductCategory", "ProductName", "YearMonth"]
    return rel.monthly_sales(gold(spark, sf_dir)).orderBy(*order).limit(10)


@query(CATEGORY_TOTALS_SQL + """GROUP BY 1 ORDER BY "TotalSales" DESC""")
def sales_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales and quantity per product category, best first."""
    totals = rel.sales_by_category(src.line_items(spark, sf_dir), src.products(spark, sf_dir))
    return totals.orderBy(F.desc("TotalSales"))


@query(CATEGORY_TOTALS_SQL + """WHERE p_type IN ('ECONOMY', 'PROMO') GROUP BY 1 ORDER BY "TotalSales" """)
def sales_by_category_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for a list of categories given as parameter; the list reaches the product scan."""
    lines, products = src.line_items(spark, sf_dir), src.products(spark, sf_dir)
    return rel.sales_by_category(lines, products, CHOSEN_CATEGORIES).orderBy("TotalSales")


@query(MONTHLY_SQL + """SELECT "ProductName", CAST(CAST(SUM(CAST("Quantity" AS DECIMAL(30,8))) AS DECIMAL(30,2)) AS DOUBLE) AS "TotalQuantity"
          FROM monthly GROUP BY 1 ORDER BY "TotalQuantity" DESC""")
def popular_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantity per product, most first."""
    totals = rel.popular_products(src.line_items(spark, sf_dir), src.products(spark, sf_dir))
    return totals.orderBy(F.desc("TotalQuantity"))


@query("""SELECT DISTINCT p_type AS "ProductCategory" FROM part""")
def distinct_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The category list a user picks from."""
    return src.products(spark, sf_dir).select("ProductCategory").distinct()
