"""The silver order-line table through its versions: update, delete, upsert, evolution, recovery, clones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.operators import relational as rel
from oreflow.operators.schemas import SchemaMismatch
from oreflow.operators.versioned import VersionedTable
from oreflow.plans.sales import NESTED_LINES_SQL
from oreflow.registry import query
from oreflow.session import drop, scratch
from oreflow.sources import files
from oreflow.sources import orders as nested
from oreflow.sources import tables as src

# The stand-in for a missing order time, and the four columns an order line is matched by.
NO_DATE = "1900-01-01"
LINE_KEY = ["CustomerID", "ProductID", "OrderDateTime", "LineNo"]

BY_YEAR = "substring(OrderDateTime, 1, 4)"
TIE_BREAK = ["OrderNo", "Price", "Quantity", "UnitOfMeasure"]

COLUMNS = (
    '"CustomerID", "ProductID", "OrderDateTime", "OrderNo", "LineNo", "CurrencyCode", "Price", "Quantity", '
    '"OrderAmount", "UnitOfMeasure"'
)
MATCH = " AND ".join(f't."{k}" = s."{k}"' for k in LINE_KEY)
TAKEN = ", ".join(
    f'CASE WHEN s."OrderNo" IS NULL THEN t.{c} ELSE s.{c} END AS {c}' for c in COLUMNS.split(", ")
)
STEPS = f"""updated AS (SELECT * REPLACE (COALESCE("OrderDateTime", '{NO_DATE}') AS "OrderDateTime") FROM lines),
deleted AS (SELECT * FROM updated WHERE NOT COALESCE(("OrderDateTime" = '{NO_DATE}' AND "LineNo" = 2)
  OR ("OrderDateTime" >= '2001-07-01' AND "LineNo" = 3), FALSE)),
newer AS (SELECT {COLUMNS} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY "CustomerID", "ProductID",
  "OrderDateTime", "LineNo" ORDER BY "OrderNo", "Price", "Quantity", "UnitOfMeasure") AS r FROM lines) WHERE r = 1),
merged AS (SELECT {TAKEN} FROM deleted t LEFT JOIN newer s ON {MATCH}
  UNION ALL SELECT {COLUMNS} FROM newer s WHERE NOT EXISTS (SELECT 1 FROM deleted t WHERE {MATCH})),
evolved AS (SELECT *, "Price" / NULLIF("Quantity", 0) AS "UnitPrice" FROM merged) """
STEPS_SQL = f"WITH {src.LINES_SQL}, {STEPS}"


def _create(spark: SparkSession, sf_dir: str) -> VersionedTable:
    return VersionedTable.create(spark, scratch(spark, "silver"), src.sales_lines(spark, sf_dir), BY_YEAR, gather=False)


def _update(table: VersionedTable) -> None:
    table.update({"OrderDateTime": NO_DATE}, F.col("OrderDateTime").isNull())


def _delete(table: VersionedTable) -> None:
    undated = (F.col("OrderDateTime") == NO_DATE) & (F.col("LineNo") == 2)
    last = (F.col("OrderDateTime") >= "2001-07-01") & (F.col("LineNo") == 3)
    table.delete(undated | last)


def _merge(table: VersionedTable) -> None:
    """Upsert of the lines that the table began with, one per key."""
    table.merge(rel.keep_first(table.read(version=0), LINE_KEY, TIE_BREAK), LINE_KEY)


def _evolve(table: VersionedTable) -> None:
    priced = table.read().withColumn("UnitPrice", F.try_divide("Price", "Quantity"))
    table.overwrite(priced, merge_schema=True, gather=False)


def lifecycle(spark: SparkSession, sf_dir: str, steps: int = 5) -> VersionedTable:
    """The table after its first ``steps`` commits: create, update, delete, merge, evolve."""
    return _steps(_create(spark, sf_dir), steps)


def _steps(table: VersionedTable, steps: int) -> VersionedTable:
    for step in (_update, _delete, _merge, _evolve)[: steps - 1]:
        step(table)
    return table


@query(
    STEPS_SQL
    + """SELECT 0 AS version, 'CREATE TABLE AS SELECT' AS operation, COUNT(*) AS n FROM lines
    UNION ALL SELECT 1, 'UPDATE', COUNT(*) FROM updated UNION ALL SELECT 2, 'DELETE', COUNT(*) FROM deleted
    UNION ALL SELECT 3, 'MERGE', COUNT(*) FROM merged UNION ALL SELECT 4, 'WRITE', COUNT(*) FROM evolved"""
)
def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commits of the whole silver pipeline with the rows each version holds."""
    table = lifecycle(spark, sf_dir)
    counts = None
    for v in range(table.latest().version + 1):
        n = table.read(v).agg(F.count("*").alias("n")).withColumn("version", F.lit(v).cast("bigint"))
        counts = n if counts is None else counts.unionByName(n)
    return table.history().select("version", "operation").join(counts, "version")


@query(STEPS_SQL + "SELECT * FROM lines")
def version_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version 0 read after later versions were written."""
    return lifecycle(spark, sf_dir, 3).read(version=0)


@query(STEPS_SQL + "SELECT * FROM updated")
def timestamp_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The version that was current at the time of the second commit."""
    table = lifecycle(spark, sf_dir, 3)
    return table.read(timestamp=table.at(1).committed_at)


@query(STEPS_SQL + "SELECT * FROM updated")
def update_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing order times set to a fixed date; only the undated segment is rewritten."""
    return lifecycle(spark, sf_dir, 2).read()


@query(STEPS_SQL + "SELECT * FROM deleted")
def delete_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that meet an OR of ANDs removed."""
    return lifecycle(spark, sf_dir, 3).read()


@query(STEPS_SQL + "SELECT * FROM merged")
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated order lines merged by four columns; lines without order time match nothing."""
    return lifecycle(spark, sf_dir, 4).read()


@query(STEPS_SQL + "SELECT * FROM evolved")
def schema_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column added by an overwrite that may extend the table."""
    return lifecycle(spark, sf_dir, 5).read()


@query(f"""WITH {src.LINES_SQL}, n AS (SELECT COUNT(*) AS rows_left FROM lines)
    SELECT attempt, reason, 0::BIGINT AS version, rows_left FROM n, (VALUES
      ('overwrite with a new column', 'UnitPrice is not in the table'),
      ('append of text for a number', 'Quantity is string, not double'),
      ('append of both', 'Quantity is string, not double; UnitPrice is not in the table')) AS a(attempt, reason)""")
def schema_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes that do not fit the table fail, say why, and leave it as it was."""
    table = _create(spark, sf_dir)
    priced = table.read().withColumn("UnitPrice", F.try_divide("Price", "Quantity"))
    text = {"Quantity": F.col("Quantity").cast("string")}
    attempts = {
        "overwrite with a new column": lambda: table.overwrite(priced),
        "append of text for a number": lambda: table.append(table.read().withColumns(text)),
        "append of both": lambda: table.append(priced.withColumns(text)),
    }
    refused = []
    for name, write in attempts.items():
        try:
            write()
        except SchemaMismatch as e:
            refused.append((name, str(e)))
    left = [(*r, table.latest().version, table.read().count()) for r in refused]
    return spark.createDataFrame(left, "attempt STRING, reason STRING, version BIGINT, rows_left BIGINT")


@query("""SELECT o_orderkey AS order_number, l_partkey AS id, CAST(l_quantity AS BIGINT) AS qty,
      CASE WHEN o_orderkey % 2 = 1 THEN l_suppkey END AS supplier,
      CASE WHEN o_orderkey % 2 = 1 THEN l_linestatus END AS unit_code, o_orderkey % 2 = 1 AS newer
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def schema_evolve_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose products have a new field, a new struct and wider quantities, appended to older ones: the old
    documents are not rewritten and read with NULL for what they lack.
    """
    documents = nested.order_documents(spark, sf_dir).select("order_number", "ordered_products")
    narrow = lambda p: F.struct(p["id"].alias("id"), p["qty"].cast("int").alias("qty"))
    wide = lambda p: F.struct(
        p["id"].alias("id"), p["qty"].cast("bigint").alias("qty"), p["supplier"].alias("supplier"),
        F.struct(p["unit"].alias("code")).alias("unit"),
    )
    older, newer = F.col("order_number") % 2 == 0, F.col("order_number") % 2 == 1
    reshaped = lambda make: documents.withColumn("ordered_products", F.transform("ordered_products", make))
    table = VersionedTable.create(spark, scratch(spark, "documents"), reshaped(narrow).filter(older))
    table.append(reshaped(wide).filter(newer), merge_schema=True)
    products = table.read().select("order_number", F.explode("ordered_products").alias("p"))
    return products.select("order_number", "p.id", "p.qty", "p.supplier", F.col("p.unit.code").alias("unit_code"), newer.alias("newer"))


@query(STEPS_SQL + "SELECT * FROM lines")
def restore_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows deleted by mistake, then version 0 made current again."""
    table = _create(spark, sf_dir)
    table.delete()
    table.restore(0)
    return table.read()


@query(STEPS_SQL + "SELECT * FROM lines")
def clone_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full copy of version 0 of a table that has moved on."""
    return lifecycle(spark, sf_dir, 3).clone(scratch(spark, "deep"), version=0).read()


@query(
    STEPS_SQL
    + """SELECT 'source' AS side, * FROM updated
    UNION ALL SELECT 'clone', * FROM lines WHERE COALESCE("LineNo" <> 1, TRUE)"""
)
def clone_shallow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clone of version 0 without its data, then rows deleted in the clone: the source keeps them."""
    table = lifecycle(spark, sf_dir, 2)
    clone = table.clone(scratch(spark, "shallow"), version=0, shallow=True)
    clone.delete(F.col("LineNo") == 1)
    sides = [t.read().withColumn("side", F.lit(name)) for name, t in (("source", table), ("clone", clone))]
    return sides[0].unionByName(sides[1])


@query(f"WITH {src.READINGS_SQL} SELECT * REPLACE (reading_1 * 0.97 AS reading_1) FROM readings")
def update_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading of every row scaled."""
    table = VersionedTable.create(spark, scratch(spark, "readings"), src.sensor_readings(spark, sf_dir))
    table.update({"reading_1": F.col("reading_1") * 0.97})
    return table.read().withColumn("reading_time", F.col("reading_time").cast("timestamp_ntz"))


@query(
    f"""WITH {src.READINGS_SQL} SELECT device_type, COUNT(*) AS n, MIN(id) AS first_id, MAX(id) AS last_id
    FROM readings GROUP BY 1"""
)
def append_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings inserted in one append per device type; earlier segments are not rewritten."""
    readings = src.sensor_readings(spark, sf_dir)
    rectifiers = readings.filter(F.col("device_type") == "Rectifier")
    table = VersionedTable.create(spark, scratch(spark, "appended"), rectifiers)
    table.append(readings.filter(F.col("device_type") == "Transformer"))
    return table.read().groupBy("device_type").agg(
        F.count("*").alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id")
    )


@query(
    f"""WITH lines AS ({NESTED_LINES_SQL}), {STEPS}
    SELECT p_type AS "ProductCategory", p_name AS "ProductName", c_name AS "CustomerName",
      CAST(date_trunc('month', CAST("OrderDateTime" AS TIMESTAMP)) AS DATE) AS "YearMonth",
      CAST(CAST(SUM(CAST("Quantity" AS DECIMAL(30,8))) AS DECIMAL(30,2)) AS DOUBLE) AS "Quantity",
      CAST(CAST(SUM(CAST("OrderAmount" AS DECIMAL(30,8))) AS DECIMAL(30,2)) AS DOUBLE) AS "OrderAmount"
    FROM evolved LEFT JOIN part ON p_partkey = "ProductID" LEFT JOIN customer ON c_custkey = "CustomerID"
    GROUP BY 1, 2, 3, 4"""
)
def sales_medallion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole sales pipeline: JSON and CSV files to bronze, changed silver versions, gold, monthly totals."""
    orders_json, products_csv = scratch(spark, "orders-json"), scratch(spark, "products-csv")
    files.land(nested.order_documents(spark, sf_dir), orders_json, "json", compression="gzip")
    files.land(src.bronze_products(spark, sf_dir), products_csv, "csv", header="true", delimiter=";")
    documents = files.read_json(spark, orders_json)
    bronze_table = VersionedTable.create(spark, scratch(spark, "bronze"), nested.bronze_orders(documents))
    drop(spark, orders_json)  # a level's files go once the next one holds their rows
    bronze = bronze_table.read()
    products = src.silver_products(files.csv_view(spark, "product_text", products_csv))
    customers = VersionedTable.create(spark, scratch(spark, "customers"), nested.silver_customers(bronze)).read()
    silver = VersionedTable.create(spark, scratch(spark, "silver"), nested.order_lines(bronze), BY_YEAR, gather=False)
    drop(spark, bronze_table.path)
    _steps(silver, 4)
    silver.vacuum()  # the merge was the last to read an older version
    _evolve(silver)
    silver.vacuum()
    return rel.monthly_sales(rel.gold_lines(silver.read(), rel.require_unique(customers, "CustomerID"), products))
