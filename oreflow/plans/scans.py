"""Reading and landing files: text, JSON, CSV, tables in SQL, incremental ingestion."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.functions.time import plain
from oreflow.operators import relational as rel
from oreflow.operators.versioned import VersionedTable
from oreflow.registry import query
from oreflow.session import scratch
from oreflow.sources import files
from oreflow.sources import orders as nested
from oreflow.sources import tables as src

# The share and the seed the historical readings are sampled with.
SAMPLE_FRACTION, SAMPLE_SEED = 0.05, 42


def activity_rows(events: DataFrame) -> DataFrame:
    """Events in the layout of the device activity feed (times in milli- and nanoseconds)."""
    k = F.get_json_object("props", "$.k").cast("int")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    return events.select(
        F.expr("unix_micros(cast(ts AS timestamp)) div 1000").alias("Arrival_Time"),
        (micros * 1000).alias("Creation_Time"),
        F.concat(F.lit("device_"), F.col("user_id").cast("string")).alias("Device"),
        F.col("event_id").alias("Index"),
        F.concat(F.lit("model_"), (k % 4).cast("string")).alias("Model"),
        F.col("user_id").cast("string").alias("User"),
        F.struct(
            F.concat(F.lit("city_"), (k % 10).cast("string")).alias("city"),
            F.concat(F.lit("country_"), (k % 5).cast("string")).alias("country"),
        ).alias("geolocation"),
        F.col("event_type").alias("gt"),
        F.col("event_id").alias("id"),
        F.col("value").alias("x"),
        k.cast("double").alias("y"),
        (F.col("value") * k / 100).alias("z"),
    )


def landed_activity(spark: SparkSession, sf_dir: str) -> str:
    folder = scratch(spark, "activity")
    files.land(activity_rows(src.table(spark, sf_dir, "events")), folder, "json")
    return folder


@query("""SELECT line AS value, COUNT(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
          GROUP BY 1""")
def scan_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents written as text files and read back, one row per line; lines counted."""
    folder = scratch(spark, "text")
    files.land(src.table(spark, sf_dir, "documents").select("text"), folder, "text", lineSep="\n")
    return files.read_text(spark, folder).groupBy("value").agg(F.count("*").alias("n"))


@query("""SELECT o_orderkey AS order_number, p.unit, SUM(p.qty) AS quantity, COUNT(*) AS n
          FROM orders JOIN (SELECT l_orderkey, l_linestatus AS unit, l_quantity AS qty FROM lineitem) p
          ON l_orderkey = o_orderkey GROUP BY 1, 2""")
def scan_json_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested order documents written as JSON and read back with the schema found in the files."""
    folder = scratch(spark, "orders-json")
    files.land(nested.order_documents(spark, sf_dir), folder, "json")
    products = files.read_json(spark, folder).select("order_number", F.explode("ordered_products").alias("p"))
    return products.groupBy("order_number", F.col("p.unit").alias("unit")).agg(
        F.sum("p.qty").alias("quantity"), F.count("*").alias("n")
    )


@query("""SELECT event_id AS id, event_type AS gt, CAST(user_id AS VARCHAR) AS "User",
          'city_' || CAST(CAST(regexp_extract(props, '[0-9]+') AS INT) % 10 AS VARCHAR) AS city,
          'country_' || CAST(CAST(regexp_extract(props, '[0-9]+') AS INT) % 5 AS VARCHAR) AS country,
          epoch_us(ts) * 1000 AS "Creation_Time", value AS x FROM events""")
def scan_json_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity rows read from JSON with a declared schema; only the wanted fields are parsed."""
    rows = files.read_json(spark, landed_activity(spark, sf_dir), files.ACTIVITY_SCHEMA)
    return rows.select("id", "gt", "User", "geolocation.city", "geolocation.country", "Creation_Time", "x")


@query("""SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_type AS product_category, p_name AS product_name,
          p_brand AS product_unit, CAST(p_retailprice AS DECIMAL(10,2)) AS sales_price FROM part""")
def scan_csv_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product list as a view over semicolon-separated text, all columns strings, price cast after."""
    folder = scratch(spark, "products-csv")
    files.land(src.bronze_products(spark, sf_dir), folder, "csv", header="true", delimiter=";")
    files.csv_view(spark, "product_bronze", folder)
    return spark.sql(
        "SELECT product_id, product_category, product_name, product_unit, "
        "CAST(sales_price AS DECIMAL(10,2)) AS sales_price FROM product_bronze"
    )


@query(f"WITH {src.READINGS_SQL} SELECT * FROM readings")
def scan_csv_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor readings read from CSV with inferred types."""
    folder = scratch(spark, "readings-csv")
    micros = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    files.land(src.sensor_readings(spark, sf_dir), folder, "csv", header="true", timestampFormat=micros)
    rows = files.read_csv(spark, folder, infer=True)
    return rows.select(
        F.col("id").cast("bigint").alias("id"),
        plain("reading_time").alias("reading_time"),
        "device_type",
        F.col("device_id").cast("string").alias("device_id"),
        "device_operational_status",
        *[F.col(c).cast("double").alias(c) for c in ("reading_1", "reading_2", "reading_3")],
    )


@query("""SELECT p_partkey AS id, p_type AS category FROM part WHERE p_size > 10""")
def scan_path_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL straight over files named by path."""
    return spark.sql(
        f"SELECT p_partkey AS id, p_type AS category FROM parquet.`{sf_dir}/part.parquet` WHERE p_size > 10"
    )


def _name(spark: SparkSession, prefix: str) -> tuple[str, str]:
    """A new folder, and a table name made of its unique part."""
    folder = scratch(spark, prefix)
    return f"{prefix}_{folder.rsplit('-', 1)[1]}", folder


@query(f"""WITH {src.READINGS_SQL} SELECT * FROM readings""")
def insert_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table with declared columns filled by INSERT ... SELECT, one insert per device type."""
    table, folder = _name(spark, "readings")
    spark.sql(
        f"CREATE TABLE {table} (id BIGINT, reading_time TIMESTAMP, device_type STRING, device_id STRING, "
        "device_operational_status STRING, reading_1 DOUBLE, reading_2 DOUBLE, reading_3 DOUBLE) "
        f"USING parquet LOCATION '{folder}'"
    )
    src.sensor_readings(spark, sf_dir).createOrReplaceTempView("current_readings")
    for kind in ("Transformer", "Rectifier"):
        spark.sql(f"INSERT INTO {table} SELECT * FROM current_readings WHERE device_type = '{kind}'")
    return spark.table(table).withColumn("reading_time", plain("reading_time"))


@query("""SELECT event_type AS gt, COUNT(*) AS n FROM events GROUP BY 1""")
def external_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table declared over files that are already there, its columns taken from them."""
    table, folder = _name(spark, "activity")
    files.land(activity_rows(src.table(spark, sf_dir, "events")), folder, "parquet")
    spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{folder}'")
    return spark.sql(f"SELECT gt, COUNT(*) AS n FROM {table} GROUP BY gt")


@query("""SELECT p_partkey AS id, p_type AS category FROM part""")
def create_as_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CREATE TABLE IF NOT EXISTS ... AS SELECT, run twice: the second run finds the table and does nothing."""
    table, folder = _name(spark, "products")
    src.table(spark, sf_dir, "part").createOrReplaceTempView("part_rows")
    for _ in range(2):
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} USING parquet LOCATION '{folder}' AS "
            "SELECT p_partkey AS id, p_type AS category FROM part_rows"
        )
    return spark.table(table)


@query(f"""WITH {src.READINGS_SQL} SELECT id, reading_time, device_type, device_id, reading_1, reading_2, reading_3
          FROM readings""")
def unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor readings without the label."""
    rows = src.sensor_readings(spark, sf_dir).drop("device_operational_status")
    return rows.withColumn("reading_time", plain("reading_time"))


@query(f"""WITH {src.READINGS_SQL} SELECT id, device_id, reading_1 FROM readings
          WHERE substr(md5('{SAMPLE_SEED}:' || CAST(id AS VARCHAR)), 1, 8)
            < printf('%08x', CAST(floor({SAMPLE_FRACTION} * 4294967296) AS BIGINT))""")
def sample_seeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeded sample of the readings that does not depend on partitioning."""
    sampled = rel.hash_sample(src.sensor_readings(spark, sf_dir), "id", SAMPLE_FRACTION, SAMPLE_SEED)
    return sampled.select("id", "device_id", "reading_1")


def _mac_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.table(spark, sf_dir, "events").select(
        F.unix_micros(F.col("ts").cast("timestamp")).alias("seen_us"),
        F.col("user_id").alias("gym"),
        F.concat(F.lit("mac-"), F.col("event_id").cast("string")).alias("mac"),
        "ts",
    )


def _rows_by_version(table: VersionedTable) -> DataFrame:
    counts = [
        table.read(v).agg(F.count("*").alias("n")).withColumn("version", F.lit(v))
        for v in range(1, table.latest().version + 1)
    ]
    return functools.reduce(DataFrame.unionByName, counts)


@query("""SELECT version, COUNT(*) AS n FROM (SELECT UNNEST(CASE WHEN ts < TIMESTAMP '2024-01-15'
            THEN [1, 2, 3] WHEN ts < TIMESTAMP '2024-01-22' THEN [2, 3] ELSE [3] END) AS version FROM events)
          GROUP BY 1""")
def ingest_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily ingestion: after each arrival only the new files are loaded, each load a table version.

    The schema of one file is declared for the whole feed. A last run without new files adds nothing.
    """
    source, checkpoint = scratch(spark, "mac-logs"), scratch(spark, "mac-logs-checkpoint")
    logs = _mac_logs(spark, sf_dir)
    # rows without a time come with the last arrival
    first, second = "timestamp_ntz'2024-01-15'", "timestamp_ntz'2024-01-22'"
    arrivals = [f"ts < {first}", f"ts >= {first} AND ts < {second}", f"ts >= {second} OR ts IS NULL"]
    table = None
    for condition in arrivals:
        files.land(logs.filter(condition).drop("ts"), source, "json")
        if table is None:
            schema = files.schema_of_one_file(spark, source)
            table = VersionedTable.create(spark, scratch(spark, "mac-table"), spark.createDataFrame([], schema))
        files.ingest_files_to_table(spark, source, table, checkpoint, schema)
    files.ingest_files_to_table(spark, source, table, checkpoint, schema)
    return _rows_by_version(table)


@query("""SELECT version, CAST(COUNT(*) AS BIGINT) AS n FROM (SELECT UNNEST(CASE WHEN ts < TIMESTAMP '2024-01-15'
            THEN [1, 2, 2, 3, 3] ELSE [2, 3] END) AS version FROM events) GROUP BY 1
          ORDER BY version""")
def ingest_new_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed read again from its beginning by a new checkpoint: all its files are loaded once more.

    Running the new checkpoint again adds nothing, shown by the newest version under the number 3.
    """
    source = scratch(spark, "mac-logs")
    logs = _mac_logs(spark, sf_dir)
    early = "ts < timestamp_ntz'2024-01-15'"
    files.land(logs.filter(early).drop("ts"), source, "json")
    schema = files.schema_of_one_file(spark, source)
    table = VersionedTable.create(spark, scratch(spark, "mac-table"), spark.createDataFrame([], schema))
    files.ingest_files_to_table(spark, source, table, scratch(spark, "first-checkpoint"), schema)
    files.land(logs.filter(f"NOT coalesce({early}, false)").drop("ts"), source, "json")
    again = scratch(spark, "second-checkpoint")
    for _ in range(2):
        files.ingest_files_to_table(spark, source, table, again, schema)
    newest = table.read().agg(F.count("*").alias("n")).withColumn("version", F.lit(3))
    return _rows_by_version(table).unionByName(newest)
