"""File readers and incremental file ingestion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from oreflow.streaming.runner import append_to_files, append_to_table, read_stream
from oreflow.operators.versioned import VersionedTable
from oreflow.session import freeing

# Declared schema of the device activity feed (fixed by the feed).
ACTIVITY_SCHEMA = (
    "Arrival_Time BIGINT, Creation_Time BIGINT, Device STRING, Index BIGINT, Model STRING, User STRING, "
    "geolocation STRUCT<city: STRING, country: STRING>, gt STRING, id BIGINT, x DOUBLE, y DOUBLE, z DOUBLE"
)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per line; only the newline character ends a line."""
    return spark.read.option("lineSep", "\n").text(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON lines. Without a schema all files are read once more to infer it; declare one for large data."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_csv(spark: SparkSession, path: str, delimiter: str = ",", infer: bool = False) -> DataFrame:
    """CSV with a header; every column a string unless ``infer``."""
    return (
        spark.read.option("header", "true")
        .option("delimiter", delimiter)
        .option("inferSchema", str(infer).lower())
        .csv(path)
    )


def csv_view(spark: SparkSession, name: str, path: str, delimiter: str = ";") -> DataFrame:
    """Temporary view over CSV files with a header, every column a string."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY VIEW {name} USING csv "
        f"OPTIONS (path '{path}', delimiter '{delimiter}', header 'true')"
    )
    return spark.table(name)


def schema_of_one_file(spark: SparkSession, path: str, fmt: str = "json") -> T.StructType:
    """Schema of a single file of a feed, to declare it for the whole feed without reading all of it."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    first = files.filter("length > 0").orderBy("path").first()
    if first is None:
        raise FileNotFoundError(f"no file to sample in {path}")
    return spark.read.format(fmt).load(first.path).schema


def land(rows: DataFrame, path: str, fmt: str = "json", **options: str) -> None:
    """Add files to a landing folder."""
    with freeing(rows.sparkSession):
        rows.write.mode("append").format(fmt).options(**options).save(path)


def ingest_files(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema: T.StructType | str,
    fmt: str = "json",
    max_files: int | None = None,
) -> DataFrame:
    """Load the files of a folder that no earlier call with this checkpoint has loaded, and append them."""
    append_to_files(read_stream(spark, source, schema, fmt, max_files), target, checkpoint)
    return spark.read.parquet(target)


def ingest_files_to_table(
    spark: SparkSession,
    source: str,
    table: VersionedTable,
    checkpoint: str,
    schema: T.StructType | str,
    fmt: str = "json",
    max_files: int | None = None,
) -> None:
    """The same into a versioned table: every batch of new files becomes a version."""
    append_to_table(read_stream(spark, source, schema, fmt, max_files), table, checkpoint)
