"""Reading tables and sharing small sides between jobs."""

from __future__ import annotations

import shutil
from pathlib import Path

from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.session import freeing, prepare, scratch

#: Keys that a join may broadcast, after they have been counted; a larger side is joined by shuffling.
BROADCAST_KEYS = 500_000


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Spark send this package to the Python workers of all executors; once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        package = Path(__file__).parents[1]
        target = Path(SparkFiles.getRootDirectory(), "packages", package.name)  # goes with the application
        target.parent.mkdir(exist_ok=True)
        context.addPyFile(shutil.make_archive(str(target), "zip", package.parent, package.name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it again: cuts the lineage, computes once."""
    spark = df.sparkSession
    path = scratch(spark, name)
    with freeing(spark):
        df.write.parquet(path, compression=compression)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def small(keys: DataFrame, limit: int = BROADCAST_KEYS) -> DataFrame:
    """Mark a stored table for broadcasting if it has at most ``limit`` rows; else leave the join to a shuffle."""
    few = keys.limit(limit + 1).count() <= limit
    return F.broadcast(keys) if few else keys


def discard(table: DataFrame) -> None:
    """Delete the files of a stored table that nothing will read again."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table.stored_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
