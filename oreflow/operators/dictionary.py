"""Numbers for the values of a column, without a list of them on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oreflow.session import scratch


def number_values(rows: DataFrame, column: str, path: str | None = None) -> DataFrame:
    """(value, index) of the distinct non-null values, numbered from 0 in their order; written to ``path``.

    Values are dealt by ranges. A value's number is its place in its range plus the values in ranges before; only
    the ranges' counts, one row each, meet in a window. Values are text, in the order of their UTF-8 bytes.
    """
    spark = rows.sparkSession
    values = rows.select(F.col(column).cast("string").alias("value")).where("value IS NOT NULL").distinct()
    sorted_values = values.repartitionByRange("value").sortWithinPartitions("value")
    ranged = scratch(spark, "ranged")
    sorted_values.withColumn("_at", F.monotonically_increasing_id()).write.parquet(ranged)
    ranged_values = spark.read.schema("value STRING, _at BIGINT").parquet(ranged)
    part = F.shiftright("_at", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged_values.groupBy(part.alias("_part")).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    starts = counts.select("_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    numbered = ranged_values.withColumn("_part", part).join(starts, "_part")
    path = path or scratch(spark, "dictionary")
    numbered.select("value", (F.col("_at") + F.col("_shift")).alias("index")).write.parquet(path)
    return spark.read.schema("value STRING, index BIGINT").parquet(path)


def looked_up(rows: DataFrame, column: str, dictionary: DataFrame, index: str) -> DataFrame:
    """Rows with the number of their value in ``index``; NULL for a NULL or unknown value. No row is lost or repeated."""
    entries = dictionary.select(F.col("value").alias("_value"), F.col("index").alias(index))
    return rows.join(entries, F.col(column).cast("string") == F.col("_value"), "left").drop("_value")
