"""Event-time aggregations; the same functions take a table or a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.functions.time import nanos_to_timestamp


def actions(activity: DataFrame) -> DataFrame:
    """Event time and action of device activity rows."""
    return activity.select(nanos_to_timestamp("Creation_Time").alias("time"), F.col("gt").alias("action"))


def action_counts(events: DataFrame, width: str = "1 hour", slide: str | None = None, late: str | None = None) -> DataFrame:
    """Rows per action and window, tumbling or (with ``slide``) sliding.

    ``late`` bounds the state of a stream: rows later than that behind the newest event are dropped.
    """
    if late:
        events = events.withWatermark("time", late)
    return (
        events.groupBy("action", F.window("time", width, slide).alias("window"))
        .agg(F.count("*").alias("count"))
        .select(F.col("window.start").alias("start"), "action", "count")
    )


def in_time_order(counts: DataFrame) -> DataFrame:
    """Sorted by window; on a stream allowed in complete mode only."""
    return counts.orderBy("start", "action")


def status_average(readings: DataFrame) -> DataFrame:
    return readings.groupBy("device_type", "device_operational_status").agg(
        F.avg("reading_1").alias("avg_reading_1")
    )


def windowed_status_average(readings: DataFrame, width: str = "1 minute", late: str | None = None) -> DataFrame:
    if late:
        readings = readings.withWatermark("reading_time", late)
    return (
        readings.groupBy("device_type", "device_operational_status", F.window("reading_time", width).alias("window"))
        .agg(F.avg("reading_1").alias("avg_reading_1"))
        .select(
            "device_type",
            "device_operational_status",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "avg_reading_1",
        )
    )
