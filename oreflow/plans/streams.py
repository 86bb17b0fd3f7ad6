"""Streaming queries. Each runs its stream over all input, then returns what the sink holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from oreflow.functions.time import plain
from oreflow.operators.versioned import VersionedTable
from oreflow.plans.features import rounded
from oreflow.plans.scans import landed_activity
from oreflow.registry import query
from oreflow.session import scratch
from oreflow.sources import files
from oreflow.sources import tables as src
from oreflow.streaming import aggregates as agg
from oreflow.streaming import runner
from oreflow.streaming.multihop import MultiHop

# The windows and the lateness the event-time queries are defined with.
HOUR, MINUTE, LATENESS, SLIDE = "1 hour", "1 minute", "2 hours", "15 minutes"

COUNTS_SQL = """SELECT date_trunc('hour', ts) AS start, event_type AS action, COUNT(*) AS "count" FROM events GROUP BY 1, 2"""
MINUTES_SQL = f"""WITH {src.READINGS_SQL}, minutes AS (SELECT device_type, device_operational_status,
  date_trunc('minute', reading_time) AS window_start,
  date_trunc('minute', reading_time) + INTERVAL '1 minute' AS window_end,
  ROUND(AVG(reading_1), 6) AS avg_reading_1 FROM readings GROUP BY 1, 2, 3, 4) """


def event_stream(spark: SparkSession, sf_dir: str, path: str | None = None, max_files: int | None = None) -> DataFrame:
    """Stream of the events table, or of a landing folder with the same columns.

    The table may be one file or a folder of files; a pattern, even one that only matches its name, lets the source
    take either.
    """
    schema = src.table(spark, sf_dir, "events").schema
    return runner.read_stream(spark, path or f"{sf_dir}/events.parque[t]", schema, max_files=max_files)


def timed_actions(events: DataFrame) -> DataFrame:
    return events.select(F.col("ts").cast("timestamp").alias("time"), F.col("event_type").alias("action"))


def _counts_out(counts: DataFrame) -> DataFrame:
    return counts.withColumn("start", plain("start"))


def _minutes_out(averages: DataFrame) -> DataFrame:
    return rounded(averages, "avg_reading_1").withColumns({c: plain(c) for c in ("window_start", "window_end")})


@query("SELECT ts AS time, event_type AS action FROM events")
def stream_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity stream from JSON files, a bounded number per trigger, projected to event time and action."""
    stream = runner.read_stream(spark, landed_activity(spark, sf_dir), files.ACTIVITY_SCHEMA, "json", max_files=1000)
    out = scratch(spark, "projected")
    runner.append_to_files(agg.actions(stream), out, scratch(spark, "checkpoint"))
    return spark.read.parquet(out).withColumn("time", plain("time"))


@query(f"WITH {src.READINGS_SQL} SELECT * FROM readings")
def stream_sink_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream of a table into a folder of files, exactly once."""
    out, checkpoint = scratch(spark, "sink"), scratch(spark, "checkpoint")
    for _ in range(2):  # the second run starts from the checkpoint and finds nothing new
        runner.append_to_files(src.readings_of(event_stream(spark, sf_dir)), out, checkpoint)
    return spark.read.parquet(out).withColumn("reading_time", plain("reading_time"))


@query(f"""WITH {src.READINGS_SQL} SELECT device_type, device_operational_status, ROUND(AVG(reading_1), 6) AS avg_reading_1
          FROM readings GROUP BY 1, 2""")
def stream_avg_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running average per device type and status, whole result per batch."""
    averages = agg.status_average(src.readings_of(event_stream(spark, sf_dir)))
    result = runner.complete_to_files(averages, scratch(spark, "averages"), scratch(spark, "checkpoint"))
    return rounded(result, "avg_reading_1")


@query(COUNTS_SQL + " ORDER BY 1, 2")
def windowed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actions per hour on the table itself: the batch twin of the streams below."""
    counts = agg.action_counts(timed_actions(src.table(spark, sf_dir, "events")), HOUR)
    return _counts_out(agg.in_time_order(counts))


@query(COUNTS_SQL)
def stream_tumbling_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actions per hour, sorted, whole result per batch."""
    counts = agg.in_time_order(agg.action_counts(timed_actions(event_stream(spark, sf_dir)), HOUR))
    return _counts_out(runner.complete_to_files(counts, scratch(spark, "counts"), scratch(spark, "checkpoint")))


@query("""SELECT time_bucket(INTERVAL '15 minutes', ts) - o * INTERVAL '15 minutes' AS start, event_type AS action,
          COUNT(*) AS "count" FROM events, (SELECT UNNEST([0, 1, 2, 3]) AS o) GROUP BY 1, 2""")
def sliding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actions per hour in windows that start every quarter of an hour."""
    counts = agg.action_counts(timed_actions(event_stream(spark, sf_dir)), HOUR, SLIDE)
    return _counts_out(runner.complete_to_files(counts, scratch(spark, "sliding"), scratch(spark, "checkpoint")))


@query(MINUTES_SQL + "SELECT * FROM minutes")
def stream_tumbling_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average reading per minute, device type and status, whole result per batch."""
    averages = agg.windowed_status_average(src.readings_of(event_stream(spark, sf_dir)), MINUTE)
    return _minutes_out(runner.complete_to_files(averages, scratch(spark, "minutes"), scratch(spark, "checkpoint")))


@query(COUNTS_SQL.replace("FROM events", "FROM events, (SELECT MAX(ts) AS last FROM events)")
       + ", last HAVING date_trunc('hour', ts) + INTERVAL '1 hour' <= last - INTERVAL '2 hours'")
def stream_watermark_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actions per hour with two hours of lateness: windows reach the sink once they are closed."""
    counts = agg.action_counts(timed_actions(event_stream(spark, sf_dir)), HOUR, late=LATENESS)
    out = scratch(spark, "closed")
    runner.append_to_files(counts, out, scratch(spark, "checkpoint"))
    return _counts_out(spark.read.parquet(out))


@query(MINUTES_SQL + """SELECT * FROM minutes WHERE window_end <=
          (SELECT MAX(reading_time) FROM readings) - INTERVAL '2 hours'""")
def stream_watermark_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed one-minute averages in an append sink, fed in three arrivals, the stream restarted after each."""
    landing, out, checkpoint = scratch(spark, "feed"), scratch(spark, "closed"), scratch(spark, "checkpoint")
    events = src.table(spark, sf_dir, "events")
    for condition in ARRIVALS:
        files.land(events.filter(condition), landing, "parquet")
        readings = src.readings_of(event_stream(spark, sf_dir, landing))
        runner.append_to_files(agg.windowed_status_average(readings, MINUTE, LATENESS), out, checkpoint)
    return _minutes_out(spark.read.parquet(out))


# How the events reach the streams that are fed in steps: three spans of time, one after the other.
ARRIVALS = (
    "ts < timestamp_ntz'2024-01-11'",
    "ts >= timestamp_ntz'2024-01-11' AND ts < timestamp_ntz'2024-01-21'",
    "ts >= timestamp_ntz'2024-01-21' OR ts IS NULL",
)
# The same, but errors of the first span are reported only with the second one.
LATE_ARRIVALS = (
    "ts < timestamp_ntz'2024-01-11' AND event_type <> 'error'",
    "ts < timestamp_ntz'2024-01-21' AND (ts >= timestamp_ntz'2024-01-11' OR event_type = 'error')",
    "ts >= timestamp_ntz'2024-01-21' OR ts IS NULL",
)


@query("""WITH arrived AS (SELECT ts, event_type, date_trunc('hour', ts) AS start,
            ts < TIMESTAMP '2024-01-11' AND event_type = 'error' AS late FROM events),
          marks AS (SELECT MAX(ts) FILTER (WHERE ts < TIMESTAMP '2024-01-11' AND event_type <> 'error')
            - INTERVAL '2 hours' AS first, MAX(ts) - INTERVAL '2 hours' AS last FROM events)
          SELECT start, event_type AS action, COUNT(*) AS "count" FROM arrived, marks
          WHERE NOT (late AND start + INTERVAL '1 hour' <= first) AND start + INTERVAL '1 hour' <= last
          GROUP BY 1, 2""")
def late_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that arrive after their window was closed are dropped, later ones within the limit are not."""
    landing, out, checkpoint = scratch(spark, "feed"), scratch(spark, "closed"), scratch(spark, "checkpoint")
    events = src.table(spark, sf_dir, "events")
    for condition in LATE_ARRIVALS:
        files.land(events.filter(condition), landing, "parquet")
        counts = agg.action_counts(timed_actions(event_stream(spark, sf_dir, landing)), HOUR, late=LATENESS)
        runner.append_to_files(counts, out, checkpoint)
    return _counts_out(spark.read.parquet(out))


@query("""WITH arrived AS (SELECT ts, event_type, CASE WHEN ts < TIMESTAMP '2024-01-11' AND event_type <> 'error' THEN 1
            WHEN ts < TIMESTAMP '2024-01-21' THEN 2 ELSE 3 END AS arrival, date_trunc('hour', ts) + INTERVAL '1 hour' AS closes FROM events),
          marks AS (SELECT MAX(ts) - INTERVAL '2 hours' AS closed FROM arrived WHERE arrival = 1)
          SELECT arrival, COUNT(*) AS input_rows,
            COUNT(DISTINCT CASE WHEN arrival = 2 AND ts < TIMESTAMP '2024-01-11' AND closes <= closed THEN closes END) AS dropped_groups
          FROM arrived, marks GROUP BY 1""")
def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stream's handle recorded of the arrivals of ``late_data``: rows read, and windows the watermark refused."""
    landing, out, checkpoint = scratch(spark, "feed"), scratch(spark, "closed"), scratch(spark, "checkpoint")
    events, log = src.table(spark, sf_dir, "events"), scratch(spark, "progress")
    for condition in LATE_ARRIVALS:
        files.land(events.filter(condition), landing, "parquet")
        counts = agg.action_counts(timed_actions(event_stream(spark, sf_dir, landing)), HOUR, late=LATENESS)
        runner.append_to_files(counts, out, checkpoint, log=log)
    runs = spark.read.schema(runner.PROGRESS_SCHEMA).parquet(log).groupBy("run").agg(
        F.min("batch").alias("first"), F.sum("input_rows").alias("input_rows"), F.sum("dropped_rows").alias("dropped_groups")
    )
    return runs.select(F.row_number().over(Window.orderBy("first")).alias("arrival"), "input_rows", "dropped_groups")


@query("""SELECT CAST(user_id AS VARCHAR) AS device_id, COUNT(*) AS n, MAX(ts) AS last_seen FROM events GROUP BY 1""")
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per device kept in a versioned table: each batch merges the devices it changed."""
    landing, checkpoint = scratch(spark, "feed"), scratch(spark, "checkpoint")
    events = src.table(spark, sf_dir, "events")

    def per_device(rows: DataFrame) -> DataFrame:
        readings = src.readings_of(rows)
        return readings.groupBy("device_id").agg(F.count("*").alias("n"), F.max("reading_time").alias("last_seen"))

    empty = spark.createDataFrame([], per_device(events).schema)
    table = VersionedTable.create(spark, scratch(spark, "devices"), empty)
    for condition in ARRIVALS:
        files.land(events.filter(condition), landing, "parquet")
        changed = per_device(event_stream(spark, sf_dir, landing))
        runner.upsert_to_table(changed, table, ["device_id"], checkpoint)
    return table.read().withColumn("last_seen", plain("last_seen"))


@query("""SELECT c_mktsegment AS segment, CAST(ts AS DATE) AS day, ROUND(AVG(value), 6) AS avg_value, COUNT(*) AS n
          FROM events LEFT JOIN customer ON c_custkey = user_id GROUP BY 1, 2""")
def multi_hop_daily_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw JSON lines parsed, joined to the device owner's segment and averaged per day, in chained streams."""
    source = scratch(spark, "recordings")
    events = src.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("device"),
        F.col("ts").cast("timestamp").alias("time"),
        "value",
    )
    micros = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    files.land(events, source, "json", timestampFormat=micros)
    owners = src.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("device"), F.col("c_mktsegment").alias("segment")
    )
    averages = MultiHop(spark, source, scratch(spark, "multihop")).run(owners)
    return rounded(averages, "avg_value")
