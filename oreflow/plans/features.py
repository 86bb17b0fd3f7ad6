"""Window features of sensor readings and the training set built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.functions.time import plain
from oreflow.operators import asof
from oreflow.operators import relational as rel
from oreflow.operators.versioned import VersionedTable
from oreflow.registry import query
from oreflow.session import scratch
from oreflow.sources import tables as src
from oreflow.streaming.aggregates import status_average

STATUS = "device_operational_status"
MEANS = ["mean_5m_reading_1", "mean_5m_reading_2", "mean_5m_reading_3"]

WINDOWS_SQL = f"""WITH {src.READINGS_SQL}, windows AS (
  SELECT device_id, time_bucket(INTERVAL '5 minutes', reading_time) AS window_start,
         time_bucket(INTERVAL '5 minutes', reading_time) + INTERVAL '5 minutes' AS window_end,
         AVG(reading_1) AS m1, AVG(reading_2) AS m2, AVG(reading_3) AS m3
  FROM readings GROUP BY 1, 2, 3)"""

FEATURES_SQL = WINDOWS_SQL + """, features AS (
  SELECT r.id, ROUND(w.m1, 6) AS mean_5m_reading_1, ROUND(w.m2, 6) AS mean_5m_reading_2,
         ROUND(w.m3, 6) AS mean_5m_reading_3
  FROM readings r ASOF JOIN windows w ON r.device_id = w.device_id AND r.reading_time >= w.window_end)"""

TRAINING_SQL = FEATURES_SQL + """, training AS (
  SELECT r.*, f.* EXCLUDE (id) FROM readings r JOIN features f ON r.id = f.id)"""


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def with_features(readings: DataFrame) -> DataFrame:
    """The training set made straight from the readings, without a feature table to look up in."""
    return asof.with_window_features(readings).filter(F.col(MEANS[0]).isNotNull())


def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_features(src.sensor_readings(spark, sf_dir))


@query(WINDOWS_SQL + """ SELECT device_id, window_start, window_end, ROUND(m1, 6) AS mean_5m_reading_1,
          ROUND(m2, 6) AS mean_5m_reading_2, ROUND(m3, 6) AS mean_5m_reading_3 FROM windows""")
def window_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean readings per device and five minutes."""
    means = rounded(asof.window_means(src.sensor_readings(spark, sf_dir)), *MEANS)
    return means.withColumns({c: plain(c) for c in ("window_start", "window_end")})


@query(FEATURES_SQL + " SELECT * FROM features")
def asof_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per reading, the means of its device's newest window closed by then."""
    return rounded(asof.window_features(src.sensor_readings(spark, sf_dir)), *MEANS)


@query(WINDOWS_SQL + """ SELECT id, window_end, ROUND(m1, 6) AS mean_5m_reading_1 FROM (
          SELECT r.id, w.window_end, w.m1, ROW_NUMBER() OVER (PARTITION BY r.id ORDER BY w.window_end DESC) AS rank
          FROM readings r JOIN windows w ON r.device_id = w.device_id AND r.reading_time >= w.window_end)
          WHERE rank = 1""")
def asof_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The range condition ``reading_time >= window end`` with the newest match, by the general as-of join."""
    readings = src.sensor_readings(spark, sf_dir)
    windows = asof.window_means(readings).withColumn("end", F.col("window_end"))
    joined = asof.asof_join(
        readings.select("id", "device_id", "reading_time"),
        windows,
        ["device_id"],
        "reading_time",
        "end",
        ["window_end", "mean_5m_reading_1"],
    )
    return rounded(joined, "mean_5m_reading_1").select("id", plain("window_end").alias("window_end"), "mean_5m_reading_1")


@query(f"""WITH {src.READINGS_SQL}, errors AS (SELECT 'plant' AS plant, reading_time AS error_time, MAX(reading_1) AS error_reading
            FROM readings WHERE device_operational_status = 'error' GROUP BY 2)
          SELECT id, error_time, error_reading FROM (SELECT 'plant' AS plant, id, reading_time FROM readings) r
          ASOF JOIN errors e ON r.plant = e.plant AND r.reading_time >= e.error_time""")
def asof_one_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per reading, the newest error of the whole plant: all rows have one key, which is spread over tasks."""
    readings = src.sensor_readings(spark, sf_dir).withColumn("plant", F.lit("plant"))
    errors = readings.filter(F.col(STATUS) == "error").groupBy("plant", F.col("reading_time").alias("error_time"))
    errors = errors.agg(F.max("reading_1").alias("error_reading"))
    rows = readings.select("plant", "id", "reading_time")
    joined = asof.asof_join(
        rows, errors, ["plant"], "reading_time", "error_time", ["error_time", "error_reading"], bucket_seconds=30 * 86_400, bucket_rows=100
    )
    return joined.select("id", plain("error_time").alias("error_time"), "error_reading")


@query(WINDOWS_SQL + """ SELECT device_id, window_end, ROUND(m1, 6) AS mean_5m_reading_1 FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY device_id ORDER BY window_end DESC) AS rank FROM windows)
          WHERE rank = 1""")
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each device's newest window."""
    windows = asof.window_means(src.sensor_readings(spark, sf_dir), columns=("reading_1",))
    latest = rel.keep_first(windows, ["device_id"], [F.desc("window_end")])
    return rounded(latest, "mean_5m_reading_1").select(
        "device_id", plain("window_end").alias("window_end"), "mean_5m_reading_1"
    )


@query(FEATURES_SQL + " SELECT * FROM features")
def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features written as a table keyed by reading id, the key checked, and read back."""
    features = asof.window_features(src.sensor_readings(spark, sf_dir))
    table = VersionedTable.create(spark, scratch(spark, "window-features"), features)
    return rounded(rel.require_unique(table.read(), "id"), *MEANS)


@query(TRAINING_SQL + " SELECT * FROM training ORDER BY id")
def training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with features looked up by id; readings before their device's first closed window are left out."""
    readings = src.sensor_readings(spark, sf_dir)
    rows = rounded(asof.training_set(readings, asof.window_features(readings)), *MEANS)
    return rows.withColumn("reading_time", plain("reading_time")).orderBy("id")


@query(f"""WITH {src.READINGS_SQL} SELECT device_type, device_operational_status, ROUND(AVG(reading_1), 6) AS avg_reading_1
          FROM readings GROUP BY 1, 2""")
def avg_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average reading per device type and status."""
    return rounded(status_average(src.sensor_readings(spark, sf_dir)), "avg_reading_1")


@query(f"""WITH {src.READINGS_SQL}, cut AS (SELECT quantile_disc(reading_time, 0.8) AS t FROM readings)
          SELECT id, CASE WHEN reading_time <= t THEN 'train' ELSE 'test' END AS split FROM readings, cut""")
def time_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earliest 80 % of the readings for training, the rest for testing."""
    return rel.time_split(src.sensor_readings(spark, sf_dir), "reading_time", 0.8).select("id", "split")
