"""As-of lookups: for each row, the newest earlier row of another relation with the same key."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreflow.session import scratch

READINGS = ("reading_1", "reading_2", "reading_3")

#: Right rows of one key that an as-of join gathers for a bucket of time.
BUCKET_ROWS = 10_000


def window_means(
    readings: DataFrame,
    key: str = "device_id",
    time: str = "reading_time",
    columns: tuple[str, ...] = READINGS,
    width: str = "5 minutes",
    prefix: str = "mean_5m_",
) -> DataFrame:
    """Mean of each column per key and tumbling window."""
    return (
        readings.groupBy(key, F.window(time, width).alias("window"))
        .agg(*[F.avg(c).alias(prefix + c) for c in columns])
        .select(
            key,
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *[prefix + c for c in columns],
        )
    )


def with_window_features(
    readings: DataFrame,
    key: str = "device_id",
    time: str = "reading_time",
    columns: tuple[str, ...] = READINGS,
    width: str = "5 minutes",
    prefix: str = "mean_5m_",
) -> DataFrame:
    """Readings with the means of their key's newest window that had closed by then; without one, no row.

    Windows are aligned, so every reading inside one window sees the same closed window: the previous
    non-empty one of its key. That makes the lookup a lag over the aggregated windows (one row per key
    and window, whatever the number of readings) and an equi-join of the readings to it. No reading is
    sorted or paired with more than one window, and a key holding much of the data is spread over its
    windows in the join.
    """
    means = [prefix + c for c in columns]
    windows = window_means(readings, key, time, columns, width, prefix)
    order = Window.partitionBy(key).orderBy("window_start")
    previous = windows.select(
        F.col(key).alias("_key"),
        F.col("window_start").alias("_start"),
        *[F.lag(m).over(order).alias(m) for m in means],
        F.lag("window_start").over(order).alias("_previous"),
    ).filter(F.col("_previous").isNotNull())
    own = readings.select("*", F.window(time, width).getField("start").alias("_own"))
    joined = own.join(previous, (F.col(key) == F.col("_key")) & (F.col("_own") == F.col("_start")))
    return joined.select(*readings.columns, *means)


def window_features(
    readings: DataFrame,
    id: str = "id",
    key: str = "device_id",
    time: str = "reading_time",
    columns: tuple[str, ...] = READINGS,
    width: str = "5 minutes",
    prefix: str = "mean_5m_",
) -> DataFrame:
    """The features alone, keyed by reading id, as a feature table holds them."""
    rows = with_window_features(readings, key, time, columns, width, prefix)
    return rows.select(id, *[prefix + c for c in columns])


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    left_time: str,
    right_time: str,
    values: list[str],
    bucket_seconds: int = 3600,
    how: str = "inner",
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Each left row with the values of the newest right row of its key at or before its time.

    Time is cut into buckets. Per key and bucket the right side becomes one row: its rows of that bucket
    as a sorted array, plus the newest one from before. Left rows find theirs by an equi-join on key and
    bucket and search the array, so no left row is shuffled to a per-key window and no pairs are made.
    The rows of each key and bucket are counted first; if any has more than ``bucket_rows`` right rows, both
    sides are instead sorted together by ranges of key and time (``asof_by_ranges``), which no key can crowd.
    The right side must have at most one row per key and time (an aggregate by time window has). A NULL key
    or time matches nothing.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how}")

    def bucket(time: str) -> Column:
        return F.floor(F.unix_seconds(F.col(time).cast("timestamp")) / bucket_seconds)

    counts = right.filter(F.col(right_time).isNotNull()).groupBy(*on, bucket(right_time)).count()
    if not counts.filter(F.col("count") > bucket_rows).limit(1).isEmpty():
        return asof_by_ranges(left, right, on, left_time, right_time, values, how)
    keys = [f"_{k}" for k in on]
    candidate = F.struct(F.col(right_time).alias("_time"), *values)
    per_bucket = (
        right.filter(F.col(right_time).isNotNull())
        .groupBy(*[F.col(k).alias(f"_{k}") for k in on], bucket(right_time).alias("_bucket"))
        .agg(F.array_sort(F.collect_list(candidate)).alias("_inside"))
    )
    wanted = left.select(*[F.col(k).alias(f"_{k}") for k in on], bucket(left_time).alias("_bucket")).distinct()
    grid = wanted.join(per_bucket, [*keys, "_bucket"], "full")
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    lookup = grid.select(
        *keys,
        "_bucket",
        "_inside",
        F.last(F.element_at("_inside", -1), ignorenulls=True).over(earlier).alias("_before"),
    )
    rows = left.withColumn("_own", bucket(left_time))
    same = [F.col(k) == F.col(f"_{k}") for k in on]
    joined = rows.join(lookup, reduce(and_, [*same, F.col("_own") == F.col("_bucket")]), "left")
    inside = F.filter("_inside", lambda r: r["_time"] <= F.col(left_time))
    newest = F.coalesce(F.try_element_at(inside, F.lit(-1)), F.col("_before"))
    found = joined.withColumn("_found", newest)
    if how == "inner":
        found = found.filter(F.col("_found").isNotNull())
    return found.select(*left.columns, *[F.col(f"_found.{v}").alias(v) for v in values])


def asof_by_ranges(
    left: DataFrame, right: DataFrame, on: list[str], left_time: str, right_time: str, values: list[str], how: str = "inner"
) -> DataFrame:
    """The as-of join for keys of any size.

    Rows of both sides are sorted together by ranges of key and time, so a key lies in as many partitions as it
    fills. Inside its partition a left row sees the last right row before it by a running window; if its key has
    none there, it takes the last one of the partitions before, which one small row per key and partition carries
    over. Many left rows with the same key and time are spread as well.
    """
    spark = left.sparkSession
    keys = [f"_{k}" for k in on]
    found = F.struct(F.lit(True).alias("_is"), *values)
    usable = lambda time: reduce(and_, [F.col(c).isNotNull() for c in (*on, time)])
    key_columns = [F.col(k).alias(f"_{k}") for k in on]
    later = right.filter(usable(right_time)).select(
        *key_columns, F.col(right_time).cast("timestamp").alias("_time"), F.lit(0).alias("_side"), found.alias("_found")
    )
    whole = F.struct(*left.columns)
    rows = left.filter(usable(left_time)).select(
        *key_columns, F.col(left_time).cast("timestamp").alias("_time"), F.lit(1).alias("_side"), whole.alias("_row")
    )
    both = later.unionByName(rows, allowMissingColumns=True)
    order = [*keys, "_time", "_side"]
    ranged = both.repartitionByRange(*order, F.xxhash64("_row")).sortWithinPartitions(*order)
    path = scratch(spark, "asof")
    ranged.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    ranged = spark.read.parquet(path).withColumn("_part", F.shiftright("_at", 33))
    so_far = Window.partitionBy(*keys, "_part").orderBy("_at")
    seen = ranged.withColumn("_found", F.last("_found", ignorenulls=True).over(so_far)).filter("_side = 1")
    last = ranged.filter("_side = 0").groupBy(*keys, "_part").agg(F.max_by("_found", "_at").alias("_last"))
    parts = ranged.groupBy(*keys, "_part").agg(F.lit(1).alias("_one")).drop("_one").join(last, [*keys, "_part"], "left")
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.withColumn("_carried", F.last("_last", ignorenulls=True).over(before)).filter("_carried IS NOT NULL")
    joined = seen.join(carried.select(*keys, "_part", "_carried"), [*keys, "_part"], "left")
    joined = joined.withColumn("_found", F.coalesce("_found", "_carried"))
    if how == "inner":
        joined = joined.filter(F.col("_found").isNotNull())
    out = joined.select("_row.*", *[F.col(f"_found.{v}").alias(v) for v in values])
    if how == "left":
        types = {f.name: f.dataType for f in right.schema.fields}
        unusable = left.filter(~usable(left_time)).select("*", *[F.lit(None).cast(types[v]).alias(v) for v in values])
        out = out.unionByName(unusable)
    return out


def lookup_features(base: DataFrame, features: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Left-join all looked-up columns of one feature table at once."""
    return base.join(features.select(key, *columns), key, "left")


def training_set(base: DataFrame, features: DataFrame, key: str = "id", columns: list[str] | None = None) -> DataFrame:
    """Base rows with their features; rows whose first feature is missing are left out."""
    columns = columns or [c for c in features.columns if c != key]
    return lookup_features(base, features, key, columns).filter(F.col(columns[0]).isNotNull())
