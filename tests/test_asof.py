"""Window features and as-of joins against brute force."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from oreflow.operators import asof

START = datetime(2024, 1, 1)


def readings(spark, data):
    rows = [(i, d, START + timedelta(seconds=s), float(v)) for i, (d, s, v) in enumerate(data, 1)]
    df = spark.createDataFrame(rows, "id INT, device_id STRING, reading_time TIMESTAMP, reading_1 DOUBLE")
    return df.withColumns({"reading_2": F.col("reading_1") * 2, "reading_3": F.col("reading_1") * 3})


def brute_force(data, width=300):
    """Per reading: mean of its device's newest window that ends at or before it."""
    out = {}
    for i, (d, s, _) in enumerate(data, 1):
        ends = [(s2 // width + 1) * width for d2, s2, _ in data if d2 == d]
        closed = [e for e in ends if e <= s]
        if closed:
            values = [v for d2, s2, v in data if d2 == d and (s2 // width + 1) * width == max(closed)]
            out[i] = sum(values) / len(values)
    return out


def features(df):
    return {r.id: r.mean_5m_reading_1 for r in asof.window_features(df).collect()}


def general(df, bucket):
    windows = asof.window_means(df, columns=("reading_1",)).withColumn("end", F.col("window_end"))
    joined = asof.asof_join(
        df, windows, ["device_id"], "reading_time", "end", ["mean_5m_reading_1"], bucket_seconds=bucket
    )
    return {r.id: r.mean_5m_reading_1 for r in joined.collect()}


def test_two_devices(spark):
    data = [("A", 60, 10), ("B", 360, 99), ("A", 720, 30), ("B", 1860, 1)]
    assert features(readings(spark, data)) == {3: 10.0, 4: 99.0}


def test_window_that_ends_at_the_reading_counts(spark):
    assert features(readings(spark, [("A", 0, 5), ("A", 300, 7), ("A", 599, 9)])) == {2: 5.0, 3: 5.0}


@pytest.mark.parametrize("seed", range(3))
def test_hot_device_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    data = [(rng.choice("AAAABC"), rng.randrange(0, 20_000), rng.randrange(100)) for _ in range(300)]
    df = readings(spark, data)
    want = brute_force(data)
    got = features(df)
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in want)
    for bucket in (300, 3600, 100_000):
        other = general(df, bucket)
        assert other.keys() == want.keys() and all(abs(other[i] - want[i]) < 1e-9 for i in want)


def test_left_asof_keeps_unmatched_rows_and_null_keys(spark):
    left = spark.createDataFrame([(1, "A", START), (2, None, START), (3, "A", None)], "id INT, k STRING, t TIMESTAMP")
    right = spark.createDataFrame([("A", START - timedelta(days=400), 1)], "k STRING, u TIMESTAMP, v INT")
    got = {r.id: r.v for r in asof.asof_join(left, right, ["k"], "t", "u", ["v"], how="left").collect()}
    assert got == {1: 1, 2: None, 3: None}


def test_training_set_drops_rows_without_first_feature(spark):
    base = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "id INT, c STRING")
    feats = spark.createDataFrame([(1, 1.0, None), (2, None, 2.0)], "id INT, f DOUBLE, g DOUBLE")
    assert [tuple(r) for r in asof.training_set(base, feats).collect()] == [(1, "x", 1.0, None)]


def asof_by_hand(left, right):
    """(id, value or None) of left rows (id, key, time) and right rows (key, time, value)."""
    out = []
    for i, k, t in left:
        earlier = [(t2, v) for k2, t2, v in right if k is not None and t is not None and k2 == k and t2 is not None and t2 <= t]
        out.append((i, max(earlier)[1] if earlier else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_ranges_give_the_same_as_buckets(spark, how):
    rng = random.Random(8)
    at = lambda: START + timedelta(seconds=rng.randrange(3000))
    key = lambda: rng.choice(["hot"] * 20 + ["b", "c", "only left"])
    left = [(i, key(), at()) for i in range(1500)] + [(2000, None, at()), (2001, "hot", None), (2002, "hot", START - timedelta(days=9))]
    left += [(3000 + i, "hot", START + timedelta(seconds=1500)) for i in range(300)]  # many at one time
    taken = {(k, t): float(i) for i, (k, t) in enumerate({(key(), at()) for _ in range(900)}) if k != "only left"}
    right = [(k, t, v) for (k, t), v in taken.items()] + [(None, at(), 5.0), ("hot", None, 6.0)]
    l = spark.createDataFrame(left, "id INT, key STRING, time TIMESTAMP").repartition(5)
    r = spark.createDataFrame(right, "key STRING, at TIMESTAMP, value DOUBLE").repartition(3)
    want = [x for x in asof_by_hand(left, right) if how == "left" or x[1] is not None]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so that the hot key lies in several partitions
    try:
        for rows in (10, 10_000):
            joined = asof.asof_join(l, r, ["key"], "time", "at", ["value"], how=how, bucket_rows=rows)
            assert joined.columns == ["id", "key", "time", "value"]
            assert sorted(((x.id, x.value) for x in joined.collect()), key=str) == want
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_one_key_only(spark):
    rows = spark.range(4000).selectExpr("'k' AS key", "timestamp_seconds(1704067200 + id) AS time", "id")
    joined = asof.asof_by_ranges(rows, rows.selectExpr("key", "time AS at", "id AS value").where("value % 3 = 0"), ["key"], "time", "at", ["value"])
    assert joined.where("value <> id - id % 3").count() == 0 and joined.count() == 4000


def test_ranges_of_empty_sides(spark):
    rows = spark.createDataFrame([(1, "a", START)], "id INT, key STRING, time TIMESTAMP")
    none = spark.createDataFrame([], "key STRING, at TIMESTAMP, value DOUBLE")
    for how, n in (("inner", 0), ("left", 1)):
        assert asof.asof_by_ranges(rows, none, ["key"], "time", "at", ["value"], how).count() == n
        assert asof.asof_by_ranges(rows.limit(0), none, ["key"], "time", "at", ["value"], how).count() == 0
