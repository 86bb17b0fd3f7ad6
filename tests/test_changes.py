"""Row changes on hand-made rows."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from oreflow.operators.changes import delete_where, merge_matched, merge_rows, update_where
from oreflow.operators.schemas import SchemaMismatch


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frame(spark, data):
    return spark.createDataFrame(data, "k INT, t STRING, v STRING")


def test_merge_with_null_key_inserts_again(spark):
    target = frame(spark, [(1, "1900-01-01", "a"), (2, "2021-01-01", "b")])
    source = frame(spark, [(1, None, "A"), (2, "2021-01-01", "B")])
    assert rows(merge_rows(target, source, ["k", "t"])) == [
        (1, "1900-01-01", "a"), (1, None, "A"), (2, "2021-01-01", "B")
    ]


def test_merge_null_safe(spark):
    target = frame(spark, [(1, None, "a"), (2, "x", "b")])
    source = frame(spark, [(1, None, "A")])
    assert rows(merge_rows(target, source, ["k", "t"], null_safe=True)) == [(1, None, "A"), (2, "x", "b")]
    assert len(rows(merge_rows(target, source, ["k", "t"]))) == 3


def test_merge_updates_every_copy_in_the_target(spark):
    target = frame(spark, [(1, "x", "a"), (1, "x", "b")])
    assert rows(merge_rows(target, frame(spark, [(1, "x", "N")]), ["k", "t"])) == [(1, "x", "N"), (1, "x", "N")]


def test_merge_multi_match_is_an_error(spark):
    target, source = frame(spark, [(1, "x", "a")]), frame(spark, [(1, "x", "b"), (1, "x", "c")])
    with pytest.raises(PySparkException, match="more than one source row"):
        merge_rows(target, source, ["k", "t"]).collect()


def test_merge_unmatched_duplicates_are_all_inserted(spark):
    target, source = frame(spark, [(1, "x", "a")]), frame(spark, [(2, "x", "b"), (2, "x", "c")])
    assert len(rows(merge_rows(target, source, ["k", "t"]))) == 3


def test_merge_takes_nulls_of_the_source(spark):
    target, source = frame(spark, [(1, "x", "a")]), frame(spark, [(1, "x", None)])
    assert rows(merge_rows(target, source, ["k", "t"])) == [(1, "x", None)]


def test_merge_by_name_not_position(spark):
    target = frame(spark, [(1, "x", "a")])
    source = frame(spark, [(1, "x", "B")]).select("v", "k", "t")
    assert rows(merge_rows(target, source, ["k", "t"])) == [(1, "x", "B")]
    with pytest.raises(SchemaMismatch):
        merge_rows(target, source.drop("v"), ["k", "t"])


def test_merge_of_rows_with_themselves(spark):
    df = frame(spark, [(i, "x", str(i)) for i in range(50)])
    assert rows(merge_rows(df, df, ["k", "t"])) == rows(df)


def test_update_and_delete_with_null_condition(spark):
    df = frame(spark, [(1, None, "a"), (2, "x", "b")])
    assert rows(update_where(df, {"v": "N"}, F.col("t") == "x")) == [(1, None, "a"), (2, "x", "N")]
    assert rows(delete_where(df, F.col("t") == "x")) == [(1, None, "a")]
    with pytest.raises(SchemaMismatch):
        update_where(df, {"nope": 1})


def test_merge_plan_reads_the_target_once(spark, folder):
    frame(spark, [(1, "x", "a")]).write.parquet(f"{folder}/target")
    target = spark.read.parquet(f"{folder}/target")
    plan = merge_matched(target, frame(spark, [(1, "x", "b")]), ["k", "t"], "hit")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "CartesianProduct" not in plan and "NestedLoop" not in plan
