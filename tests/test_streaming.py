"""Streams against their batch twins, late data, restarts."""

from datetime import datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from oreflow.operators.versioned import VersionedTable
from oreflow.sources import files
from oreflow.streaming import aggregates as agg
from oreflow.streaming import runner
from oreflow.streaming.multihop import MultiHop, parse_recordings

START = datetime(2024, 1, 1)
SCHEMA = "time TIMESTAMP, action STRING"


def arrive(spark, path, *minutes):
    rows = [(START + timedelta(minutes=m), "a") for m in minutes]
    files.land(spark.createDataFrame(rows, SCHEMA).coalesce(1), path, "parquet")


def closed_counts(spark, folder):
    stream = runner.read_stream(spark, f"{folder}/in", SCHEMA, max_files=1)
    query = runner.append_to_files(agg.action_counts(stream, late="2 hours"), f"{folder}/out", f"{folder}/cp")
    dropped = sum(
        op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]
    )
    got = {(r.start - START).total_seconds() / 3600: r["count"] for r in spark.read.parquet(f"{folder}/out").collect()}
    return got, dropped


def test_far_late_row_is_dropped(spark, folder):
    for minute in (10, 370, 380, 20, 720):
        arrive(spark, f"{folder}/in", minute)
        got, dropped = closed_counts(spark, folder)
    assert got == {0: 1, 6: 2}
    assert dropped == 0  # in the last run; the late row was dropped in the run before


def test_near_late_row_in_the_same_run(spark, folder):
    arrive(spark, f"{folder}/in", 10, 370, 20, 720)
    got, dropped = closed_counts(spark, folder)
    assert got == {0: 2, 6: 1} and dropped == 0


def test_dropped_rows_are_reported(spark, folder):
    arrive(spark, f"{folder}/in", 10, 370)
    closed_counts(spark, folder)
    arrive(spark, f"{folder}/in", 20, 25)
    assert closed_counts(spark, folder)[1] > 0


def test_sorted_windows_only_in_complete_mode(spark, folder):
    arrive(spark, f"{folder}/in", 10, 70, 75)
    stream = runner.read_stream(spark, f"{folder}/in", SCHEMA)
    ordered = agg.in_time_order(agg.action_counts(stream, late="2 hours"))
    with pytest.raises(AnalysisException):
        runner.append_to_files(ordered, f"{folder}/out", f"{folder}/cp")
    result = runner.complete_to_files(ordered, f"{folder}/complete", f"{folder}/cp2")
    batch = agg.in_time_order(agg.action_counts(spark.read.parquet(f"{folder}/in")))
    assert result.collect() == batch.collect()


def test_unbounded_average_is_refused_in_append_mode(spark, folder):
    arrive(spark, f"{folder}/in", 1)
    stream = runner.read_stream(spark, f"{folder}/in", SCHEMA).groupBy("action").count()
    with pytest.raises(AnalysisException):
        runner.append_to_files(stream, f"{folder}/out", f"{folder}/cp")


def test_complete_mode_after_restart(spark, folder):
    for minutes in ((1, 2), (3,), ()):
        if minutes:
            arrive(spark, f"{folder}/in", *minutes)
        stream = runner.read_stream(spark, f"{folder}/in", SCHEMA)
        counts = agg.action_counts(stream)
        result = runner.complete_to_files(counts, f"{folder}/out", f"{folder}/cp")
    assert [r["count"] for r in result.collect()] == [3]


def test_sliding_windows_equal_batch(spark, folder):
    arrive(spark, f"{folder}/in", 5, 20, 70)
    stream = agg.action_counts(runner.read_stream(spark, f"{folder}/in", SCHEMA), "1 hour", "30 minutes")
    result = runner.complete_to_files(stream, f"{folder}/out", f"{folder}/cp")
    batch = agg.action_counts(spark.read.parquet(f"{folder}/in"), "1 hour", "30 minutes")
    assert sorted(map(tuple, result.collect())) == sorted(map(tuple, batch.collect()))
    assert result.agg(F.sum("count")).first()[0] == 6


def test_ingestion_loads_each_file_once(spark, folder):
    source, args = f"{folder}/in", (f"{folder}/out", f"{folder}/cp")
    files.land(spark.createDataFrame([(1, "x")], "gym BIGINT, mac STRING"), source)
    schema = files.schema_of_one_file(spark, source)
    assert schema.simpleString() == "struct<gym:bigint,mac:string>"
    assert files.ingest_files(spark, source, *args, schema).count() == 1
    assert files.ingest_files(spark, source, *args, schema).count() == 1
    files.land(spark.createDataFrame([(2, "y"), (3, "z")], "gym BIGINT, mac STRING"), source)
    assert files.ingest_files(spark, source, *args, schema).count() == 3


def test_ingestion_into_a_table_makes_versions(spark, folder):
    source, rows = f"{folder}/in", spark.createDataFrame([(1, "x")], "gym BIGINT, mac STRING")
    table = VersionedTable.create(spark, f"{folder}/t", rows.limit(0))
    for n in (1, 2):
        files.land(rows, source)
        files.ingest_files_to_table(spark, source, table, f"{folder}/cp", rows.schema)
        assert table.latest().version == n and table.read().count() == n
    files.ingest_files_to_table(spark, source, table, f"{folder}/cp", rows.schema)
    assert table.latest().version == 2


def test_upsert_keeps_one_row_per_key(spark, folder):
    empty = spark.createDataFrame([], "action STRING, n BIGINT")
    table = VersionedTable.create(spark, f"{folder}/t", empty)
    for minutes in ((1, 2), (3, 4, 5)):
        arrive(spark, f"{folder}/in", *minutes)
        counts = runner.read_stream(spark, f"{folder}/in", SCHEMA).groupBy("action").agg(F.count("*").alias("n"))
        runner.upsert_to_table(counts, table, ["action"], f"{folder}/cp")
    assert [tuple(r) for r in table.read().collect()] == [("a", 5)]


def test_multi_hop_takes_up_new_files_only(spark, folder):
    owners = spark.createDataFrame([(1, "north")], "device BIGINT, segment STRING")
    hop = MultiHop(spark, f"{folder}/in", f"{folder}/hops")
    recording = '{{"id": {0}, "device": {1}, "time": "2024-01-01T00:00:0{0}.000Z", "value": {0}}}'
    for batch in ([recording.format(1, 1), "not json"], [recording.format(3, 1), recording.format(5, 2)]):
        files.land(spark.createDataFrame([(line,) for line in batch], "value STRING"), f"{folder}/in", "text")
        result = hop.run(owners)
    got = sorted((r.segment or "-", str(r.day), r.avg_value, r.n) for r in result.collect())
    assert got == [("-", "2024-01-01", 5.0, 1), ("north", "2024-01-01", 2.0, 2)]


def test_parsing_is_the_same_on_a_table(spark):
    raw = spark.createDataFrame([('{"id": 1, "time": "2024-01-01T00:00:00.000Z"}',), ("{",), (None,)], "value STRING")
    assert parse_recordings(raw).count() == 1


def test_running_query_is_named_and_stopped(spark, folder):
    arrive(spark, f"{folder}/in", 1)
    stream = runner.read_stream(spark, f"{folder}/in", SCHEMA)
    query = runner.keep_appending(stream, f"{folder}/out", f"{folder}/cp", every="100 milliseconds", name="running")
    query.processAllAvailable()
    arrive(spark, f"{folder}/in", 2)
    query.processAllAvailable()
    assert [q.name for q in spark.streams.active] == ["running"]
    runner.stop_all(spark)
    assert not spark.streams.active
    assert spark.read.parquet(f"{folder}/out").count() == 2


def test_progress_is_recorded_as_a_table(spark, folder):
    log = f"{folder}/log"
    for minutes in ((1, 2), (300,), (400, 3)):
        arrive(spark, f"{folder}/in", *minutes)
        counts = runner.read_stream(spark, f"{folder}/in", SCHEMA).withWatermark("time", "1 hour")
        counts = counts.groupBy(F.window("time", "1 hour"), "action").agg(F.count("*").alias("n"))
        runner.append_to_files(counts, f"{folder}/out", f"{folder}/cp", log=log)
    rows = spark.read.schema(runner.PROGRESS_SCHEMA).parquet(log).orderBy("batch").collect()
    assert len({r.query for r in rows}) == 1 and len({r.run for r in rows}) == 3
    assert len({r.batch for r in rows}) == len(rows) and sum(r.input_rows for r in rows) == 5
    assert sum(r.dropped_rows for r in rows) == 1  # the third minute, long after its window was closed
    assert [r.watermark for r in rows] == sorted(r.watermark for r in rows)


def test_handle_of_a_running_stream(spark, folder):
    arrive(spark, f"{folder}/in", 1, 2)
    stream = runner.read_stream(spark, f"{folder}/in", SCHEMA)
    handle = runner.Handle(runner.keep_appending(stream, f"{folder}/out", f"{folder}/cp"), f"{folder}/log", spark)
    handle.query.processAllAvailable()
    handle.record()
    handle.record()  # nothing new
    arrive(spark, f"{folder}/in", 3)
    handle.query.processAllAvailable()
    handle.stop()
    assert sorted(r.input_rows for r in handle.progress().collect()) == [1, 2] and not spark.streams.active
