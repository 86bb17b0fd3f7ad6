"""Run streaming DataFrames, mostly over what is available and then stop; one checkpoint folder per stream.

Every runner is restartable: called again with the same checkpoint it takes up only new input. Sinks are
files or versioned tables in shared folders, never the driver's memory.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from oreflow.operators.versioned import VersionedTable

# large keyed state lives in RocksDB on the executors' disks, not in their heap
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    fmt: str = "parquet",
    max_files: int | None = None,
) -> DataFrame:
    """Stream of the files in a folder (or of one file), each read once; the schema is declared."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def _writer(stream: DataFrame, mode: str, checkpoint: str) -> DataStreamWriter:
    """Writer with the settings all streams share; a stream restarted keeps the state store it began with."""
    provider = "spark.sql.streaming.stateStore.providerClass"
    if stream.sparkSession.conf.get(provider).endswith("HDFSBackedStateStoreProvider"):
        stream.sparkSession.conf.set(provider, STATE_STORE)
    return stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)


PROGRESS_SCHEMA = (
    "query STRING, run STRING, batch BIGINT, started TIMESTAMP, input_rows BIGINT, watermark TIMESTAMP, "
    "dropped_rows BIGINT, state_rows BIGINT"
)


class Handle:
    """A running stream whose progress is kept as a table: one row for each batch that did something.

    ``dropped_rows`` counts what the watermark kept out of the state: rows of an operator that sees single rows,
    groups (key and window) of a batch where they were added up before. Spark remembers the last hundred batches, so
    progress is recorded while the stream runs. A batch that is reported again as idle is recorded once.
    """

    def __init__(self, query: StreamingQuery, log: str, spark: SparkSession):
        self.query, self.log, self.spark = query, log, spark
        self._recorded = -1

    def record(self) -> None:
        """Append the batches that have ended since the last call."""
        rows = []
        for p in self.query.recentProgress:
            if p["batchId"] > self._recorded and p["durationMs"].get("addBatch") is not None:
                self._recorded = p["batchId"]
                state = p["stateOperators"]
                instant = lambda text: text and datetime.fromisoformat(text.replace("Z", "+00:00"))
                rows.append(
                    (str(p["id"]), str(p["runId"]), p["batchId"], instant(p["timestamp"]), p["numInputRows"],
                     instant(p["eventTime"].get("watermark")), sum(s["numRowsDroppedByWatermark"] for s in state),
                     sum(s["numRowsTotal"] for s in state))
                )
        if rows:
            self.spark.createDataFrame(rows, PROGRESS_SCHEMA).coalesce(1).write.mode("append").parquet(self.log)

    def progress(self) -> DataFrame:
        return self.spark.read.schema(PROGRESS_SCHEMA).parquet(self.log)

    def wait(self, every: float = 5.0) -> None:
        """Until the stream ends; it is stopped and its last batches recorded even if it fails."""
        try:
            while not self.query.awaitTermination(every):
                self.record()
        finally:
            self.stop()

    def stop(self) -> None:
        self.query.stop()
        self.record()


def _finish(query: StreamingQuery, spark: SparkSession, log: str | None = None) -> StreamingQuery:
    if log is not None:
        Handle(query, log, spark).wait()
        return query
    try:
        query.awaitTermination()
    finally:
        query.stop()
    return query


def stop_all(spark: SparkSession) -> None:
    for query in spark.streams.active:
        query.stop()


def append_to_files(
    stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", log: str | None = None
) -> StreamingQuery:
    """Append mode into a folder of files, exactly once per checkpoint; ``log`` is a folder for the progress."""
    return _finish(_writer(stream, "append", checkpoint).format(fmt).start(path), stream.sparkSession, log)


def keep_appending(
    stream: DataFrame, path: str, checkpoint: str, every: str = "0 seconds", fmt: str = "parquet", name: str | None = None
) -> StreamingQuery:
    """The same without an end: a batch per interval until the returned query is stopped."""
    writer = _writer(stream, "append", checkpoint).format(fmt).trigger(processingTime=every)
    return (writer.queryName(name) if name else writer).start(path)


def each_batch(
    stream: DataFrame, action: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    return _finish(_writer(stream, mode, checkpoint).foreachBatch(action).start(), stream.sparkSession)


def complete_to_files(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Complete mode: each batch writes the whole result to its own folder; returns the newest.

    A batch replayed after a failure overwrites its own folder only. A run without new input returns the
    result of the run before.
    """
    spark = stream.sparkSession
    written: list[int] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        written.append(batch_id)

    each_batch(stream, write, checkpoint, "complete")
    newest = max(written) if written else spark.read.parquet(path).agg(F.max("batch")).first()[0]
    return spark.read.parquet(f"{path}/batch={newest}")


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream's checkpoint gives it: the same after a restart, another for every new checkpoint."""
    return spark.read.json(f"{checkpoint}/metadata").first()["id"]


def upsert_to_table(stream: DataFrame, table: VersionedTable, on: list[str], checkpoint: str) -> None:
    """Update mode: the rows that changed in a batch are merged by key, one table version per batch.

    The checkpoint's id and the batch number are stored with the version, so a replayed batch is not applied twice.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        VersionedTable(spark, table.path).merge(batch, on, batch=(query_id(spark, checkpoint), batch_id))

    each_batch(stream, merge, checkpoint, "update")


def append_to_table(stream: DataFrame, table: VersionedTable, checkpoint: str) -> None:
    """Append mode into a versioned table, one version per batch of a checkpoint."""

    def append(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        VersionedTable(spark, table.path).append(batch, batch=(query_id(spark, checkpoint), batch_id))

    each_batch(stream, append, checkpoint)
