"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that results depend on; applied to whatever session a query is given.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# A hot key is split in a join even where a later step then needs one more shuffle; applied likewise.
SKEW_SETTINGS = {"spark.sql.adaptive.forceOptimizeSkewedJoin": "true"}

# Whether a finished execution deletes its shuffle files; set while tables are written.
FREES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Settings that only speed depends on; used for sessions this package builds itself.
SPEED_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def sizing(input_bytes: int, partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Settings for jobs over so much input: shuffles start with partitions that fit an executor's memory.

    Adaptive execution merges partitions that turn out small and splits skewed ones, so the number may be
    generous. It also fixes the number of state partitions of a new stream.
    """
    partitions = max(200, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(2 * partition_bytes),
    }


def build_session(
    app: str = "oreflow", master: str | None = None, input_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session with the package's settings; extra ones as keyword, dots written as ``__``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**SPEED_SETTINGS, **RESULT_SETTINGS, **SKEW_SETTINGS, "spark.ui.enabled": "false"}
    if input_bytes is not None:
        settings.update(sizing(input_bytes))
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Set on a foreign session what results and hot keys depend on; leaves its sizing alone."""
    for key, value in {**RESULT_SETTINGS, **SKEW_SETTINGS}.items():
        if spark.conf.get(key) != value:
            spark.conf.set(key, value)
    return spark


@contextmanager
def freeing(spark: SparkSession) -> Iterator[None]:
    """Tables written inside delete their shuffle files once written.

    Else these stay on the executors' disks until the driver happens to collect its garbage, and add up over the steps
    of a query. Not for tables that are fetched, which Spark may be asked for once more.
    """
    if spark.conf.get(FREES, "false") == "true":
        yield
        return
    spark.conf.set(FREES, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREES)


def scratch(spark: SparkSession, name: str) -> str:
    """A new, unique folder path under the shared folder the cluster names.

    Every executor must see the folder, so ``spark.checkpoint.dir`` is taken from the session. Only a
    local session without that setting falls back to a temporary folder of its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="oreflow-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/oreflow/{name}-{uuid.uuid4().hex}"


def drop(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing will read again."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
