"""Versioned tables over plain Parquet: every commit is a version that stays readable.

A table is a folder with ``data/<unique>/`` folders of Parquet files, never changed once written, and one
small JSON row per commit below ``history/``. A version names the data folders ("segments") it consists
of, so append, restore, shallow clone and truncate copy no data, and a change rewrites only segments
that hold touched rows. Rows become visible with the history row, so a job that dies half-way leaves
nothing a reader can see. One writer at a time is assumed; a second one fails on the history folder.

Tables written with ``cluster_by`` get one segment per value of that SQL expression (keep it coarse: a
month, a region); others are one segment per commit. Rows are shuffled by segment only where they don't
lie together already and their segments are not few.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.operators.changes import (
    delete_where,
    fitted,
    key_matches,
    merge_matched,
    merge_unmatched,
    update_where,
)
from oreflow.operators.schemas import check_fits, conform, merged_schema
from oreflow.session import drop, freeing, scratch

HISTORY_SCHEMA = (
    "version BIGINT, committed_at TIMESTAMP, operation STRING, parameters MAP<STRING, STRING>, "
    "table_schema STRING, cluster_by STRING, segments ARRAY<STRING>"
)
SEGMENT = "_segment"
CODEC = "zstd"
NO_SEGMENT = "__HIVE_DEFAULT_PARTITION__"  # how a folder is named whose value is NULL or empty
HIT = "_merge_hit"
#: Segments up to which each task of a merge writes a file of its own for each.
FEW = 16
#: A source with more bytes is merged in several groups of segments, at most so many, one after the other.
GROUP_BYTES = 32 << 20
GROUPS = 4


@dataclass(frozen=True)
class Version:
    version: int
    committed_at: datetime
    operation: str
    parameters: dict[str, str]
    schema: T.StructType
    cluster_by: str | None
    segments: tuple[str, ...]


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    # -- reading -------------------------------------------------------------------------------

    def exists(self) -> bool:
        try:
            return not self._commits().isEmpty()
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e):
                return False
            raise

    def _commits(self) -> DataFrame:
        return (
            self.spark.read.schema(HISTORY_SCHEMA)
            .option("recursiveFileLookup", "true")
            .json(f"{self.path}/history")
        )

    def history(self) -> DataFrame:
        """One row per commit, newest first."""
        return (
            self._commits()
            .select("version", "committed_at", "operation", "parameters", F.size("segments").alias("segments"))
            .orderBy(F.desc("version"))
        )

    def latest(self) -> Version:
        return self.at()

    def at(self, version: int | None = None, timestamp: datetime | str | None = None) -> Version:
        """The version asked for by number, or the newest one not after a point in time."""
        commits = self._commits()
        if version is not None:
            commits = commits.filter(F.col("version") == version)
        if timestamp is not None:
            commits = commits.filter(F.col("committed_at") <= F.lit(timestamp).cast("timestamp"))
        row = commits.orderBy(F.desc("version")).first()
        if row is None:
            raise LookupError(f"{self.path} has no version {version if timestamp is None else timestamp}")
        return Version(
            row.version,
            row.committed_at,
            row.operation,
            row.parameters,
            T.StructType.fromJson(json.loads(row.table_schema)),
            row.cluster_by,
            tuple(row.segments),
        )

    def read(self, version: int | None = None, timestamp: datetime | str | None = None) -> DataFrame:
        return self._rows(self.at(version, timestamp))

    def _rows(self, v: Version, segments: tuple[str, ...] | None = None) -> DataFrame:
        segments = v.segments if segments is None else segments
        if not segments:
            return self.spark.createDataFrame([], v.schema)
        return self.spark.read.schema(v.schema).parquet(*segments)

    # -- writing -------------------------------------------------------------------------------

    @classmethod
    def create(
        cls,
        spark: SparkSession,
        path: str,
        rows: DataFrame,
        cluster_by: str | None = None,
        if_not_exists: bool = False,
        gather: bool = True,
    ) -> VersionedTable:
        """Create the table with its first rows as version 0.

        Without ``gather`` each task writes a file of its own for each segment it has rows of, and nothing is shuffled
        by segment; for tables of few segments.
        """
        table = cls(spark, path)
        if table.exists():
            if if_not_exists:
                return table
            raise FileExistsError(f"{path} already holds a table")
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in rows.schema.fields])
        segments = table._write(rows, cluster_by, gather)
        table._commit(0, "CREATE TABLE AS SELECT", {}, schema, cluster_by, segments)
        return table

    def append(self, rows: DataFrame, batch: tuple[str, int] | None = None, merge_schema: bool = False) -> Version:
        """Add rows; with ``batch`` (stream name, batch id) a batch seen before is skipped.

        Rows that do not fit the table, at any depth, are refused unless ``merge_schema``. Old segments are not
        rewritten for new fields: they are read in the table's schema, new fields as NULL.
        """
        v = self.latest()
        if batch and self._has_batch(batch):
            return v
        schema = self._fitting(v, rows, merge_schema)
        added = self._write(conform(rows, schema), v.cluster_by)
        return self._next(v, "WRITE", {"mode": "Append", **_batch_parameters(batch)}, schema, [*v.segments, *added])

    def _fitting(self, v: Version, rows: DataFrame, merge_schema: bool) -> T.StructType:
        if merge_schema:
            return merged_schema(v.schema, rows.schema)
        check_fits(v.schema, rows.schema)
        return v.schema

    def overwrite(self, rows: DataFrame, merge_schema: bool = False, gather: bool = True) -> Version:
        """Replace all rows; such as don't fit the table are refused unless ``merge_schema``.

        Without ``gather`` rows are written where they are; for rows that lie together by segment already, as the
        table's own do.
        """
        v = self.latest()
        schema = self._fitting(v, rows, merge_schema)
        segments = self._write(conform(rows, schema), v.cluster_by, gather)
        return self._next(v, "WRITE", {"mode": "Overwrite", "mergeSchema": str(merge_schema).lower()}, schema, segments)

    def delete(self, condition: Column | None = None) -> Version:
        v = self.latest()
        if condition is None:
            return self._next(v, "DELETE", {}, v.schema, [])
        touched, kept = self._split(v, lambda rows: rows.filter(condition))
        # what is left of a segment stays in it, so its rows lie together already
        left = delete_where(self._rows(v, touched), condition)
        segments = self._write(left, v.cluster_by, gather=False) if touched else []
        return self._next(v, "DELETE", {"predicate": _text(condition)}, v.schema, [*kept, *segments])

    def update(self, assignments: dict[str, object], condition: Column | None = None) -> Version:
        v = self.latest()
        if condition is None:
            touched, kept = v.segments, ()
        else:
            touched, kept = self._split(v, lambda rows: rows.filter(condition))
        updated = update_where(self._rows(v, touched), assignments, condition)
        segments = self._write(updated, v.cluster_by, self._scatters(v, assignments)) if touched else []
        parameters = {"predicate": _text(condition), "columns": ",".join(assignments)}
        return self._next(v, "UPDATE", parameters, v.schema, [*kept, *segments])

    def merge(
        self, source: DataFrame, on: list[str], null_safe: bool = False, batch: tuple[str, int] | None = None
    ) -> Version:
        """Upsert by key; rewrites the segments that hold a matched key and adds the inserted rows.

        If the segments follow from the key, the target's rows are read once, and only those of segments that the
        source can reach; if not, its keys are read before to find the segments. A large source is merged by groups of
        such segments, so that only a part of both sides is shuffled at a time.
        """
        v = self.latest()
        if batch and self._has_batch(batch):
            return v
        check_fits(v.schema, source.schema)
        # the source is used several times below and must be the same rows each time
        staged = scratch(self.spark, "merge-source")
        with freeing(self.spark):
            fitted(source, self._rows(v, ())).write.option("compression", CODEC).parquet(staged)
        source = self.spark.read.schema(v.schema).parquet(staged)
        touched, few = self._reachable(v, source, on)
        if touched is None:
            keys = source.select(*[F.col(k).alias(f"_{k}") for k in on]).distinct()
            touched, _ = self._split(v, lambda rows: rows.join(keys, key_matches(rows, keys, on, null_safe), "left_semi"))
            groups = [(touched, source)]
        else:
            groups = self._groups(v, touched, source, staged)
        # matched rows are marked in the new segments, which then tell what to insert and which segments changed
        written, added = [], []
        for own, rows in groups:
            inserted, new, changed = rows, [], set()
            if own:
                new = self._write(merge_matched(self._rows(v, own), rows, on, HIT, null_safe), v.cluster_by, not few)
                marked = self.spark.read.schema(T.StructType([*v.schema.fields, T.StructField(HIT, T.BooleanType())]))
                hits = marked.parquet(*new).filter(F.col(HIT))
                changed = self._folders(hits)
                inserted = merge_unmatched(rows, hits, on, null_safe)
            added += self._write(inserted, v.cluster_by, not few)
            for segment in new:
                if _folder(segment) in changed:
                    written.append(segment)
                else:  # like the old one
                    drop(self.spark, segment)
        drop(self.spark, staged)
        if v.cluster_by is None and self._rows(v, tuple(added)).isEmpty():
            added = []
        if v.cluster_by is not None:
            names = {_segment(s) for s in written}
            replaced = {s for s in touched if _segment(s) in names}
        else:
            replaced = set(touched) if written else set()
        segments = [s for s in v.segments if s not in replaced] + written + added
        return self._next(v, "MERGE", {"on": ",".join(on), **_batch_parameters(batch)}, v.schema, segments)

    def restore(self, version: int) -> Version:
        """Make an older version current again as a new version; history only grows."""
        old = self.at(version)
        parameters = {"version": str(version)}
        return self._next(self.latest(), "RESTORE", parameters, old.schema, list(old.segments), old.cluster_by)

    def clone(self, path: str, version: int | None = None, shallow: bool = False) -> VersionedTable:
        """New table with the rows of a version: data copied, or (shallow) read from the source's folders."""
        v = self.at(version)
        copy = VersionedTable(self.spark, path)
        if copy.exists():
            raise FileExistsError(f"{path} already holds a table")
        segments = list(v.segments) if shallow else copy._write(self._rows(v), v.cluster_by)
        parameters = {"source": self.path, "sourceVersion": str(v.version), "isShallow": str(shallow).lower()}
        copy._commit(0, "CLONE", parameters, v.schema, v.cluster_by, segments)
        return copy

    def vacuum(self) -> None:
        """Delete the table's own files that only older versions consist of; these, and clones that share such files,
        can't be read any more."""
        current = {_folder(s) for s in self.latest().segments}
        older = {s for row in self._commits().select("segments").distinct().toLocalIterator() for s in row.segments}
        for segment in older:
            if _folder(segment).startswith(f"{_folder(self.path)}/") and _folder(segment) not in current:
                drop(self.spark, segment)

    def has_copied_data(self) -> bool:
        """Whether any segment of the current version lies in this table's own folder."""
        return any(s.startswith(f"{self.path}/") for s in self.latest().segments)

    # -- parts ---------------------------------------------------------------------------------

    def _folders(self, rows: DataFrame) -> set[str]:
        """Folders of the files that rows come from. At most one row per segment reaches the driver."""
        files = rows.select(F.col("_metadata.file_path").alias("_file")).distinct()
        folders = files.select(F.regexp_replace("_file", "/[^/]*$", "").alias("folder")).distinct()
        return {_folder(unquote(r.folder)) for r in folders.collect()}

    def _split(self, v: Version, touched_rows) -> tuple[tuple[str, ...], tuple[str, ...]]:
        """Segments with touched rows, and the others."""
        if not v.segments:
            return (), ()
        rows = self._rows(v).withColumn("_file", F.col("_metadata.file_path"))
        files = touched_rows(rows).select("_file").distinct()
        folders = files.select(F.regexp_replace("_file", "/[^/]*$", "").alias("folder")).distinct()
        wanted = {_folder(unquote(r.folder)) for r in folders.collect()}
        touched = tuple(s for s in v.segments if _folder(s) in wanted)
        if len(touched) != len(wanted):
            raise RuntimeError(f"rows read from folders that are not segments of {self.path}")
        return touched, tuple(s for s in v.segments if s not in touched)

    def _scatters(self, v: Version, assignments: dict[str, object]) -> bool:
        """Whether an update can send rows of one segment to many: if ``cluster_by`` uses a computed new value."""
        computed = [c for c, value in assignments.items() if isinstance(value, Column)]
        if v.cluster_by is None or not computed:
            return False
        try:
            self._rows(v, ()).drop(*computed).select(F.expr(v.cluster_by)).schema  # analysed here at the latest
        except AnalysisException:
            return True
        return False

    def _reachable(self, v: Version, source: DataFrame, on: list[str]) -> tuple[tuple[str, ...] | None, bool]:
        """Segments that rows with a key of the source can lie in, or None if the segments don't follow from the key;
        and whether the source's rows have few segments.

        They do if ``cluster_by`` only uses key columns: equal keys then have equal segments. (Not for fractions,
        where equal numbers can be written differently.)
        """
        kinds = {f.name: f.dataType for f in v.schema.fields}
        if v.cluster_by is None or any(isinstance(kinds[k], (T.FloatType, T.DoubleType)) for k in on):
            return None, False
        try:
            values = source.select(*on).select(F.expr(v.cluster_by).cast("string").alias("value")).distinct()
            values.schema  # analysed here at the latest
        except AnalysisException:
            return None, False
        names = self.spark.createDataFrame([(_segment(s),) for s in v.segments], "name STRING").distinct()
        name = F.when(F.coalesce("value", F.lit("")) == "", NO_SEGMENT).otherwise(F.col("value"))
        asked = values.select(name.alias("name")).distinct()
        met = {r.name for r in asked.join(names, "name", "left_semi").collect()}
        return tuple(s for s in v.segments if _segment(s) in met), asked.limit(FEW + 1).count() <= FEW

    def _groups(
        self, v: Version, touched: tuple[str, ...], source: DataFrame, staged: str
    ) -> list[tuple[tuple[str, ...], DataFrame]]:
        """Groups of segments with the source's rows that belong to them, last the rows of segments the table lacks."""
        fs, path = self._file_system(staged)
        names = sorted({_segment(s) for s in touched})
        count = min(GROUPS, len(names), -(-fs.getContentSummary(path).getLength() // GROUP_BYTES))
        if count < 2:
            return [(touched, source)]
        value = F.expr(v.cluster_by).cast("string")
        name = F.when(F.coalesce(value, F.lit("")) == "", NO_SEGMENT).otherwise(value)
        groups = []
        for k in range(count):
            own = names[k::count]
            groups.append((tuple(s for s in touched if _segment(s) in own), source.where(name.isin(own))))
        return [*groups, ((), source.where(~name.isin(names)))]

    def _file_system(self, location: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(location)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _write(self, rows: DataFrame, cluster_by: str | None, gather: bool = True) -> list[str]:
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        if cluster_by is None:
            with freeing(rows.sparkSession):
                rows.write.mode("errorifexists").option("compression", CODEC).parquet(folder)
            return [folder]
        tagged = rows.withColumn(SEGMENT, F.expr(cluster_by).cast("string"))
        if gather:  # rebalancing gives each value few, even files and splits a value that holds much of the table
            tagged = tagged.hint("rebalance", SEGMENT)
        with freeing(rows.sparkSession):
            tagged.write.mode("errorifexists").option("compression", CODEC).partitionBy(SEGMENT).parquet(folder)
        # one folder per segment; its files are not listed
        fs, path = self._file_system(folder)
        return sorted(f.getPath().toString() for f in fs.listStatus(path) if f.isDirectory())

    def _next(
        self,
        old: Version,
        operation: str,
        parameters: dict[str, str],
        schema: T.StructType,
        segments: list[str],
        cluster_by: str | None = None,
    ) -> Version:
        return self._commit(old.version + 1, operation, parameters, schema, cluster_by or old.cluster_by, segments)

    def _commit(
        self,
        version: int,
        operation: str,
        parameters: dict[str, str],
        schema: T.StructType,
        cluster_by: str | None,
        segments: list[str],
    ) -> Version:
        now = datetime.now(timezone.utc)
        row = {
            "version": version,
            "committed_at": now.isoformat(timespec="milliseconds"),
            "operation": operation,
            "parameters": parameters,
            "table_schema": schema.json(),
            "cluster_by": cluster_by,
            "segments": list(segments),
        }
        # complete under a name of its own, then given the version's name, which fails if that is taken
        pending, name = f"{self.path}/pending/{uuid.uuid4().hex}.json", f"{self.path}/history/v{version:010d}.json"
        fs, path = self._file_system(pending)
        out = fs.create(path, False)
        out.write(bytearray(json.dumps(row).encode()))
        out.close()
        gateway, hadoop = self.spark.sparkContext._gateway, self.spark._jvm.org.apache.hadoop.fs
        fs.mkdirs(hadoop.Path(f"{self.path}/history"))
        context = hadoop.FileContext.getFileContext(path.toUri(), self.spark._jsc.hadoopConfiguration())
        no_overwrite = gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        context.rename(path, hadoop.Path(name), no_overwrite)
        return Version(version, now, operation, parameters, schema, cluster_by, tuple(segments))

    def _has_batch(self, batch: tuple[str, int]) -> bool:
        wanted = _batch_parameters(batch)
        seen = self._commits().filter(
            (F.col("parameters")["stream"] == wanted["stream"]) & (F.col("parameters")["batch"] == wanted["batch"])
        )
        return not seen.isEmpty()


def _batch_parameters(batch: tuple[str, int] | None) -> dict[str, str]:
    return {"stream": batch[0], "batch": str(batch[1])} if batch else {}


def _text(condition: Column | None) -> str:
    return "true" if condition is None else str(condition).removeprefix("Column<'").removesuffix("'>")


def _segment(path: str) -> str:
    """The value that a segment's folder is named after."""
    return unquote(path.rstrip("/").rsplit("/", 1)[-1].removeprefix(f"{SEGMENT}="))


def _folder(path: str) -> str:
    """A path without scheme and host, which one file system may write in several ways."""
    return re.sub("^[a-z0-9]+:(//[^/]*)?", "", path).rstrip("/")
