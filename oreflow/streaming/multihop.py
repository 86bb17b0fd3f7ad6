"""Three chained append streams: raw text -> parsed -> enriched -> daily averages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.streaming.runner import append_to_files, complete_to_files, read_stream

RECORDING = "id BIGINT, device BIGINT, time TIMESTAMP, value DOUBLE"


def parse_recordings(raw: DataFrame) -> DataFrame:
    """Lines of JSON to typed recordings; a line that does not parse is left out."""
    parsed = raw.select(F.from_json("value", RECORDING, {"mode": "PERMISSIVE"}).alias("r")).select("r.*")
    return parsed.filter(F.col("id").isNotNull() & F.col("time").isNotNull())


def enrich_recordings(recordings: DataFrame, owners: DataFrame) -> DataFrame:
    """Add the owner of the device; recordings of unknown devices stay."""
    return recordings.join(owners, "device", "left")


def daily_average(recordings: DataFrame) -> DataFrame:
    return recordings.groupBy("segment", F.to_date("time").alias("day")).agg(
        F.avg("value").alias("avg_value"), F.count("*").alias("n")
    )


@dataclass(frozen=True)
class MultiHop:
    """Folders of the hops below one root; each hop has its own checkpoint and can be rerun."""

    spark: SparkSession
    source: str
    root: str

    def run(self, owners: DataFrame) -> DataFrame:
        """Take all new files of the source through the hops; returns the current daily averages."""
        bronze = f"{self.root}/bronze"
        parsed, enriched, daily = (f"{self.root}/{n}" for n in ("parsed", "enriched", "daily"))
        lines = self.spark.readStream.text(self.source)
        append_to_files(lines, bronze, self._checkpoint("bronze"))
        raw = read_stream(self.spark, bronze, "value STRING")
        append_to_files(parse_recordings(raw), parsed, self._checkpoint("parsed"))
        recordings = read_stream(self.spark, parsed, RECORDING)
        with_owner = enrich_recordings(recordings, owners)
        append_to_files(with_owner, enriched, self._checkpoint("enriched"))
        averages = daily_average(read_stream(self.spark, enriched, with_owner.schema))
        return complete_to_files(averages, daily, self._checkpoint("daily"))

    def _checkpoint(self, hop: str) -> str:
        return f"{self.root}/checkpoints/{hop}"
