"""Run and model-version records as tables: search, registration, promotion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.operators.learning import TrainedModel
from oreflow.operators.versioned import VersionedTable

PRODUCTION, ARCHIVED, NO_STAGE = "Production", "Archived", "None"  # fixed stage names

VERSIONS_SCHEMA = "model STRING, version INT, run_id STRING, stage STRING"


def search_runs(runs: DataFrame, metric: str, above: float | None = None, ascending: bool = False) -> DataFrame:
    """Runs whose metric exceeds a bound, best (or worst) first."""
    if above is not None:
        runs = runs.filter(F.col(metric) > above)
    return runs.orderBy(F.asc(metric) if ascending else F.desc(metric), "run_id")


def record_run(runs: VersionedTable, row: DataFrame) -> None:
    if runs.exists():
        runs.append(row)
    else:
        VersionedTable.create(runs.spark, runs.path, row)


class ModelVersions:
    """Versions of named models; at most one of each is in production."""

    def __init__(self, spark: SparkSession, path: str):
        self.table = VersionedTable(spark, path)

    def rows(self) -> DataFrame:
        return self.table.read()

    def register(self, model: str, run_id: str) -> int:
        """Add a run as the model's next version."""
        spark, table = self.table.spark, self.table
        version = 1
        if table.exists():
            newest = table.read().filter(F.col("model") == model).agg(F.max("version")).first()[0]
            version = (newest or 0) + 1
        row = spark.createDataFrame([(model, version, run_id, NO_STAGE)], VERSIONS_SCHEMA)
        if table.exists():
            table.append(row)
        else:
            VersionedTable.create(spark, table.path, row)
        return version

    def production(self, model: str):
        """The production version's row, or None."""
        rows = self.table.read().filter((F.col("model") == model) & (F.col("stage") == PRODUCTION))
        return rows.orderBy(F.desc("version")).first()

    def version_of(self, model: str, run_id: str) -> int | None:
        """The version that a run was registered as, if it was."""
        if not self.table.exists():
            return None
        same = (F.col("model") == model) & (F.col("run_id") == run_id)
        return self.table.read().filter(same).agg(F.max("version")).first()[0]

    def promote(self, model: str, version: int) -> None:
        """Move a version to production and the one there before to the archive, in one commit."""
        rows = self.table.read().filter(F.col("model") == model)
        is_new = F.col("version") == version
        changed = rows.filter(is_new | (F.col("stage") == PRODUCTION)).withColumn(
            "stage", F.when(is_new, PRODUCTION).otherwise(ARCHIVED)
        )
        self.table.merge(changed, ["model", "version"])


class ModelStore:
    """Fitted models in a shared folder, by run."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def save(self, run_id: str, model: TrainedModel) -> None:
        model.save(self.spark, f"{self.path}/{run_id}")

    def load(self, run_id: str) -> TrainedModel:
        return TrainedModel.load(self.spark, f"{self.path}/{run_id}")
