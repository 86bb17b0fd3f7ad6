"""Model monitoring: does the current data still suit the model, and what happened when."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.operators.learning import TrainedModel
from oreflow.operators.metrics import weighted_f1
from oreflow.operators.models import ModelStore, ModelVersions
from oreflow.operators.versioned import VersionedTable

# The default F1 below which a model is retrained, the one the drift runs use, and the
# factors by which they scale the first reading.
DEFAULT_THRESHOLD = 0.7
RUN_THRESHOLD = 0.6
DRIFT_FACTORS = (0.97, 0.97, 0.90, 1.02)

PERFORMANCE_SCHEMA = "needed_retrain BOOLEAN, score DOUBLE, ts BIGINT"


@dataclass(frozen=True)
class Check:
    need_retrain: bool
    score: float


def drift_check(scored: DataFrame, threshold: float = DEFAULT_THRESHOLD, label: str = "label", prediction: str = "prediction") -> Check:
    """Weighted F1 of the predictions, and whether it is below the threshold."""
    score = weighted_f1(scored, label, prediction)
    return Check(score < threshold, score)


def log_performance(log: VersionedTable, check: Check) -> None:
    row = (check.need_retrain, check.score, int(datetime.now(timezone.utc).timestamp()))
    entry = log.spark.createDataFrame([row], PERFORMANCE_SCHEMA)
    if log.exists():
        log.append(entry)
    else:
        VersionedTable.create(log.spark, log.path, entry)


def monitor(
    scored: DataFrame,
    log: VersionedTable,
    retrain: Callable[[], None] | None = None,
    threshold: float = DEFAULT_THRESHOLD,
) -> Check:
    """Check, retrain if needed, and log the outcome."""
    check = drift_check(scored, threshold)
    if check.need_retrain and retrain is not None:
        retrain()
    log_performance(log, check)
    return check


def drift_runs(
    readings: VersionedTable,
    training: Callable[[DataFrame], DataFrame],
    prediction: Column,
    label: str,
    threshold: float = RUN_THRESHOLD,
    factors: Sequence[float] = DRIFT_FACTORS,
) -> list[Check]:
    """Scale the first reading of the whole table, rebuild features and training set, check; per factor.

    The scaling accumulates: every run updates the table the run before has left.
    """
    checks = []
    for factor in factors:
        readings.update({"reading_1": F.col("reading_1") * factor})
        rows = training(readings.read())
        checks.append(drift_check(rows.select(F.col(label).alias("label"), prediction.alias("prediction")), threshold))
    return checks


STEPS_SCHEMA = (
    "step INT, event STRING, table_version BIGINT, score DOUBLE, need_retrain BOOLEAN, run_id STRING, "
    "production_version INT, ts BIGINT"
)
STARTED, FINISHED = "started", "finished"


class DriftRuns:
    """Drift runs with retraining, whose state lies in tables, so that a run that died is taken up where it was.

    Step 0 fits the first production model. Each further step scales the first reading of the whole table, rebuilds
    the training set, scores it with the production model, and, if that is too weak, fits a model on the current
    rows, keeps it, and promotes it. A step writes a row when it starts, with the version the readings had then, and
    one when it ends. A step that started but did not end begins again from that version, so nothing is scaled
    twice; a model it had kept already is not registered again.

    ``training`` makes the training set of the readings, ``split`` divides it into rows to fit and later ones,
    ``fit`` and ``evaluate`` make a model and its metrics (by name).
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        readings: VersionedTable,
        training: Callable[[DataFrame], DataFrame],
        split: Callable[[DataFrame], tuple[DataFrame, DataFrame]],
        fit: Callable[[DataFrame], TrainedModel],
        evaluate: Callable[[TrainedModel, DataFrame], dict[str, float]],
        label: str,
        model_name: str,
        threshold: float = RUN_THRESHOLD,
        factors: Sequence[float] = DRIFT_FACTORS,
    ):
        self.spark, self.path, self.readings = spark, path, readings
        self.training, self.split, self.fit, self.evaluate = training, split, fit, evaluate
        self.label, self.model_name, self.threshold, self.factors = label, model_name, threshold, factors
        self.events = VersionedTable(spark, f"{path}/events")
        self.metrics = VersionedTable(spark, f"{path}/metrics")
        self.versions = ModelVersions(spark, f"{path}/versions")
        self.store = ModelStore(spark, f"{path}/models")

    def steps(self) -> DataFrame:
        """One row per ended step after the first fit."""
        return self.events.read().filter((F.col("event") == FINISHED) & (F.col("step") > 0)).drop("event")

    def run(self) -> None:
        """All steps that have not ended yet."""
        for step in range(len(self.factors) + 1):
            self._step(step)

    def _step(self, step: int) -> None:
        seen = {}
        if self.events.exists():
            seen = {r.event: r for r in self.events.read().filter(F.col("step") == step).collect()}
        if FINISHED in seen:
            return
        if STARTED in seen:
            if self.readings.latest().version != seen[STARTED].table_version:
                self.readings.restore(seen[STARTED].table_version)
        else:
            self._log(step, STARTED, self.readings.latest().version)
        if step:
            self.readings.update({"reading_1": F.col("reading_1") * self.factors[step - 1]})
        # the rows are used several times, and a step that begins again makes them anew
        now = VersionedTable(self.spark, f"{self.path}/training/{step}")
        rows = self.training(self.readings.read())
        if now.exists():
            now.overwrite(rows)
        else:
            VersionedTable.create(self.spark, now.path, rows)
        rows = now.read()
        check = Check(True, 0.0)
        if step:
            scored = self.production().transform(rows)
            scored = scored.select(F.col(self.label).alias("label"), F.col("predicted_label").alias("prediction"))
            check = drift_check(scored, self.threshold)
        run_id = f"step-{step}" if check.need_retrain else None
        if run_id:
            self._retrain(run_id, rows)
        current = self.versions.production(self.model_name).version
        self._log(step, FINISHED, self.readings.latest().version, check, run_id, current)

    def production(self) -> TrainedModel:
        return self.store.load(self.versions.production(self.model_name).run_id)

    def _retrain(self, run_id: str, rows: DataFrame) -> None:
        version = self.versions.version_of(self.model_name, run_id)
        if version is None:
            train, test = self.split(rows)
            model = self.fit(train)
            metrics = [(run_id, name, float(value)) for name, value in self.evaluate(model, test).items()]
            row = self.spark.createDataFrame(metrics, "run_id STRING, metric STRING, value DOUBLE")
            if self.metrics.exists():
                self.metrics.merge(row, ["run_id", "metric"])
            else:
                VersionedTable.create(self.spark, self.metrics.path, row)
            self.store.save(run_id, model)
            version = self.versions.register(self.model_name, run_id)
        self.versions.promote(self.model_name, version)

    def _log(
        self, step: int, event: str, table_version: int, check: Check | None = None, run_id: str | None = None,
        production_version: int | None = None,
    ) -> None:
        score, need = (check.score, check.need_retrain) if check and step else (None, None)
        now = int(datetime.now(timezone.utc).timestamp())
        row = (step, event, table_version, score, need, run_id, production_version, now)
        entry = self.spark.createDataFrame([row], STEPS_SCHEMA)
        if self.events.exists():
            self.events.append(entry)
        else:
            VersionedTable.create(self.spark, self.events.path, entry)
