"""Model scoring on tables and streams, its evaluation, and drift."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.operators import drift, metrics, models, scoring
from oreflow.operators.versioned import VersionedTable
from oreflow.plans.features import FEATURES_SQL, TRAINING_SQL, rounded, training_rows, with_features
from oreflow.registry import query
from oreflow.session import scratch
from oreflow.sources import files
from oreflow.sources import tables as src
from oreflow.streaming import runner

RULES = scoring.STATUS_RULES
OTHER_RULES = RULES.scaled(0.8)
LABEL = "device_operational_status"
MODEL = "device_status"
FUNCTION = "predict_status"
RUN_FACTORS = {"run_1": 0.5, "run_2": 0.75, "run_3": 1.0, "run_4": 1.5, "run_5": 2.0}

SCORED_SQL = TRAINING_SQL + f", scored AS (SELECT {LABEL} AS label, {RULES.sql()} AS prediction FROM training)"


def report_sql(scored: str, prefix: str = "") -> str:
    """Common table expressions: per class metrics of a relation with label and prediction."""
    return f"""{prefix}conf AS (SELECT label, prediction, COUNT(*) AS n FROM {scored} GROUP BY 1, 2),
{prefix}classes AS (SELECT label AS class FROM {prefix}conf UNION SELECT prediction FROM {prefix}conf),
{prefix}counts AS (SELECT class,
  COALESCE((SELECT SUM(n) FROM {prefix}conf WHERE label = class AND prediction = class), 0)::DOUBLE AS tp,
  COALESCE((SELECT SUM(n) FROM {prefix}conf WHERE prediction = class), 0)::DOUBLE AS pred,
  COALESCE((SELECT SUM(n) FROM {prefix}conf WHERE label = class), 0)::DOUBLE AS sup FROM {prefix}classes),
{prefix}report AS (SELECT class, CASE WHEN pred = 0 THEN 0 ELSE tp / pred END AS p,
  CASE WHEN sup = 0 THEN 0 ELSE tp / sup END AS r,
  CASE WHEN pred + sup = 0 THEN 0 ELSE 2 * tp / (pred + sup) END AS f, sup FROM {prefix}counts)"""


def weighted_f1_sql(prefix: str = "") -> str:
    return f"(SELECT SUM(f * sup) / SUM(sup) FROM {prefix}report)"


def scored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = training_rows(spark, sf_dir)
    return rows.select(F.col(LABEL).alias("label"), RULES.column().alias("prediction"))


def _register(spark: SparkSession, rows: DataFrame) -> None:
    scoring.register_model(spark, FUNCTION, RULES.predict, rows.columns)


@query(TRAINING_SQL + f" SELECT id, {LABEL} AS label, {RULES.sql()} AS prediction FROM training")
def score_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model as a vectorised SQL function over all columns of the training set."""
    rows = training_rows(spark, sf_dir)
    _register(spark, rows)
    rows.createOrReplaceTempView("training_data")
    return spark.sql(f"SELECT id, {LABEL} AS label, {FUNCTION}(*) AS prediction FROM training_data")


@query(SCORED_SQL + " SELECT label, prediction, COUNT(*) AS n FROM scored GROUP BY 1, 2")
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by label and prediction over the view of batch predictions."""
    rows = training_rows(spark, sf_dir)
    _register(spark, rows)
    return metrics.confusion_counts(scoring.predictions_view(spark, "predictions", rows, FUNCTION, LABEL))


@query(SCORED_SQL + ", " + report_sql("scored") + """
    SELECT class, ROUND(p, 6) AS precision, ROUND(r, 6) AS recall, ROUND(f, 6) AS f1_score, CAST(sup AS BIGINT) AS support FROM report
    UNION ALL SELECT 'macro avg', ROUND(AVG(p), 6), ROUND(AVG(r), 6), ROUND(AVG(f), 6), CAST(SUM(sup) AS BIGINT) FROM report
    UNION ALL SELECT 'weighted avg', ROUND(SUM(p * sup) / SUM(sup), 6), ROUND(SUM(r * sup) / SUM(sup), 6),
      ROUND(SUM(f * sup) / SUM(sup), 6), CAST(SUM(sup) AS BIGINT) FROM report""")
def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision, recall, F1 and support per class with macro and weighted averages."""
    return rounded(metrics.classification_report(scored_rows(spark, sf_dir)), "precision", "recall", "f1_score")


@query(TRAINING_SQL + f""" SELECT * FROM (SELECT id, {LABEL} AS label, {RULES.sql()} AS prediction_1,
          {OTHER_RULES.sql()} AS prediction_2 FROM training) WHERE prediction_1 <> prediction_2""")
def model_disagreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows on which two models differ."""
    rows = training_rows(spark, sf_dir)
    different = scoring.disagreements(rows, RULES.column(), OTHER_RULES.column())
    return different.select("id", F.col(LABEL).alias("label"), "prediction_1", "prediction_2")


RUNS_SQL = (
    TRAINING_SQL
    + "".join(
        f", {run}_scored AS (SELECT {LABEL} AS label, {RULES.scaled(f).sql()} AS prediction FROM training), "
        + report_sql(f"{run}_scored", f"{run}_")
        for run, f in RUN_FACTORS.items()
    )
    + ", runs AS ("
    + " UNION ALL ".join(
        f"SELECT '{run}' AS run_id, AVG(f) AS macro_f1, SUM(f * sup) / SUM(sup) AS weighted_f1 FROM {run}_report"
        for run in RUN_FACTORS
    )
    + ")"
)


def rule_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of several rule models on the training set, all scored in one pass."""
    variants = {run: RULES.scaled(f).column() for run, f in RUN_FACTORS.items()}
    scored = scoring.score_all(training_rows(spark, sf_dir), LABEL, variants)
    confusion = scored.groupBy("run_id", "label", "prediction").agg(F.count("*").alias("n"))
    return metrics.report_summary(metrics.class_report(confusion, "run_id"), "run_id")


@query(RUNS_SQL + """ SELECT run_id, ROUND(macro_f1, 6) AS macro_avg__f1_score, ROUND(weighted_f1, 6) AS weighted_avg__f1_score
          FROM runs WHERE macro_f1 > 0.05 ORDER BY macro_f1 DESC, run_id LIMIT 1""")
def best_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best of the recorded runs above a bound (a top-1 report)."""
    table = VersionedTable.create(spark, scratch(spark, "runs"), rule_runs(spark, sf_dir))
    best = models.search_runs(table.read(), "macro_avg__f1_score", above=0.05).limit(1)
    return rounded(best, "macro_avg__f1_score", "weighted_avg__f1_score").select(
        "run_id", "macro_avg__f1_score", "weighted_avg__f1_score"
    )


@query(RUNS_SQL + f""" SELECT '{MODEL}' AS model, 1 AS version, 'Archived' AS stage,
          (SELECT run_id FROM runs ORDER BY macro_f1, run_id LIMIT 1) AS run_id
          UNION ALL SELECT '{MODEL}', 2, 'Production', (SELECT run_id FROM runs ORDER BY macro_f1 DESC, run_id LIMIT 1)""")
def promote_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Worst run put into production as version 1, then replaced by the best one as version 2."""
    runs = VersionedTable.create(spark, scratch(spark, "runs"), rule_runs(spark, sf_dir)).read()
    versions = models.ModelVersions(spark, scratch(spark, "model-versions"))
    for ascending in (True, False):
        run = models.search_runs(runs, "macro_avg__f1_score", ascending=ascending).first()
        versions.promote(MODEL, versions.register(MODEL, run.run_id))
    return versions.rows()


@query(SCORED_SQL + ", " + report_sql("scored") + f""" SELECT ROUND({weighted_f1_sql()}, 6) AS score,
          {weighted_f1_sql()} < {drift.DEFAULT_THRESHOLD} AS need_retrain""")
def drift_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted F1 of the model on the current training set against the retraining threshold."""
    report = metrics.report_summary(metrics.class_report(metrics.confusion_counts(scored_rows(spark, sf_dir))))
    score = F.col("weighted_avg__f1_score")
    return report.select(F.round(score, 6).alias("score"), (score < drift.DEFAULT_THRESHOLD).alias("need_retrain"))


@query(SCORED_SQL + ", " + report_sql("scored") + f""" SELECT ROUND({weighted_f1_sql()}, 6) AS score, {weighted_f1_sql()} < t AS needed_retrain
          FROM (SELECT UNNEST([0.01, {drift.RUN_THRESHOLD}]) AS t)""")
def performance_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of two checks with different thresholds, appended to the performance table."""
    log = VersionedTable(spark, scratch(spark, "performance"))
    for threshold in (0.01, drift.RUN_THRESHOLD):
        drift.monitor(scored_rows(spark, sf_dir), log, threshold=threshold)
    return log.read().orderBy("ts").select(F.round("score", 6).alias("score"), "needed_retrain")


def _drift_step_sql(step: int) -> str:
    scaled = "reading_1" + "".join(f" * {f!r}::DOUBLE" for f in drift.DRIFT_FACTORS[:step])
    body = FEATURES_SQL.replace("value AS reading_1", "value" + scaled.removeprefix("reading_1") + " AS reading_1")
    body = body.replace("ROUND(w.m1, 6)", "w.m1")
    return f"""SELECT {step} AS step, ROUND(s, 6) AS score, s < {drift.RUN_THRESHOLD} AS need_retrain FROM ({body},
      training AS (SELECT r.*, f.* EXCLUDE (id) FROM readings r JOIN features f ON r.id = f.id),
      scored AS (SELECT {LABEL} AS label, {RULES.sql()} AS prediction FROM training),
      {report_sql("scored")} SELECT {weighted_f1_sql()} AS s)"""


@query(" UNION ALL ".join(_drift_step_sql(i) for i in range(1, len(drift.DRIFT_FACTORS) + 1)))
def drift_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four drift runs: readings scaled in the table, features and training set rebuilt, model checked."""
    table = VersionedTable.create(spark, scratch(spark, "readings"), src.sensor_readings(spark, sf_dir))
    checks = drift.drift_runs(table, with_features, RULES.column(), LABEL)
    rows = [(i, round(c.score, 6), c.need_retrain) for i, c in enumerate(checks, 1)]
    return spark.createDataFrame(rows, "step INT, score DOUBLE, need_retrain BOOLEAN")


@query(TRAINING_SQL + f" SELECT id, {LABEL} AS label, {RULES.sql()} AS prediction FROM training")
def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SQL function of ``score_udf`` on a stream of a table that starts with one row and then grows."""
    training = VersionedTable.create(spark, scratch(spark, "training"), training_rows(spark, sf_dir)).read()
    landing, out, checkpoint = scratch(spark, "feed"), scratch(spark, "scored"), scratch(spark, "checkpoint")
    seed = training.orderBy("id").limit(1)
    first_id = seed.first().id
    _register(spark, training)
    for rows in (seed, training.filter(F.col("id") > first_id)):
        files.land(rows, landing, "parquet")
        stream = runner.read_stream(spark, landing, training.schema)
        stream.createOrReplaceTempView("growing_table")
        scored = spark.sql(f"SELECT id, {LABEL} AS label, {FUNCTION}(*) AS prediction FROM growing_table")
        runner.append_to_files(scored, out, checkpoint)
    return spark.read.parquet(out)
