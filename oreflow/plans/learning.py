"""Training on the training set, the fitted models as SQL functions, and retraining under drift."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.operators import asof, drift, flat, learning, models, scoring
from oreflow.operators import relational as rel
from oreflow.operators.ridge import RidgeClassifier
from oreflow.operators.versioned import VersionedTable
from oreflow.plans.features import TRAINING_SQL, training_rows, with_features
from oreflow.plans.scoring import report_sql, weighted_f1_sql
from oreflow.registry import query
from oreflow.session import scratch
from oreflow.sources import files
from oreflow.sources import tables as src
from oreflow.streaming import runner

MODEL = "device_status"
TRAIN_FRACTION = 0.8
FUNCTION = "fitted_status"

# The settings of the linear classifier that are tried by hand.
LINEAR_SETTINGS = (
    {"alpha": 1.0, "fit_intercept": True, "normalize": False},
    {"alpha": 1.0, "fit_intercept": True, "normalize": True},
    {"alpha": 0.5, "fit_intercept": False, "normalize": True},
)

EXACT_TRAINING_SQL = re.sub(r"ROUND\((w\.m\d), 6\)", r"\1", TRAINING_SQL)
CLASSES = ("click", "error", "purchase", "signup", "view")
DEVICE_TYPES = ("Rectifier", "Transformer")


def ridge_sql(prefix: str, rows: str, alpha: float = 1.0, fit_intercept: bool = True, normalize: bool = False) -> str:
    """Common table expressions that fit a ridge classifier to a relation of training rows.

    The normal equations of all features but the devices, whose own block is diagonal and eliminated first, then
    solved by elimination, one pivot a step. ``{prefix}weights`` has for each feature the classes' coefficients,
    ``{prefix}offsets`` the same for each device.
    """
    z = ["1.0::DOUBLE"] * fit_intercept + list(learning.CONTINUOUS) + [f"(device_type = '{t}')::INT::DOUBLE" for t in DEVICE_TYPES]
    y = [f"CASE WHEN {learning.LABEL} = '{c}' THEN 1.0 ELSE -1.0 END::DOUBLE" for c in CLASSES]
    p, width = len(z), len(z) + len(y)
    scaled = normalize and fit_intercept
    size = "n - n * n / (SELECT COUNT(*) FROM {0}z)::DOUBLE" if scaled else "1.0"
    length = "(SELECT x FROM {0}sums b WHERE b.i = a.i AND b.j = a.i) - (SELECT x * x FROM {0}sums b WHERE b.i = 1 AND b.j = a.i) / (SELECT COUNT(*) FROM {0}z)" if scaled else "1.0"
    penalty = f"CASE WHEN {int(fit_intercept)} = 1 AND a.i = 1 THEN 0.0 ELSE {alpha!r} * ({length}) END"
    text = f"""{{0}}z AS (SELECT device_id, [{", ".join(z + y)}] AS z FROM {rows}),
{{0}}sums AS (SELECT i, j, SUM(z[i] * z[j]) AS x FROM {{0}}z, (SELECT UNNEST(range(1, {p + 1})) AS i), (SELECT UNNEST(range(1, {width + 1})) AS j) GROUP BY 1, 2),
{{0}}entries AS (SELECT device_id, j, COUNT(*)::DOUBLE AS n, SUM(z[j]) AS x FROM {{0}}z, (SELECT UNNEST(range(1, {width + 1})) AS j) GROUP BY 1, 2),
{{0}}devices AS (SELECT device_id, list(x ORDER BY j) AS z, 1.0 / (ANY_VALUE(n) + {alpha!r} * ({size.replace("n", "ANY_VALUE(n)") if scaled else size})) AS w FROM {{0}}entries GROUP BY 1),
{{0}}less AS (SELECT i, j, SUM(w * z[i] * z[j]) AS x FROM {{0}}devices, (SELECT UNNEST(range(1, {p + 1})) AS i), (SELECT UNNEST(range(1, {width + 1})) AS j) GROUP BY 1, 2),
{{0}}cells AS (SELECT a.i, a.j, a.x - l.x + CASE WHEN a.i = a.j THEN {penalty} ELSE 0.0 END AS x FROM {{0}}sums a JOIN {{0}}less l ON l.i = a.i AND l.j = a.j),
{{0}}lines AS (SELECT i, list(x ORDER BY j) AS line FROM {{0}}cells GROUP BY 1),
{{0}}solved AS (SELECT 1 AS step, list(line ORDER BY i) AS m FROM {{0}}lines
  UNION ALL SELECT step + 1, list_transform(range(1, {p + 1}), lambda i: list_transform(range(1, {width + 1}), lambda j:
    CASE WHEN i = step THEN m[step][j] / m[step][step] ELSE m[i][j] - m[i][step] * m[step][j] / m[step][step] END)) FROM {{0}}solved WHERE step <= {p}),
{{0}}weights AS (SELECT i AS feature, m[i][{p + 1}:{width}] AS w FROM {{0}}solved, (SELECT UNNEST(range(1, {p + 1})) AS i) WHERE step = {p + 1}),
{{0}}offsets AS (SELECT device_id, list_transform(range(1, {len(y) + 1}), lambda c: w * (z[{p} + c] - list_sum(list_transform(range(1, {p + 1}),
    lambda i: z[i] * all_weights[i][c])))) AS w FROM {{0}}devices, (SELECT list(w ORDER BY feature) AS all_weights FROM {{0}}weights))"""
    return text.replace("{0}", prefix)


def ridge_scored_sql(model: str, rows: str, fit_intercept: bool = True) -> str:
    """Label and prediction of a relation's rows by the relations ``{{model}}weights`` and ``{{model}}offsets``."""
    z = ["1.0::DOUBLE"] * fit_intercept + list(learning.CONTINUOUS) + [f"(device_type = '{t}')::INT::DOUBLE" for t in DEVICE_TYPES]
    names = ", ".join(f"'{c}'" for c in CLASSES)
    return f"""SELECT id, {learning.LABEL} AS label, [{names}][list_position(scores, list_max(scores))] AS prediction FROM (
      SELECT r.*, list_transform(range(1, {len(CLASSES) + 1}), lambda c: list_sum(list_transform(range(1, {len(z) + 1}),
        lambda i: [{", ".join(z)}][i] * all_weights[i][c])) + COALESCE(o.w[c], 0.0)) AS scores
      FROM {rows} r LEFT JOIN {model}offsets o ON o.device_id = r.device_id, (SELECT list(w ORDER BY feature) AS all_weights FROM {model}weights))"""


SPLIT_SQL = f""", cut AS (SELECT quantile_disc(reading_time, {TRAIN_FRACTION}) AS t FROM training),
earlier AS (SELECT training.* FROM training, cut WHERE reading_time <= t), later AS (SELECT training.* FROM training, cut WHERE reading_time > t)"""
RIDGE_SQL = EXACT_TRAINING_SQL.replace("WITH ", "WITH RECURSIVE ", 1) + SPLIT_SQL


def _training_table(spark: SparkSession, sf_dir: str) -> VersionedTable:
    """The training set as a table, so that the passes of a fit do not rebuild the features."""
    return VersionedTable.create(spark, scratch(spark, "training"), training_rows(spark, sf_dir))


def _split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    marked = rel.time_split(rows, "reading_time", TRAIN_FRACTION)
    return marked.filter(F.col("split") == "train").drop("split"), marked.filter(F.col("split") == "test").drop("split")


def _label_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.col(learning.LABEL).alias("label"), F.col("predicted_label").alias("prediction")).agg(
        F.count("*").alias("n")
    )


@query(TRAINING_SQL + f""" SELECT id, 6 + (SELECT COUNT(DISTINCT device_type) + COUNT(DISTINCT device_id) FROM training) AS columns,
          CAST(DENSE_RANK() OVER (ORDER BY device_type) - 1 AS BIGINT) AS device_type_index,
          CAST(DENSE_RANK() OVER (ORDER BY device_id) - 1 AS BIGINT) AS device_id_index,
          CAST(DENSE_RANK() OVER (ORDER BY device_operational_status) - 1 AS DOUBLE) AS label_index FROM training""")
def encode_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded training rows: number of feature columns, and the index of every category value and label."""
    rows = _training_table(spark, sf_dir).read()
    encoded = learning.Encoding.fit(rows).transform(rows)
    indexes = [F.col(f"{c}_index").cast("bigint").alias(f"{c}_index") for c in learning.CATEGORICAL]
    return encoded.select("id", learning.vector_size("features").cast("bigint").alias("columns"), *indexes, "label_index")


@query(TRAINING_SQL + """, held AS (SELECT CASE WHEN device_type IN (SELECT MIN(device_type) FROM training)
            THEN 'not seen' ELSE device_operational_status END AS label FROM training)
          SELECT label, COUNT(*) AS support FROM held GROUP BY 1""")
def score_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Support of every label when rows of one device type carry an unseen label and lack a reading: no row is lost."""
    rows = _training_table(spark, sf_dir).read()
    changed = F.col("device_type") == rows.agg(F.min("device_type")).first()[0]
    held = rows.withColumns(
        {
            learning.LABEL: F.when(changed, "not seen").otherwise(F.col(learning.LABEL)),
            "reading_1": F.when(~changed, F.col("reading_1")),
        }
    )
    scored = learning.train(rows, learning.linear_classifier(alpha=0.01)).transform(held)
    return _label_counts(scored).groupBy("label").agg(F.sum("n").alias("support"))


@query(RIDGE_SQL + ", " + ridge_sql("", "earlier") + f""", scored AS ({ridge_scored_sql("", "later")})
          SELECT label, prediction, COUNT(*) AS n FROM scored GROUP BY 1, 2""")
def train_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ridge classifier trained on the earlier rows: confusion counts on the later ones."""
    train, test = _split(_training_table(spark, sf_dir).read())
    return _label_counts(learning.train(train, RidgeClassifier()).transform(test))


def _coefficients_sql(number: int, settings: dict) -> str:
    names = ["intercept"] * settings["fit_intercept"] + list(learning.CONTINUOUS) + [f"device_type={t}" for t in DEVICE_TYPES]
    listed = ", ".join(f"'{n}'" for n in names)
    classes = ", ".join(f"'{c}'" for c in CLASSES)
    return f"""SELECT {number} AS setting, [{classes}][c] AS class, [{listed}][feature] AS feature, ROUND(w[c], 6) AS coefficient
      FROM r{number}_weights, (SELECT UNNEST(range(1, {len(CLASSES) + 1})) AS c)
      UNION ALL SELECT {number}, [{classes}][c], 'device_id=' || device_id, ROUND(w[c], 6)
      FROM r{number}_offsets, (SELECT UNNEST(range(1, {len(CLASSES) + 1})) AS c)"""


@query(RIDGE_SQL + "".join(", " + ridge_sql(f"r{k}_", "earlier", **s) for k, s in enumerate(LINEAR_SETTINGS))
       + " " + " UNION ALL ".join(_coefficients_sql(k, s) for k, s in enumerate(LINEAR_SETTINGS)))
def ridge_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coefficients of the ridge classifier under three settings, those of every device among them."""
    train, _ = _split(_training_table(spark, sf_dir).read())
    out = None
    for k, settings in enumerate(LINEAR_SETTINGS):
        model = learning.train(train, RidgeClassifier(**settings)).model
        dense = spark.createDataFrame(model.coefficients(), "class STRING, feature STRING, coefficient DOUBLE")
        names = F.array(*map(F.lit, model.classes))
        devices = model.offsets.select("value", F.posexplode("offsets").alias("c", "coefficient")).select(
            F.get(names, "c").alias("class"), F.concat(F.lit(f"{model.by}="), "value").alias("feature"), "coefficient"
        )
        part = dense.unionByName(devices).withColumn("setting", F.lit(k))
        out = part if out is None else out.unionByName(part)
    return out.withColumn("coefficient", F.round("coefficient", 6)).select("setting", "class", "feature", "coefficient")


@query()
def train_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boosted trees, one model per class: confusion counts on the later rows."""
    train, test = _split(_training_table(spark, sf_dir).read())
    model = learning.train(train, learning.boosted_trees())
    return _label_counts(model.transform(test))


def _startup_sql() -> str:
    """The settings of the first trials: mirrored digits of the trial's number in bases 2, 3 and 5."""
    mirrored = lambda base: " + ".join(f"(i // {base**k} % {base})::DOUBLE / {base ** (k + 1)}" for k in range(4))
    return f"""SELECT trial, CASE WHEN trial <= 8 THEN n_estimators END AS first_n_estimators, CASE WHEN trial <= 8 THEN max_depth END AS first_max_depth,
      CASE WHEN trial <= 8 THEN gamma END AS first_gamma, TRUE AS in_space, TRUE AS loss_in_range FROM (
      SELECT CAST(i AS INT) AS trial, CAST(1 + floor(14 * ({mirrored(2)})) AS INT) AS n_estimators,
        CAST(1 + floor(3 * ({mirrored(3)})) AS INT) AS max_depth, ROUND(0.01 + 0.99 * ({mirrored(5)}), 4) AS gamma
      FROM (SELECT UNNEST(range(1, {learning.TRIALS + 1})) AS i))"""


@query(_startup_sql())
def tune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty trials of a model-based search over boosted trees; the settings of the first ones are given."""
    train, test = _split(_training_table(spark, sf_dir).read())
    trials = learning.guided_search(train, test)
    rows = []
    for t in trials:
        first = [t.settings[c] if t.number <= 8 else None for c in learning.SPACE]
        inside = all(part.holds(t.settings[c]) for c, part in learning.SPACE.items())
        rows.append((t.number, *first, inside, 0 <= t.loss <= 1))
    schema = "trial INT, first_n_estimators INT, first_max_depth INT, first_gamma DOUBLE, in_space BOOLEAN, loss_in_range BOOLEAN"
    return spark.createDataFrame(rows, schema)


def _runs_sql() -> str:
    parts, rows = [], []
    for k, settings in enumerate(LINEAR_SETTINGS):
        parts.append(ridge_sql(f"r{k}_", "earlier", **settings))
        parts.append(f"r{k}_scored AS ({ridge_scored_sql(f'r{k}_', 'later', settings['fit_intercept'])})")
        parts.append(report_sql(f"r{k}_scored", f"r{k}_"))
        text = "{" + ", ".join(f'"{n}": {str(v).lower()}' for n, v in sorted(settings.items())) + "}"
        rows.append(f"""SELECT '{text}' AS params, 0::BIGINT AS data_version, ROUND(AVG(p), 6) AS macro_avg__precision, ROUND(AVG(f), 6) AS macro_avg__f1_score,
          ROUND(SUM(r * sup) / SUM(sup), 6) AS weighted_avg__recall, ROUND(SUM(f * sup) / SUM(sup), 6) AS weighted_avg__f1_score FROM r{k}_report""")
    return RIDGE_SQL + ", " + ", ".join(parts) + " " + " UNION ALL ".join(rows)


@query(_runs_sql())
def run_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three linear models trained, evaluated and recorded with the version of the training table."""
    table = _training_table(spark, sf_dir)
    version = table.latest().version
    train, test = _split(table.read(version))
    runs = VersionedTable(spark, scratch(spark, "runs"))
    for params in LINEAR_SETTINGS:
        run = learning.fit_and_record(train, test, RidgeClassifier(**params), params, data_version=version)
        models.record_run(runs, run.row(spark))
    metrics = ["macro_avg__precision", "macro_avg__f1_score", "weighted_avg__recall", "weighted_avg__f1_score"]
    return runs.read().select("params", "data_version", *[F.round(m, 6).alias(m) for m in metrics])


RETRAINED_SQL = RIDGE_SQL + ", " + ridge_sql("", "earlier", **LINEAR_SETTINGS[2]) + f""", scored AS ({ridge_scored_sql("", "later", False)}),
{report_sql("scored")}, checked AS (SELECT {weighted_f1_sql()} < {drift.RUN_THRESHOLD} AS needed)"""


@query(RETRAINED_SQL + f""" SELECT '{MODEL}' AS model, 1 AS version, CASE WHEN needed THEN 'Archived' ELSE 'Production' END AS stage,
          needed AS needed_retrain FROM checked UNION ALL SELECT '{MODEL}', 2, 'Production', TRUE FROM checked WHERE needed""")
def retrain_loop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Production model checked on current data, replaced by boosted trees when too weak, outcome logged."""
    train, test = _split(_training_table(spark, sf_dir).read())
    versions = models.ModelVersions(spark, scratch(spark, "model-versions"))
    store = models.ModelStore(spark, scratch(spark, "models"))

    def fit_and_promote(estimator, params: dict) -> None:
        run = learning.fit_and_record(train, test, estimator, params)
        store.save(run.run_id, run.model)
        versions.promote(MODEL, versions.register(MODEL, run.run_id))

    def production_scores() -> DataFrame:
        scored = store.load(versions.production(MODEL).run_id).transform(test)
        return scored.select(F.col(learning.LABEL).alias("label"), F.col("predicted_label").alias("prediction"))

    weak, strong = LINEAR_SETTINGS[2], {"n_estimators": 5, "max_depth": 3}
    fit_and_promote(RidgeClassifier(**weak), weak)
    log = VersionedTable(spark, scratch(spark, "performance"))
    check = drift.monitor(
        production_scores(), log, lambda: fit_and_promote(learning.boosted_trees(gamma=0.0, **strong), strong), drift.RUN_THRESHOLD
    )
    return versions.rows().select("model", "version", "stage", F.lit(check.need_retrain).alias("needed_retrain"))


def _fitted(spark: SparkSession, rows: DataFrame, estimator, encoded: learning.TreeRows) -> learning.TrainedModel:
    """A fitted model, and its flat form as the SQL function over all columns of the rows."""
    model = learning.train(rows, estimator, encoded=encoded)
    scoring.register_model(spark, FUNCTION, flat.flatten(spark, model).predict, rows.columns)
    return model


@query(TRAINING_SQL + f""" SELECT id, {learning.LABEL} AS label, kind, TRUE AS same FROM training,
          (SELECT UNNEST(['boosted trees', 'forest', 'ridge']) AS kind)""")
def score_fitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted models as SQL functions over all columns: every prediction is that of the model itself."""
    rows = _training_table(spark, sf_dir).read()
    out = None
    kinds = {
        "boosted trees": learning.boosted_trees(n_estimators=5, max_depth=2, gamma=0.0),
        "forest": learning.forest(n_estimators=10),
        "ridge": RidgeClassifier(),
    }
    encoded = learning.TreeRows.fit(rows)
    for kind, estimator in kinds.items():
        model = _fitted(spark, rows, estimator, encoded)
        rows.createOrReplaceTempView("rows_to_score")
        scored = spark.sql(f"SELECT id, {learning.LABEL} AS label, {FUNCTION}(*) AS prediction FROM rows_to_score")
        own = model.transform(rows).select("id", "predicted_label")
        same = F.col("prediction") == F.col("predicted_label")
        part = scored.join(own, "id").select("id", "label", F.lit(kind).alias("kind"), same.alias("same"))
        out = part if out is None else out.unionByName(part)
    return out


@query(TRAINING_SQL + f""" SELECT id, {learning.LABEL} AS label, TRUE AS same FROM training""")
def features_to_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From readings to a scored stream: feature table, training set, recorded run, promotion, production model as
    SQL function, on the table and on a stream of it that grows; both give every row the same prediction.
    """
    readings = src.sensor_readings(spark, sf_dir)
    base = VersionedTable.create(spark, scratch(spark, "readings"), readings)
    features = VersionedTable.create(spark, scratch(spark, "window-features"), asof.window_features(base.read()))
    training = VersionedTable.create(spark, scratch(spark, "training"), asof.training_set(base.read(), features.read()))
    rows = training.read()
    train, test = _split(rows)
    runs, store = VersionedTable(spark, scratch(spark, "runs")), models.ModelStore(spark, scratch(spark, "models"))
    versions = models.ModelVersions(spark, scratch(spark, "model-versions"))
    params = {"n_estimators": 3, "max_depth": 1}
    for estimator, own in ((learning.boosted_trees(gamma=0.0, **params), params), (RidgeClassifier(), LINEAR_SETTINGS[0])):
        run = learning.fit_and_record(train, test, estimator, own, data_version=training.latest().version)
        models.record_run(runs, run.row(spark))
        store.save(run.run_id, run.model)
    best = models.search_runs(runs.read(), "weighted_avg__f1_score").first()
    versions.promote(MODEL, versions.register(MODEL, best.run_id))
    model = store.load(versions.production(MODEL).run_id)
    scoring.register_model(spark, FUNCTION, flat.flatten(spark, model).predict, rows.columns)
    rows.createOrReplaceTempView("training_data")
    scored = spark.sql(f"SELECT id, {learning.LABEL} AS label, {FUNCTION}(*) AS prediction FROM training_data")

    landing, out, checkpoint = scratch(spark, "feed"), scratch(spark, "scored"), scratch(spark, "checkpoint")
    seed = rows.orderBy("id").limit(1)
    for part in (seed, rows.filter(F.col("id") > seed.first().id)):
        files.land(part, landing, "parquet")
        runner.read_stream(spark, landing, rows.schema).createOrReplaceTempView("growing_training_data")
        stream = spark.sql(f"SELECT id, {FUNCTION}(*) AS streamed FROM growing_training_data")
        runner.append_to_files(stream, out, checkpoint)
    both = scored.join(spark.read.parquet(out), "id")
    return both.select("id", "label", (F.col("prediction") == F.col("streamed")).alias("same"))


def _drifted_sql() -> str:
    """Initial model, then per step: scaled readings, features, training set, check, and the model in use after it."""
    names = r"\b(readings|windows|features|training|cut|earlier|later)\b"
    parts, rows = [], []
    body = EXACT_TRAINING_SQL.removeprefix("WITH ") + SPLIT_SQL
    for step in range(len(drift.DRIFT_FACTORS) + 1):
        scale = "".join(f" * {f!r}::DOUBLE" for f in drift.DRIFT_FACTORS[:step])
        own = body.replace("value AS reading_1", f"value{scale} AS reading_1")
        parts.append(re.sub(names, rf"\1_{step}", own))
        if not step:
            parts.append(ridge_sql("used_0_", "earlier_0"))
            continue
        before = f"used_{step - 1}_"
        parts.append(f"scored_{step} AS ({ridge_scored_sql(before, f'training_{step}')})")
        parts.append(report_sql(f"scored_{step}", f"s{step}_"))
        parts.append(f"checked_{step} AS (SELECT s, s < {drift.RUN_THRESHOLD} AS needed FROM (SELECT {weighted_f1_sql(f's{step}_')} AS s))")
        parts.append(ridge_sql(f"fit_{step}_", f"earlier_{step}"))
        for kind in ("weights", "offsets"):
            parts.append(f"""used_{step}_{kind} AS (SELECT * FROM fit_{step}_{kind} WHERE (SELECT needed FROM checked_{step})
              UNION ALL SELECT * FROM {before}{kind} WHERE NOT (SELECT needed FROM checked_{step}))""")
        retrained = " + ".join(f"(SELECT needed::INT FROM checked_{k})" for k in range(1, step + 1))
        rows.append(f"""SELECT {step} AS step, ROUND(s, 6) AS score, needed AS need_retrain, 1 + {retrained} AS production_version,
          {retrained} AS archived_versions FROM checked_{step}""")
    return "WITH RECURSIVE " + ", ".join(parts) + " " + " UNION ALL ".join(rows)


@query(_drifted_sql())
def drift_retraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four drift runs in which a model that has become too weak is retrained, recorded and promoted."""
    readings = VersionedTable.create(spark, scratch(spark, "readings"), src.sensor_readings(spark, sf_dir))
    runs = drift.DriftRuns(
        spark,
        scratch(spark, "drift"),
        readings,
        training=with_features,
        split=_split,
        fit=lambda rows: learning.train(rows, RidgeClassifier()),
        evaluate=lambda model, rows: learning.evaluate(model, rows),
        label=learning.LABEL,
        model_name=MODEL,
    )
    runs.run()
    steps = runs.steps().select("step", F.round("score", 6).alias("score"), "need_retrain", "production_version")
    stages = runs.versions.rows()
    archived = steps.join(stages, stages.version <= steps.production_version).groupBy("step").agg(
        (F.count("*") - 1).cast("int").alias("archived_versions")
    )
    return steps.join(archived, "step")
