"""Metrics, scoring, training, model records and drift."""

import pickle
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from oreflow.operators import drift, flat, learning, metrics, models, scoring, tpe
from oreflow.operators.dictionary import number_values
from oreflow.operators.ridge import RidgeClassifier, RidgeModel
from oreflow.operators.versioned import VersionedTable
from oreflow.registry import all_queries
from oreflow.sources import files


@pytest.fixture
def scored(spark):
    pairs = [("a", "a")] * 3 + [("a", "b")] + [("b", "b")] * 2 + [("b", "z")] * 2 + [("c", "a")]
    return spark.createDataFrame(pairs, "label STRING, prediction STRING")


def test_class_report(scored):
    got = {r["class"]: tuple(round(x, 4) for x in r[1:]) for r in metrics.classification_report(scored).collect()}
    assert got == {
        "a": (0.75, 0.75, 0.75, 4),
        "b": (0.6667, 0.5, 0.5714, 4),
        "c": (0.0, 0.0, 0.0, 1),
        "z": (0.0, 0.0, 0.0, 0),  # only ever predicted
        "macro avg": (0.3542, 0.3125, 0.3304, 9),
        "weighted avg": (0.6296, 0.5556, 0.5873, 9),
    }


def test_flattened_names(scored):
    summary = metrics.report_summary(metrics.class_report(metrics.confusion_counts(scored)))
    assert set(summary.columns) == {f"{k}_avg__{m}" for k in ("macro", "weighted") for m in metrics.METRICS}
    assert round(metrics.weighted_f1(scored), 4) == 0.5873


def test_drift_check_and_log(spark, scored, folder):
    log = VersionedTable(spark, f"{folder}/log")
    calls = []
    assert drift.monitor(scored, log, lambda: calls.append(1)).need_retrain
    assert not drift.monitor(scored, log, lambda: calls.append(1), threshold=0.5).need_retrain
    assert len(calls) == 1
    assert sorted(r.needed_retrain for r in log.read().collect()) == [False, True]


def test_rule_model_forms_agree(spark):
    df = spark.range(400).selectExpr(
        "id", "id * 0.7 AS reading_1", "id % 100 * 1.0 AS reading_2", "id % 30 * 1.0 AS reading_3",
        "id % 90 * 1.0 AS mean_5m_reading_1",
    )
    scoring.register_model(spark, "rules", scoring.STATUS_RULES.predict, df.columns)
    df.createOrReplaceTempView("rows_to_score")
    udf = spark.sql("SELECT id, rules(*) AS p FROM rows_to_score").collect()
    expr = df.select("id", scoring.STATUS_RULES.column().alias("p")).collect()
    assert sorted(udf) == sorted(expr)
    assert len({r.p for r in expr}) == 5


def test_rule_model_on_missing_values():
    rows = pd.DataFrame({"x": [None, 1.0, 3.0]}, dtype="float64")
    assert list(scoring.RuleModel((("x", 2.0, "hi"),), "lo").predict(rows)) == ["lo", "lo", "hi"]


def test_run_search(spark):
    runs = spark.createDataFrame([("r1", 0.4), ("r2", 0.9), ("r3", 0.7)], "run_id STRING, f1 DOUBLE")
    assert [r.run_id for r in models.search_runs(runs, "f1", above=0.5).collect()] == ["r2", "r3"]
    assert models.search_runs(runs, "f1", ascending=True).first().run_id == "r1"


def test_promotion_archives_the_old_version(spark, folder):
    versions = models.ModelVersions(spark, f"{folder}/v")
    for run in ("r1", "r2", "r3"):
        versions.promote("m", versions.register("m", run))
    assert versions.register("other", "x") == 1
    got = sorted((r.model, r.version, r.stage) for r in versions.rows().collect())
    assert got == [("m", 1, "Archived"), ("m", 2, "Archived"), ("m", 3, "Production"), ("other", 1, "None")]
    assert versions.production("m").run_id == "r3" and versions.production("other") is None


@pytest.fixture(scope="module")
def training(spark):
    return spark.range(600).selectExpr(
        "id",
        "CASE WHEN id % 3 = 0 THEN 'bad' WHEN id % 3 = 1 THEN 'good' ELSE 'odd' END AS device_operational_status",
        "CASE WHEN id % 2 = 0 THEN 'T' ELSE 'R' END AS device_type",
        "cast(id % 20 AS STRING) AS device_id",
        "(id % 3) * 10.0 + id % 2 AS reading_1",
        *[f"cast(id % 7 AS DOUBLE) AS {c}" for c in learning.CONTINUOUS[1:]],
    ).cache()


@pytest.mark.parametrize(
    "make, params",
    [
        (learning.linear_classifier, {"alpha": 0.001}),
        (learning.boosted_trees, {"n_estimators": 5, "max_depth": 2, "gamma": 0.0}),
        (learning.forest, {}),
    ],
)
def test_training_learns_a_plain_rule(training, make, params):
    model = learning.train(training, make(**params))
    assert learning.evaluate(model, training)["weighted_avg__f1_score"] > 0.95
    assert {r[0] for r in model.transform(training).select("predicted_label").distinct().collect()} == {
        "bad", "good", "odd"
    }


def test_unknown_values_are_encoded_and_kept(training):
    model = learning.train(training, learning.linear_classifier())
    assert model.encoding.sizes == {"device_type": 2, "device_id": 20} and model.encoding.width == 6 + 22
    new = training.limit(4).withColumn("device_id", F.lit("never seen"))
    new = new.withColumn("reading_1", F.lit(None).cast("double")).withColumn(learning.LABEL, F.lit("new"))
    new = new.unionByName(new.withColumn("device_type", F.lit(None)).withColumn(learning.LABEL, F.lit(None)))
    rows = model.transform(new).collect()
    assert len(rows) == 8 and {r.features.size for r in rows} == {28}
    assert sorted(sum(r.features.toArray()[6:]) for r in rows) == [0.0] * 4 + [1.0] * 4  # only the known device type
    assert all(r.predicted_label in ("bad", "good", "odd") for r in rows)


def test_dictionary_numbers_values_in_order(spark):
    rng = random.Random(4)
    values = [f"{rng.choice('abÉ日z')}{rng.randrange(10**6)}" for _ in range(3000)]
    rows = spark.createDataFrame([(v,) for v in [*values, values[0], None, ""]], "c STRING").repartition(7)
    found = {r.value: r["index"] for r in number_values(rows, "c").collect()}
    assert found == {v: k for k, v in enumerate(sorted({*values, ""}, key=str.encode))}
    assert number_values(rows.limit(0), "c").count() == 0


def ridge_by_hand(rows, settings):
    """Coefficients of the one-hot features written out, by the centred normal equations."""
    alpha, intercept, normalize = settings["alpha"], settings["fit_intercept"], settings["normalize"]
    numbers = [c for c in learning.CONTINUOUS]
    types, devices = sorted(rows.device_type.dropna().unique()), sorted(rows.device_id.dropna().unique())
    x = np.column_stack(
        [rows[c].fillna(rows[c].mean()) for c in numbers] + [rows.device_type == t for t in types] + [rows.device_id == d for d in devices]
    ).astype(float)
    classes = sorted(rows[learning.LABEL].unique())
    y = np.column_stack([np.where(rows[learning.LABEL] == c, 1.0, -1.0) for c in classes])
    means, targets = (x.mean(0), y.mean(0)) if intercept else (np.zeros(x.shape[1]), np.zeros(len(classes)))
    x = x - means
    scale = np.ones(x.shape[1])
    if normalize and intercept:
        scale = np.where((x**2).sum(0) > 1e-9, np.sqrt((x**2).sum(0)), 1)
    z = x / scale
    w = np.linalg.solve(z.T @ z + alpha * np.eye(z.shape[1]), z.T @ (y - targets)) / scale[:, None]
    return w, targets - means @ w, devices, classes


@pytest.mark.parametrize(
    "settings",
    [
        {"alpha": 1.0, "fit_intercept": True, "normalize": False},
        {"alpha": 0.3, "fit_intercept": True, "normalize": True},
        {"alpha": 0.5, "fit_intercept": False, "normalize": True},
    ],
)
def test_ridge_is_the_solution_of_all_features(spark, training, folder, settings):
    noisy = training.withColumn("reading_1", F.when(F.col("id") % 11 > 0, F.col("reading_1") + F.rand(7)))
    noisy = noisy.withColumn("device_id", F.when(F.col("id") % 13 > 0, F.col("device_id")))
    path = f"{folder}/rows"
    noisy.write.parquet(path)
    noisy = spark.read.parquet(path)
    model = learning.train(noisy, RidgeClassifier(**settings))
    w, intercept, devices, classes = ridge_by_hand(noisy.orderBy("id").toPandas(), settings)
    assert model.model.by == "device_id" and model.model.classes == classes
    own = model.model.weights
    if settings["fit_intercept"]:
        np.testing.assert_allclose(own[0], intercept, atol=1e-8)
        own = own[1:]
    np.testing.assert_allclose(own, w[: len(own)], atol=1e-8)
    offsets = {r.value: r.offsets for r in model.model.offsets.collect()}
    np.testing.assert_allclose([offsets[d] for d in devices], w[len(own) :], atol=1e-8)
    model.save(spark, f"{folder}/ridge")
    again = learning.TrainedModel.load(spark, f"{folder}/ridge")
    labels = lambda m: [r[0] for r in m.transform(noisy).orderBy("id").select("predicted_label").collect()]
    assert labels(model) == labels(again)


@pytest.mark.parametrize(
    "make", [lambda: learning.boosted_trees(4, 3, 0.0), lambda: learning.forest(5, 4), lambda: RidgeClassifier(0.5)], ids=["boosted", "forest", "ridge"]
)
def test_flat_models_predict_what_the_model_predicts(spark, training, folder, make):
    noisy = training.withColumn("reading_1", F.col("reading_1") + 30 * F.rand(3))
    noisy.withColumn("device_id", F.concat("device_id", F.lit("é"))).write.parquet(f"{folder}/rows")
    noisy = spark.read.parquet(f"{folder}/rows")
    model = learning.train(noisy.where("id < 500"), make())
    odd = noisy.withColumn("reading_2", F.when(F.col("id") % 3 > 0, F.col("reading_2")))
    odd = odd.withColumn("device_type", F.when(F.col("id") % 5 > 0, F.col("device_type")).otherwise(F.when(F.col("id") % 10 > 0, "X")))
    scoring.register_model(spark, "flat_model", flat.flatten(spark, model).predict, odd.columns)
    odd.createOrReplaceTempView("odd_rows")
    got = {r.id: r.p for r in spark.sql("SELECT id, flat_model(*) AS p FROM odd_rows").collect()}
    want = {r.id: r.predicted_label for r in model.transform(odd).select("id", "predicted_label").collect()}
    assert got == want and len(set(want.values())) == 3
    model.save(spark, f"{folder}/model")
    again = learning.TrainedModel.load(spark, f"{folder}/model").transform(odd)
    assert {r.id: r.predicted_label for r in again.select("id", "predicted_label").collect()} == want


def test_flat_ridge_of_a_category_with_very_many_values(spark, folder):
    """More values than a list of them should hold; missing, unknown and empty ones have no offset of their own."""
    numbers = F.array(*[F.pmod(F.xxhash64("id", F.lit(c)), F.lit(1000)) / 1000.0 for c in range(3)])
    offsets = spark.range(120_000).select(F.concat(F.lit("é"), F.col("id")).alias("value"), numbers.alias("offsets"))
    offsets.unionByName(spark.sql("SELECT CAST(NULL AS STRING) AS value, array(9D, 0D, 0D) AS offsets")).write.parquet(f"{folder}/offsets")
    weights = np.array([[0.4, 0.5, 0.45], [0.1, -0.1, 0.0]])
    many = spark.read.parquet(f"{folder}/offsets")
    rows = spark.range(5000).selectExpr(
        "id", "IF(id % 50 = 0, NULL, id % 7 * 1.0) AS x",
        "CASE WHEN id % 40 = 0 THEN NULL WHEN id % 41 = 0 THEN 'unknown' WHEN id % 42 = 0 THEN '' ELSE concat('é', id * 25) END AS device",
    )
    for table in (many, many.limit(0)):
        ridge = RidgeModel(["a", "b", "c"], [("", None), ("x", None)], {"x": 2.0}, "device", weights, table)
        flat_model = flat.flatten(spark, learning.TrainedModel(None, ridge))
        assert len(pickle.dumps(flat_model)) < 5000
        scoring.register_model(spark, "flat_ridge", flat_model.predict, rows.columns)
        rows.createOrReplaceTempView("many_devices")
        got = {r.id: r.p for r in spark.sql("SELECT id, flat_ridge(*) AS p FROM many_devices").collect()}
        want = {r.id: r.predicted_label for r in ridge.transform(rows).select("id", "predicted_label").collect()}
        assert got == want and len(got) == 5000


def test_vector_size_does_not_write_vectors_out(spark):
    """Written out, one of the vectors would be 16 GB."""
    vectors = [(Vectors.sparse(2_000_000_000, {5: 1.0}),), (Vectors.dense([1.0, 0.0, 2.0]),), (Vectors.sparse(4, {}),)]
    rows = spark.createDataFrame(vectors, ["features"])
    assert sorted(r[0] for r in rows.select(learning.vector_size("features")).collect()) == [3, 4, 2_000_000_000]


@pytest.mark.parametrize("make", [lambda: learning.boosted_trees(2, 2, 0.0), lambda: learning.forest(30, 3)], ids=["boosted", "forest"])
def test_trees_over_a_category_with_very_many_values(spark, folder, make):
    """One column per value, written out for each row, would be 40,000 columns of 44,000 rows."""
    rows = spark.range(44_000).selectExpr(
        "id", "IF(id < 4000, 'bad', 'good') AS device_operational_status", "IF(id % 2 = 0, 'T', 'R') AS device_type",
        "IF(id < 4000, 'hot', cast(id AS STRING)) AS device_id", *[f"pmod(xxhash64(id, {k}), 1000) / 10.0D AS {c}" for k, c in enumerate(learning.CONTINUOUS)],
    )
    rows.write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    model = learning.train(rows, make())
    assert model.encoding.width == 6 + 2 + 40_001
    asked = {test for g in model.model.groups for t in g for test in t.test}
    assert 7 in asked  # the device
    if isinstance(make(), learning.BoostedTrees):
        counts = model.transform(rows).groupBy(learning.LABEL, "predicted_label").count().collect()
        assert sorted(tuple(r) for r in counts) == [("bad", "bad", 4000), ("good", "good", 40_000)]


def test_a_tree_asks_for_the_split_that_brings_most(spark, folder):
    """The first node of a boosted tree against all splits of the columns written out."""
    rng = np.random.default_rng(5)
    x, device = rng.integers(0, 12, 300), rng.integers(0, 15, 300)
    y = np.where((device == 4) | (x > rng.integers(3, 14, 300)), "bad", "good")
    frame = pd.DataFrame({learning.LABEL: y, "device_type": "T", "device_id": [f"d{d:02}" for d in device]})
    for c in learning.CONTINUOUS:
        frame[c] = x * 1.0 if c == "reading_2" else 0.0
    model = learning.train(spark.createDataFrame(frame), learning.boosted_trees(1, 1, 0.0))
    target = np.where(y == "bad", 1.0, -1.0)
    inside = {("x", t + 0.5): x <= t for t in range(11)} | {("device", d): device == d for d in range(15)}
    drop = lambda m: target.var() - m.mean() * target[m].var() - (~m).mean() * target[~m].var()
    kind, at = max(inside, key=lambda k: drop(inside[k]))
    tree = model.model.groups[0][0]
    assert (tree.test[0], tree.threshold[0] if kind == "x" else tree.cut[0]) == (1 if kind == "x" else 7, at)
    means = [target[m].mean() for m in (inside[kind, at], ~inside[kind, at])]
    np.testing.assert_allclose([tree.value[k][0] for k in (tree.left[0], tree.right[0])], means)


def test_gamma_is_a_loss_added_up_over_rows(training):
    """As a mean per row, the preset would keep nearly every tree from splitting."""
    noisy = training.withColumn("reading_1", F.col("reading_1") + 15 * F.rand(3))
    rows = learning.TreeRows.fit(noisy)
    splits = lambda *params: sum(t.test[0] >= 0 for g in learning.boosted_trees(*params).fit(rows.binned).groups for t in g)
    assert splits(3, 1, 0.5) == splits(3, 1, 0.0) == 9
    assert splits(1, 1, 300.5) == 0  # more than half of 600 squared targets of 1


def test_trained_trees_are_all_of_the_preset(spark, monkeypatch):
    fitted, train = [], learning.train
    monkeypatch.setattr(learning, "train", lambda *a, **k: fitted.append(train(*a, **k)) or fitted[-1])
    all_queries()["train_trees"].run(spark, "/root/testdata/sf0.001")
    assert [len(g) for g in fitted[0].model.groups] == [20] * len(fitted[0].encoding.classes)


def test_search_returns_every_setting(training):
    settings = learning.candidates(3)
    result = learning.search(training, training, settings)
    assert len(result) == 3 and all(0 <= loss <= 1 for loss, _ in result)
    assert [loss for loss, _ in result] == sorted(loss for loss, _ in result)
    assert learning.candidates(20) == learning.candidates(20)


SPACE = {"x": tpe.Uniform(-5.0, 5.0), "k": tpe.Choice((1, 2, 3, 4, 5, 6)), "y": tpe.Uniform(0.0, 10.0)}


def bowl(s):
    return (s["x"] - 1.3) ** 2 + abs(s["k"] - 5) + abs(s["y"] - 7)


def test_guided_search_beats_random_settings():
    guided, blind = [], []
    for seed in range(20):
        trials = tpe.minimise(bowl, SPACE, 40, 4, seed)
        assert trials == tpe.minimise(bowl, SPACE, 40, 4, seed)
        assert [t.number for t in trials] == list(range(1, 41))
        assert all(part.holds(t.settings[c]) for t in trials for c, part in SPACE.items())
        guided.append(min(t.loss for t in trials))
        rng = random.Random(seed)
        blind.append(min(bowl({c: part.draw(rng) for c, part in SPACE.items()}) for _ in range(40)))
    assert sum(guided) < 0.5 * sum(blind)


def test_first_trials_spread_evenly():
    first = [tpe.propose(SPACE, [], [], k, 1)["x"] for k in range(1, 8)]
    assert first == [0.0, -2.5, 2.5, -3.75, 1.25, -1.25, 3.75]
    round_of = [t.settings for t in tpe.minimise(bowl, SPACE, 16, 4, 3)][12:]
    assert len({tuple(s.values()) for s in round_of}) > 1


class Died(Exception):
    pass


def test_drift_runs_are_taken_up_where_they_stopped(spark, training, folder):
    def runs(path, fail_at=None):
        calls = iter(range(100))

        def fit(rows):
            if next(calls) == fail_at:
                raise Died
            return learning.train(rows, learning.forest(5, 4))

        halves = lambda rows: (rows.where("id < 400"), rows.where("id >= 400"))
        table = VersionedTable(spark, f"{path}/readings")
        if not table.exists():
            VersionedTable.create(spark, table.path, training)
        # a fifth of the readings is another scale to the model, so it is retrained
        return drift.DriftRuns(
            spark, path, table, lambda rows: rows, halves, fit, learning.evaluate, learning.LABEL, "m", threshold=0.95, factors=(0.9, 0.2, 1.0)
        )

    whole = runs(f"{folder}/a")
    whole.run()
    broken = runs(f"{folder}/b", fail_at=1)
    with pytest.raises(Died):
        broken.run()
    assert broken.steps().count() < 3
    again = runs(f"{folder}/b")
    again.run()
    again.run()  # nothing is left to do
    rows = lambda r: sorted((s.step, round(s.score, 9), s.need_retrain, s.run_id, s.production_version) for s in r.steps().collect())
    assert rows(again) == rows(whole) and [r[0] for r in rows(whole)] == [1, 2, 3]
    assert any(r[2] for r in rows(whole)) and not all(r[2] for r in rows(whole))
    total = lambda rows: float(rows.agg(F.sum("reading_1")).first()[0])
    assert total(again.readings.read()) == total(whole.readings.read()) == pytest.approx(0.18 * total(training), rel=0.05)
    stages = sorted((v.version, v.stage) for v in again.versions.rows().collect())
    assert [s for _, s in stages].count("Production") == 1 and stages[-1][1] == "Production"


def test_run_record(spark, training, folder):
    run = learning.fit_and_record(training, training, learning.linear_classifier(), {"alpha": 1.0}, data_version=3)
    runs = VersionedTable(spark, f"{folder}/runs")
    models.record_run(runs, run.row(spark))
    models.record_run(runs, run.row(spark))
    row = runs.read().first()
    assert runs.read().count() == 2 and row.data_version == 3 and row.params == '{"alpha": 1.0}'
    assert 0 <= row.weighted_avg__f1_score <= 1


def test_schema_of_one_file_needs_a_file(spark, folder):
    (spark.range(0).write.mode("overwrite").json(f"{folder}/empty"))
    with pytest.raises(FileNotFoundError):
        files.schema_of_one_file(spark, f"{folder}/empty")


def test_levels_below_the_root_take_one_job_and_encoded_rows_are_taken(training, monkeypatch):
    encoded = learning.TreeRows.fit(training)
    fetched, fetch = [], type(training).toArrow

    def noted(rows):
        fetched.append(rows.columns)
        return fetch(rows)

    monkeypatch.setattr(type(training), "toArrow", noted)
    monkeypatch.setattr(learning.Encoding, "fit", None)  # not called again
    model = learning.train(training, learning.boosted_trees(n_estimators=1, max_depth=2, gamma=0.0), encoded=encoded)
    assert max(len(t.test) for g in model.model.groups for t in g) > 3  # there is a second level
    assert len(fetched) == 3  # bins and best values of the root, then both at once
