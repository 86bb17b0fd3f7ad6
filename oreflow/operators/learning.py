"""Training of status classifiers: ridge by its closed form, trees by sums over columns, others with Spark MLlib."""

from __future__ import annotations

import json
import random
import threading
import uuid
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass
from multiprocessing.pool import ThreadPool

from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IndexToString, OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.operators import tpe
from oreflow.operators.dictionary import looked_up, number_values
from oreflow.operators.metrics import class_report, confusion_counts, report_summary
from oreflow.operators.ridge import MAX_DENSE, RidgeClassifier, RidgeModel
from oreflow.operators.trees import BinnedRows, BoostedTrees, Forest, TreesModel

# The label and the features every model is trained with.
LABEL = "device_operational_status"
CATEGORICAL = ("device_type", "device_id")
CONTINUOUS = (
    "reading_1",
    "reading_2",
    "reading_3",
    "mean_5m_reading_1",
    "mean_5m_reading_2",
    "mean_5m_reading_3",
)

#: Most values that a label may have; they are listed on the driver.
MAX_CLASSES = 1000


@dataclass(frozen=True)
class FeatureSpec:
    label: str = LABEL
    categorical: tuple[str, ...] = CATEGORICAL
    continuous: tuple[str, ...] = CONTINUOUS
    max_classes: int = MAX_CLASSES


def label_classes(rows: DataFrame, spec: FeatureSpec) -> list[str]:
    """The label's values in order; an error if there are too many to be classes."""
    values = rows.select(spec.label).distinct().limit(spec.max_classes + 1).collect()
    if len(values) > spec.max_classes:
        raise ValueError(f"{spec.label} has more than {spec.max_classes} values")
    return sorted(v[0] for v in values if v[0] is not None)


def column_means(rows: DataFrame, columns: Iterable[str]) -> dict[str, float]:
    """Mean of each number column, 0 if it has no value; what a missing value counts as."""
    means = rows.agg(*[F.avg(c).alias(c) for c in columns]).first().asDict()
    return {c: float(m or 0.0) for c, m in means.items()}


def vector_size(column: str) -> Column:
    """The length of a vector column, without writing out the zeros of a sparse one."""
    parts = F.unwrap_udt(column)
    return F.coalesce(parts["size"], F.size(parts["values"]))


@dataclass
class Encoding:
    """How rows become feature vectors: the numbers, then for each category column one column per value.

    The values of a category are numbered by a table of their own, however many there are (``dictionaries``, with
    ``sizes``); rows get their numbers by a join. A NULL or unknown category sets none of its columns, a missing
    number counts as the mean of the rows that the encoding was fitted on.
    """

    spec: FeatureSpec
    classes: list[str]
    means: dict[str, float]
    dictionaries: dict[str, DataFrame]
    sizes: dict[str, int]

    @classmethod
    def fit(cls, rows: DataFrame, spec: FeatureSpec = FeatureSpec()) -> Encoding:
        dictionaries = {c: number_values(rows, c) for c in spec.categorical}
        sizes = {c: d.count() for c, d in dictionaries.items()}
        return cls(spec, label_classes(rows, spec), column_means(rows, spec.continuous), dictionaries, sizes)

    @property
    def width(self) -> int:
        return len(self.spec.continuous) + sum(self.sizes.values())

    def origin(self, feature: int) -> tuple[str, int | None]:
        """The column that a feature comes from, and for a category the number of its value."""
        if feature < len(self.spec.continuous):
            return self.spec.continuous[feature], None
        feature -= len(self.spec.continuous)
        for c, size in self.sizes.items():
            if feature < size:
                return c, feature
            feature -= size
        raise IndexError("no such feature")

    @property
    def columns(self) -> list[str]:
        """The filled numbers, then the categories' numbers, as ``indexed`` names them."""
        return [f"{c}_filled" for c in self.spec.continuous] + [f"{c}_index" for c, size in self.sizes.items() if size]

    def indexed(self, rows: DataFrame) -> DataFrame:
        """Rows with the filled numbers, and of each category the value's number, its size for no or an unknown value."""
        out = rows
        for c in self.spec.continuous:
            out = out.withColumn(f"{c}_filled", F.coalesce(F.col(c).cast("double"), F.lit(self.means[c])))
        for c, size in self.sizes.items():
            if size:
                index = f"{c}_index"
                out = looked_up(out, c, self.dictionaries[c], index)
                out = out.withColumn(index, F.coalesce(F.col(index), F.lit(size)).cast("double"))
        return out

    def binned(self, rows: DataFrame) -> BinnedRows:
        """The rows with a known label, to fit trees on."""
        numbers = [f"{c}_filled" for c in self.spec.continuous]
        sizes = [size for size in self.sizes.values() if size]
        labels = F.array_position(F.array(*map(F.lit, self.classes)), F.col(self.spec.label).cast("string")) - 1
        known = self.indexed(rows).withColumn("_label", labels).where("_label >= 0")
        return BinnedRows.of(known, numbers, self.columns[len(numbers) :], sizes, "_label", len(self.classes))

    def transform(self, rows: DataFrame, fitting: bool = False) -> DataFrame:
        """Rows with ``features`` and ``label_index``; all rows, or to fit a model on only those with a known label."""
        out, inputs = self.indexed(rows), [f"{c}_filled" for c in self.spec.continuous]
        for c, size in self.sizes.items():
            if size:
                index = f"{c}_index"
                widest = rows.sparkSession.createDataFrame([(float(size - 1),)], f"{index} DOUBLE")
                # the number after the last stands for no value, which sets no column
                one_hot = OneHotEncoder(inputCol=index, outputCol=f"{c}_columns", handleInvalid="keep", dropLast=True)
                out = one_hot.fit(widest).transform(out)
                inputs.append(f"{c}_columns")
        out = VectorAssembler(inputCols=inputs, outputCol="features").transform(out)
        invalid = "skip" if fitting else "keep"
        label = StringIndexerModel.from_labels(self.classes, self.spec.label, "label_index", handleInvalid=invalid)
        extra = [c for c in out.columns if c.endswith(("_filled", "_columns")) and c in inputs]
        return label.transform(out).drop(*extra)

    def save(self, spark: SparkSession, path: str) -> None:
        parts = {"spec": asdict(self.spec), "classes": self.classes, "means": self.means, "sizes": self.sizes}
        spark.createDataFrame([(json.dumps(parts),)], "value STRING").coalesce(1).write.mode("overwrite").text(f"{path}/parts")
        for c, d in self.dictionaries.items():
            d.write.mode("overwrite").parquet(f"{path}/dictionary/{c}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Encoding:
        parts = json.loads(spark.read.text(f"{path}/parts").first().value)
        spec = FeatureSpec(**{k: tuple(v) if isinstance(v, list) else v for k, v in parts["spec"].items()})
        schema = "value STRING, index BIGINT"
        dictionaries = {c: spark.read.schema(schema).parquet(f"{path}/dictionary/{c}") for c in spec.categorical}
        return cls(spec, parts["classes"], parts["means"], dictionaries, parts["sizes"])


@dataclass
class TrainedModel:
    """A fitted classifier with what its input needs; ``transform`` adds ``prediction`` and ``predicted_label``."""

    encoding: Encoding | None
    model: Model | RidgeModel | TreesModel

    def transform(self, rows: DataFrame) -> DataFrame:
        if isinstance(self.model, RidgeModel):
            return self.model.transform(rows)
        names = IndexToString(inputCol="prediction", outputCol="predicted_label", labels=self.encoding.classes)
        if isinstance(self.model, TreesModel):
            scored = self.model.transform(self.encoding.indexed(rows), self.encoding.columns)
            return names.transform(scored).drop(*[f"{c}_filled" for c in self.encoding.spec.continuous])
        return names.transform(self.model.transform(self.encoding.transform(rows)))

    def save(self, spark: SparkSession, path: str) -> None:
        kind = {RidgeModel: "ridge", TreesModel: "trees"}.get(type(self.model), "encoded")
        spark.createDataFrame([(kind,)], "value STRING").coalesce(1).write.mode("overwrite").text(f"{path}/kind")
        if kind == "ridge":
            self.model.save(spark, f"{path}/ridge")
        else:
            self.encoding.save(spark, f"{path}/encoding")
            if kind == "trees":
                self.model.save(spark, f"{path}/trees")
            else:
                PipelineModel([self.model]).write().overwrite().save(f"{path}/model")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TrainedModel:
        kind = spark.read.text(f"{path}/kind").first().value
        if kind == "ridge":
            return cls(None, RidgeModel.load(spark, f"{path}/ridge"))
        if kind == "trees":
            return cls(Encoding.load(spark, f"{path}/encoding"), TreesModel.load(spark, f"{path}/trees"))
        return cls(Encoding.load(spark, f"{path}/encoding"), PipelineModel.load(f"{path}/model").stages[0])


def linear_classifier(alpha: float = 1.0, fit_intercept: bool = True, normalize: bool = True) -> LogisticRegression:
    """Linear classifier with a squared penalty of weight ``alpha``."""
    return LogisticRegression(
        labelCol="label_index",
        featuresCol="features",
        regParam=alpha,
        elasticNetParam=0.0,
        fitIntercept=fit_intercept,
        standardization=normalize,
        maxIter=20,
    )


def boosted_trees(n_estimators: int = 20, max_depth: int = 1, gamma: float = 0.5) -> BoostedTrees:
    """Boosted trees, one model per class; ``gamma`` is the least loss, summed over a node's rows, a split must take off."""
    return BoostedTrees(n_estimators, max_depth, gamma)


def forest(n_estimators: int = 20, max_depth: int = 5, gamma: float = 0.0) -> Forest:
    """Trees on drawn rows; each node asks for a third of all columns, as the root of all would rarely hold a number."""
    return Forest(n_estimators, max_depth, gamma)


@dataclass
class TreeRows:
    """Rows encoded to fit several tree models on."""

    encoding: Encoding
    binned: BinnedRows

    @classmethod
    def fit(cls, rows: DataFrame, spec: FeatureSpec = FeatureSpec()) -> TreeRows:
        rows = rows.where(F.col(spec.label).isNotNull())
        encoding = Encoding.fit(rows, spec)
        return cls(encoding, encoding.binned(rows))


def train(
    rows: DataFrame,
    estimator: Estimator | RidgeClassifier | BoostedTrees | Forest,
    spec: FeatureSpec = FeatureSpec(),
    encoded: TreeRows | None = None,
) -> TrainedModel:
    """A model fitted on the rows that have a label; for trees the rows may be ``encoded`` before."""
    if isinstance(estimator, RidgeClassifier):
        return TrainedModel(None, train_ridge(rows, estimator, spec))
    if isinstance(estimator, (BoostedTrees, Forest)):
        encoded = encoded or TreeRows.fit(rows, spec)
        return TrainedModel(encoded.encoding, estimator.fit(encoded.binned))
    rows = rows.where(F.col(spec.label).isNotNull())
    encoding = Encoding.fit(rows, spec)
    return TrainedModel(encoding, estimator.fit(encoding.transform(rows, fitting=True)))


def train_ridge(rows: DataFrame, estimator: RidgeClassifier, spec: FeatureSpec) -> RidgeModel:
    """The category column with most values may have any number of them; the others' are written out."""
    rows = rows.where(F.col(spec.label).isNotNull())
    counts = rows.agg(*[F.count_distinct(c).alias(c) for c in spec.categorical]).first().asDict() if spec.categorical else {}
    by = max(counts, key=lambda c: counts[c], default=None)
    categories = {}
    for c in spec.categorical:
        if c != by:
            values = rows.select(F.col(c).cast("string")).distinct().limit(MAX_DENSE + 1).collect()
            categories[c] = sorted(v[0] for v in values if v[0] is not None)
    return estimator.fit(rows, spec.label, label_classes(rows, spec), column_means(rows, spec.continuous), categories, by)


def evaluate(model: TrainedModel, rows: DataFrame, label: str = LABEL) -> dict[str, float]:
    """Averages of the classification report, by flattened name."""
    confusion = confusion_counts(model.transform(rows), label, "predicted_label")
    return report_summary(class_report(confusion)).first().asDict()


@dataclass(frozen=True)
class Run:
    run_id: str
    run_name: str
    model: TrainedModel
    params: dict
    metrics: dict[str, float]
    data_version: int | None

    def row(self, spark) -> DataFrame:
        """The run as a record: names, parameters as JSON, version of the training table, metrics."""
        metrics = {k: float(v) for k, v in self.metrics.items()}
        schema = "run_id STRING, run_name STRING, params STRING, data_version BIGINT, " + ", ".join(
            f"{k} DOUBLE" for k in metrics
        )
        values = (self.run_id, self.run_name, json.dumps(self.params, sort_keys=True), self.data_version)
        return spark.createDataFrame([(*values, *metrics.values())], schema)


def fit_and_record(
    train_rows: DataFrame,
    test_rows: DataFrame,
    estimator: Estimator | RidgeClassifier | BoostedTrees | Forest,
    params: dict,
    run_name: str = "single run",
    data_version: int | None = None,
    spec: FeatureSpec = FeatureSpec(),
) -> Run:
    model = train(train_rows, estimator, spec)
    return Run(uuid.uuid4().hex, run_name, model, params, evaluate(model, test_rows, spec.label), data_version)


# The search space of the tree model and the number of trials.
SPACE = {
    "n_estimators": tpe.Choice(tuple(range(1, 15))),
    "max_depth": tpe.Choice((1, 2, 3)),
    "gamma": tpe.Uniform(0.01, 1.0),
}
TRIALS = 20


def candidates(trials: int = TRIALS, seed: int = 42) -> list[dict]:
    """Random settings of the tree model from its search space."""
    rng = random.Random(seed)
    return [{name: part.draw(rng) for name, part in SPACE.items()} for _ in range(trials)]


def losses(
    train_rows: DataFrame, test_rows: DataFrame, make: Callable[..., Estimator | BoostedTrees | Forest] = boosted_trees, spec: FeatureSpec = FeatureSpec()
) -> tuple[Callable[[dict], float], Callable[[], None]]:
    """The loss of a setting, 1 - weighted F1 on the later rows, and what frees the encoded rows when done.

    Features are encoded once for all settings.
    """
    train_rows = train_rows.where(F.col(spec.label).isNotNull())
    encoding = Encoding.fit(train_rows, spec)
    names = IndexToString(inputCol="prediction", outputCol="predicted_label", labels=encoding.classes)
    made: dict[str, object] = {}
    kept: list[DataFrame] = []
    lock = threading.Lock()

    def once(name: str, build: Callable[[], object]):
        with lock:
            if name not in made:
                made[name] = build()
                if isinstance(made[name], DataFrame):
                    kept.append(made[name].persist())
            return made[name]

    def scored(estimator: Estimator | BoostedTrees | Forest) -> DataFrame:
        if isinstance(estimator, (BoostedTrees, Forest)):
            model = estimator.fit(once("binned", lambda: encoding.binned(train_rows)))
            test = once("indexed test", lambda: encoding.indexed(test_rows).select(*encoding.columns, spec.label))
            return model.transform(test, encoding.columns)
        keep = ["features", "label_index", spec.label]
        encoded = once("encoded", lambda: encoding.transform(train_rows, fitting=True).select(*keep))
        return estimator.fit(encoded).transform(once("encoded test", lambda: encoding.transform(test_rows).select(*keep)))

    def loss(params: dict) -> float:
        confusion = confusion_counts(names.transform(scored(make(**params))), spec.label, "predicted_label")
        return 1 - report_summary(class_report(confusion)).first()["weighted_avg__f1_score"]

    def free() -> None:
        for rows in kept:
            rows.unpersist()

    return loss, free


def search(
    train_rows: DataFrame,
    test_rows: DataFrame,
    settings: Iterable[dict],
    make: Callable[..., Estimator | BoostedTrees | Forest] = boosted_trees,
    parallelism: int = 4,
    spec: FeatureSpec = FeatureSpec(),
) -> list[tuple[float, dict]]:
    """Loss of every given setting, best first; each fit is a set of Spark jobs and a few run at a time."""
    loss, free = losses(train_rows, test_rows, make, spec)
    try:
        settings = list(settings)
        with ThreadPool(parallelism) as pool:
            found = pool.map(loss, settings)
    finally:
        free()
    return sorted(zip(found, settings), key=lambda pair: (pair[0], sorted(pair[1].items())))


def guided_search(
    train_rows: DataFrame,
    test_rows: DataFrame,
    trials: int = TRIALS,
    make: Callable[..., Estimator | BoostedTrees | Forest] = boosted_trees,
    space: dict[str, tpe.Choice | tpe.Uniform] = SPACE,
    parallelism: int = 4,
    seed: int = 42,
    spec: FeatureSpec = FeatureSpec(),
) -> list[tpe.Trial]:
    """Trials of a model-based search in the order they were proposed."""
    loss, free = losses(train_rows, test_rows, make, spec)
    try:
        return tpe.minimise(loss, space, trials, parallelism, seed)
    finally:
        free()
