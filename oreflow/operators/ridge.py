"""Ridge classifier by its closed form.

Each class has a linear function fitted by least squares to +1 on its rows and -1 on others, with a squared penalty;
the largest value wins. The sums of products of the features (the Gram matrix) are added up per partition and then
over partitions, and one small linear system gives the coefficients of all classes.

A category column with many values would make the matrix as large as the square of their number. But the one-hot
columns of one category never meet in a row, so their block of the matrix is diagonal and can be eliminated: what is
left is the Gram matrix of the other features, less one term per category value that needs only the value's row
count and sums. So one column may have any number of values (``by``); the others are written out as features.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.session import scratch

#: Features that are written out at most.
MAX_DENSE = 1000


def gram(rows: DataFrame, left: int) -> np.ndarray:
    """Sum over rows (z array<double>, w double) of w times the outer product of z's first ``left`` entries and z."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            z = batch.column("z").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            part = (z[:, :left] * batch.column("w").to_numpy(zero_copy_only=False)[:, None]).T @ z
            total = part if total is None else total + part
        if total is not None:
            i, j = np.indices(total.shape)
            columns = [pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())]
            yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "x"])

    parts = rows.select("z", "w").mapInArrow(sums, "i int, j int, x double")
    cells = parts.groupBy("i", "j").agg(F.sum("x").alias("x")).toArrow()
    width = max(cells.column("j").to_pylist(), default=left - 1) + 1
    out = np.zeros((left, width))
    out[cells.column("i").to_numpy(), cells.column("j").to_numpy()] = cells.column("x").to_numpy()
    return out


@dataclass(frozen=True)
class RidgeClassifier:
    """Settings: weight of the penalty, whether to fit an intercept, and whether columns are scaled to length 1.

    Scaling (which needs an intercept to have an effect) is that of the centred columns; it means that a column's
    penalty is multiplied with its squared length.
    """

    alpha: float = 1.0
    fit_intercept: bool = True
    normalize: bool = False

    def fit(self, rows: DataFrame, label: str, classes: list[str], numbers: dict[str, float], categories: dict[str, list[str]], by: str | None = None) -> RidgeModel:
        """Fit on the rows with a label.

        ``numbers`` maps number columns to what stands for a missing one, ``categories`` category columns to their
        values; ``by`` is the category column that may have any number of values. NULL and unknown categories set no
        feature.
        """
        features = [("", None)] * self.fit_intercept + [(c, None) for c in numbers]
        features += [(c, v) for c, values in categories.items() for v in values]
        if len(features) > MAX_DENSE:
            raise ValueError(f"more than {MAX_DENSE} features; give the column with most values as by")
        spark, p, k = rows.sparkSession, len(features), len(classes)
        targets = [F.when(F.col(label) == c, 1.0).otherwise(-1.0) for c in classes]
        z = F.array(*_columns(features, numbers), *targets)
        group = F.col(by).cast("string") if by else F.lit(None).cast("string")
        base = rows.where(F.col(label).isNotNull()).select(z.alias("z"), group.alias("value"), F.lit(1.0).alias("w"))
        total = gram(base, p)
        if total.shape[1] < p + k:
            raise ValueError("no rows with a label")
        n = base.count()
        scaled = self.normalize and self.fit_intercept
        penalty = np.full(p, self.alpha)
        if scaled:
            length = total.diagonal() - total[0, :p] ** 2 / n
            penalty = self.alpha * np.where(length > 1e-12 * n, length, 1.0)
        if self.fit_intercept:
            penalty[0] = 0.0
        groups = None
        if by:
            sums = [F.sum(F.get("z", i)).alias(f"z{i}") for i in range(p + k)]
            size = F.col("n") - F.col("n") * F.col("n") / F.lit(float(n)) if scaled else F.lit(1.0)
            size = F.when(size > 0, size).otherwise(1.0)
            grouped = base.where("value IS NOT NULL").groupBy("value").agg(F.count("*").alias("n"), *sums)
            grouped = grouped.select("value", F.array(*(f"z{i}" for i in range(p + k))).alias("z"), (1.0 / (F.col("n") + self.alpha * size)).alias("w"))
            path = scratch(spark, "groups")
            grouped.write.parquet(path)
            groups = spark.read.schema(grouped.schema).parquet(path)
            reduced = gram(groups, p)
            if reduced.shape == total.shape:
                total = total - reduced
        weights = np.linalg.solve(total[:, :p] + np.diag(penalty), total[:, p:])
        offsets = None
        if by:
            value = lambda c: _sum([F.get("z", p + c), *(F.get("z", i) * F.lit(-weights[i, c]) for i in range(p))]) * F.col("w")
            path = scratch(spark, "offsets")
            groups.select("value", F.array(*(value(c) for c in range(k))).alias("offsets")).write.parquet(path)
            offsets = spark.read.schema("value STRING, offsets ARRAY<DOUBLE>").parquet(path)
        return RidgeModel(list(classes), features, dict(numbers), by, weights, offsets)


@dataclass
class RidgeModel:
    """``weights`` by feature and class; ``offsets`` (value, offsets by class) of the column ``by``."""

    classes: list[str]
    features: list[tuple[str, str | None]]
    numbers: dict[str, float]
    by: str | None
    weights: np.ndarray
    offsets: DataFrame | None

    def scored(self, rows: DataFrame) -> DataFrame:
        """Rows with ``scores``, an array of one value per class."""
        out = rows
        if self.offsets is not None:
            entries = self.offsets.select(F.col("value").alias("_value"), F.col("offsets").alias("_offsets"))
            out = rows.join(entries, F.col(self.by).cast("string") == F.col("_value"), "left")
        values = _columns(self.features, self.numbers)
        scores = []
        for c in range(len(self.classes)):
            terms = [v * F.lit(float(self.weights[i, c])) for i, v in enumerate(values)]
            if self.offsets is not None:
                terms.append(F.coalesce(F.get("_offsets", c), F.lit(0.0)))
            scores.append(_sum(terms))
        return out.withColumn("scores", F.array(*scores)).drop("_value", "_offsets")

    def transform(self, rows: DataFrame) -> DataFrame:
        """Rows with the ``prediction`` (number of the first class with the largest score) and ``predicted_label``."""
        best = F.array_position("scores", F.array_max("scores"))
        names = F.array(*map(F.lit, self.classes))
        out = self.scored(rows).withColumn("prediction", (best - 1).cast("double"))
        return out.withColumn("predicted_label", F.get(names, F.col("prediction").cast("int"))).drop("scores")

    def coefficients(self) -> list[tuple[str, str, float]]:
        """(class, feature, coefficient) of the features that are written out."""
        names = ["intercept" if c == "" else c if v is None else f"{c}={v}" for c, v in self.features]
        return [(c, f, float(self.weights[i, k])) for i, f in enumerate(names) for k, c in enumerate(self.classes)]

    def save(self, spark: SparkSession, path: str) -> None:
        parts = {"classes": self.classes, "features": self.features, "numbers": self.numbers, "by": self.by, "weights": self.weights.tolist()}
        spark.createDataFrame([(json.dumps(parts),)], "value STRING").coalesce(1).write.mode("overwrite").text(f"{path}/parts")
        if self.offsets is not None:
            self.offsets.write.mode("overwrite").parquet(f"{path}/offsets")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> RidgeModel:
        parts = json.loads(spark.read.text(f"{path}/parts").first().value)
        offsets = spark.read.schema("value STRING, offsets ARRAY<DOUBLE>").parquet(f"{path}/offsets") if parts["by"] else None
        features = [tuple(f) for f in parts["features"]]
        return cls(parts["classes"], features, parts["numbers"], parts["by"], np.array(parts["weights"]), offsets)


def _columns(features: list[tuple[str, str | None]], numbers: dict[str, float]) -> list[Column]:
    """Each feature's value: the constant of the intercept, a number, or whether a category has a value."""
    out = []
    for column, value in features:
        if column == "":
            out.append(F.lit(1.0))
        elif value is None:
            out.append(F.coalesce(F.col(column).cast("double"), F.lit(float(numbers[column]))))
        else:
            out.append(F.when(F.col(column).cast("string") == value, 1.0).otherwise(0.0))
    return out


def _sum(terms: list[Column]) -> Column:
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out
