"""Scoring rows with a model: as a column expression, as a vectorised SQL function, on tables and streams."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RuleModel:
    """A rule list over numeric columns: the first column at or above its threshold names the status."""

    rules: tuple[tuple[str, float, str], ...]
    default: str

    def scaled(self, factor: float) -> RuleModel:
        return replace(self, rules=tuple((c, t * factor, s) for c, t, s in self.rules))

    def column(self) -> Column:
        """The rules as a Spark expression."""
        out = F.lit(self.default)
        for name, threshold, status in reversed(self.rules):
            out = F.when(F.col(name) >= threshold, status).otherwise(out)
        return out

    def predict(self, rows: pd.DataFrame) -> np.ndarray:
        """The rules on a batch of rows."""
        hits = [(rows[name] >= threshold).to_numpy() for name, threshold, _ in self.rules]
        return np.select(hits, [status for _, _, status in self.rules], default=self.default)

    def sql(self) -> str:
        cases = " ".join(f"WHEN {name} >= {threshold!r} THEN '{status}'" for name, threshold, status in self.rules)
        return f"CASE {cases} ELSE '{self.default}' END"


# The model most queries score with.
STATUS_RULES = RuleModel(
    (
        ("reading_1", 100.0, "error"),
        ("reading_2", 75.0, "purchase"),
        ("mean_5m_reading_1", 60.0, "click"),
        ("reading_3", 12.0, "signup"),
    ),
    "view",
)


def register_model(
    spark: SparkSession, name: str, predict: Callable[[pd.DataFrame], np.ndarray], columns: list[str]
) -> None:
    """Make a model callable in SQL; arguments come by position and are named for the model by ``columns``."""

    @F.pandas_udf("string")
    def score(*args: pd.Series) -> pd.Series:
        rows = pd.concat(args, axis=1)
        rows.columns = columns
        return pd.Series(predict(rows))

    spark.udf.register(name, score)


def predictions_view(spark: SparkSession, name: str, rows: DataFrame, function: str, label: str) -> DataFrame:
    """Temporary view with label and prediction of every row."""
    rows.createOrReplaceTempView(f"{name}_input")
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY VIEW {name} AS "
        f"SELECT {label} AS label, {function}(*) AS prediction FROM {name}_input"
    )
    return spark.table(name)


def disagreements(rows: DataFrame, first: Column, second: Column) -> DataFrame:
    """Rows on which two models differ, with both predictions."""
    both = rows.withColumn("prediction_1", first).withColumn("prediction_2", second)
    return both.filter(F.col("prediction_1") != F.col("prediction_2"))


def score_all(rows: DataFrame, label: str, models: dict[str, Column]) -> DataFrame:
    """One row per input row and model (run, label, prediction), made in one pass over the data."""
    runs = F.array(*[F.struct(F.lit(n).alias("run_id"), c.alias("prediction")) for n, c in models.items()])
    return rows.select(F.col(label).alias("label"), F.explode(runs).alias("r")).select("label", "r.*")
