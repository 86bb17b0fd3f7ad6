"""Classification metrics computed from confusion counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METRICS = ("precision", "recall", "f1_score", "support")


def confusion_counts(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return scored.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("n")
    )


def _ratio(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator == 0, 0.0).otherwise(numerator / F.nullif(denominator, F.lit(0)))


def class_report(confusion: DataFrame, *by: str) -> DataFrame:
    """Precision, recall, F1 and support of each class, 0 where undefined.

    A class that only occurs as prediction counts with support 0. ``by`` names extra columns of the
    confusion counts to report separately, such as the model.
    """
    zero = F.lit(0).cast("bigint")
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(zero)
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("actual"), zero.alias("predicted"), hit.alias("hit")),
        F.struct(F.col("prediction").alias("class"), zero.alias("actual"), F.col("n").alias("predicted"), zero.alias("hit")),
    )
    per_class = (
        confusion.select(*by, F.explode(sides).alias("s"))
        .groupBy(*by, F.col("s.class").alias("class"))
        .agg(F.sum("s.actual").alias("support"), F.sum("s.predicted").alias("predicted"), F.sum("s.hit").alias("hit"))
    )
    precision = _ratio(F.col("hit").cast("double"), F.col("predicted"))
    recall = _ratio(F.col("hit").cast("double"), F.col("support"))
    f1 = _ratio(2.0 * F.col("hit"), F.col("predicted") + F.col("support"))
    return per_class.select(
        *by,
        "class",
        precision.alias("precision"),
        recall.alias("recall"),
        f1.alias("f1_score"),
        "support",
    )


def report_summary(report: DataFrame, *by: str) -> DataFrame:
    """Macro and support-weighted averages of a class report, one row, names like ``macro_avg__recall``."""
    support = F.sum("support")
    out = []
    for m in METRICS[:3]:
        out.append(F.avg(m).alias(f"macro_avg__{m}"))
        out.append(_ratio(F.sum(F.col(m) * F.col("support")), support).alias(f"weighted_avg__{m}"))
    out += [support.alias("macro_avg__support"), support.alias("weighted_avg__support")]
    return report.groupBy(*by).agg(*out) if by else report.agg(*out)


def classification_report(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Class rows followed by the rows ``macro avg`` and ``weighted avg``."""
    report = class_report(confusion_counts(scored, label, prediction))
    summary = report_summary(report)
    averages = summary.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(f"{kind} avg").alias("class"), *[F.col(f"{kind}_avg__{m}").alias(m) for m in METRICS]
                    )
                    for kind in ("macro", "weighted")
                ]
            )
        ).alias("a")
    ).select("a.*")
    return report.unionByName(averages)


def weighted_f1(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> float:
    summary = report_summary(class_report(confusion_counts(scored, label, prediction)))
    return summary.first()["weighted_avg__f1_score"]
