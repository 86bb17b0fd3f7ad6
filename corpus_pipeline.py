"""A corpus from raw documents to packed training sequences, in stages that each read what the one before kept.

Every stage takes (spark, docs, sf_dir) and returns the documents it keeps, with all their columns; the last one
returns the packed pieces. Rows that share an id are one document to the filters: if one goes, all go;
only near duplicates are told by id and text. Rows without
an id are never filtered out. Null and empty texts pass the filters, and pack as their end mark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.llm.common import discard, ship, small, stored, table
from oreflow.llm.leaks import decontaminate
from oreflow.llm.lines import dedup_lines
from oreflow.llm.near import near_duplicates, text_key
from oreflow.llm.packing import pack_documents
from oreflow.llm.toxicity import score_toxicity
from oreflow.session import prepare


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    return docs.join(small(stored(ids.distinct(), "rejected")), "doc_id", "left_anti").select(docs.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model fitted on ``labels`` doesn't call toxic."""
    scored = score_toxicity(docs, table(spark, sf_dir, "labels"))
    return without(docs, scored.where("predicted = 1").select("doc_id"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that resemble an earlier one; a document of which nothing is left goes."""
    ship(prepare(spark))
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    done = dedup_lines(docs, carry=others).where("n_lines = 0 or size(removed) < n_lines")
    values = {"doc_id": F.col("doc_id"), "text": F.col("kept"), **{c: F.col(f"carry.`{c}`") for c in others}}
    if "n_chars" in values:
        values["n_chars"] = F.length("kept").cast(docs.schema["n_chars"].dataType)
    return done.select(*(values[c].alias(c) for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id; of several texts of it one.

    Goes by id and text: a text is not lost because another one of the same id is a duplicate.
    """
    ship(prepare(spark))
    key = "text_key"
    while key in docs.columns:  # a column of the documents keeps its name and values
        key += "_"
    found = stored(near_duplicates(docs, named=True).withColumnRenamed("text_key", key), "components")
    row = ["doc_id", key]
    first = found.where("doc_id = component_id and component is not null").groupBy("component", "doc_id")
    first = first.agg(F.min(key).alias("first"), F.max(key).alias("last")).where("first <> last")
    later = found.join(small(stored(first, "several")), ["component", "doc_id"]).where(F.col(key) != F.col("first"))
    gone = stored(found.where("doc_id <> component_id").select(row).unionByName(later.select(row)).distinct(), "rejected")
    again = stored(found.where("doc_id is not null").groupBy(row).count().where("count > 1").select(row), "again")
    kept = docs.withColumn(key, text_key("text")).join(small(gone), row, "left_anti")
    if again.isEmpty():
        return kept.select(docs.columns)
    once = kept.join(small(again), row, "left_semi").dropDuplicates(row)
    return kept.join(small(again), row, "left_anti").unionByName(once).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    return without(docs, decontaminate(docs, table(spark, sf_dir, "benchmark")).select("doc_id"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes."""
    ship(prepare(spark))
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("near duplicates", near_dedup),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packing),
]

#: A fitted model and a search for good packings can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and read again; what a stage has read is deleted."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        read, docs = docs, stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if k:
            discard(read)
    return docs
