"""The stages against what they promise, on the smallest tables."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from oreflow.llm.common import table
from oreflow.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


def test_stages_keep_columns_and_lose_only_what_they_reject(spark):
    docs = table(spark, SF_DIR, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns
        before, after = ({r.doc_id for r in x.select("doc_id").collect()} for x in (docs, out))
        assert after <= before and len(after) > 0.5 * len(before)
        docs = corpus_pipeline.stored(out, "stage")
    assert corpus_pipeline.packing(spark, docs, SF_DIR).select("doc_id").distinct().count() == docs.count()


def test_run(spark):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 100


def test_stages_on_odd_rows(spark, odd_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd_docs, no_docs):
            rows = stage(spark, docs, SF_DIR).collect()
            assert len(rows) <= max(docs.count(), 1) * 20, name
    kept = corpus_pipeline.near_dedup(spark, odd_docs, SF_DIR).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == [0, 1, 40]  # 52 is a copy of 0, 41 nearly one of 40


def test_queries_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 1 + len(numbers))) and set(ORACLES) <= set(QUERIES)


def test_columns_that_are_named_as_inside_keep_their_values(spark, docs, clashing):
    own = docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in clashing})
    for name, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, own, SF_DIR)
        assert out.columns == own.columns, name
        rows = out.select("doc_id", *clashing).collect()
        assert rows and all(r[c] == f"{c}{r.doc_id}" for r in rows for c in clashing), name
