"""The physical plans that matter at scale."""

import os

import pytest

from oreflow.registry import all_queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES = all_queries()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture
def plan(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")  # as if no table were small
    yield lambda name: QUERIES[name].run(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    spark.conf.set(key, before)


LAZY = """sales_by_category sales_by_category_filtered popular_products monthly_sales top_sales gold_lines
orders_per_customer order_lines dedup_row_number find_duplicates window_means asof_features asof_range_join
training_set latest_per_key score_udf confusion_matrix classification_report drift_check windowed_counts""".split()


@pytest.mark.parametrize("name", LAZY)
def test_no_pairs_of_all_rows(plan, name):
    text = plan(name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_category_list_reaches_the_scan(plan):
    text = plan("sales_by_category_filtered")
    assert "In(p_type, [ECONOMY,PROMO])" in text
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double,l_extendedprice:double>" in text


def test_lines_are_added_up_before_the_first_shuffle(plan):
    lines = plan("sales_by_category").split("SortMergeJoin")[1].split("FileScan")[0]
    assert lines.index("Exchange") < lines.index("partial_sum")


def test_top_report_keeps_ten_rows_per_task(plan):
    assert "TakeOrderedAndProject(limit=10" in plan("top_sales")


def test_dedup_keeps_one_row_per_key_and_task(plan):
    text = plan("dedup_row_number")
    first_shuffle = text.split("SortMergeJoin")[1].split("FileScan")[0].split("Exchange")
    assert "WindowGroupLimit" in first_shuffle[-1] and "WindowGroupLimit" in first_shuffle[-2]


def test_order_time_is_converted_once_per_document(plan):
    text = plan("order_lines")
    assert text.index("Generate") < text.index("from_unixtime")


def test_features_join_on_device_and_window(plan):
    text = plan("asof_features")
    assert "SortMergeJoin [device_id" in text and "_own" in text.split("SortMergeJoin")[1][:80]
