"""Sales operators on hand-made rows."""

import random

import pytest
from pyspark.sql import functions as F

from oreflow.functions.time import epoch_text_to_time_text, nanos_to_timestamp
from oreflow.operators import relational as rel
from oreflow.sources import orders as nested


def test_exploding_empty_and_missing_arrays(spark):
    product = "STRUCT<id: BIGINT, curr: STRING, price: DOUBLE, qty: DOUBLE, unit: STRING>"
    p = [(7, "USD", 2.5, 2.0, "pcs")]
    df = spark.createDataFrame(
        [(1, "0", 1, p * 2), (2, "", 2, []), (3, None, 3, None)],
        f"CustomerID INT, OrderDateTime STRING, OrderNo INT, OrderedProducts ARRAY<{product}>",
    )
    got = sorted((r.CustomerID, r.LineNo or 0, r.OrderAmount) for r in nested.order_lines(df).collect())
    assert got == [(1, 1, 5.0), (1, 2, 5.0), (2, 0, None), (3, 0, None)]


def test_epoch_text(spark):
    df = spark.createDataFrame([("1565816663",), ("",), (None,), ("x",)], "s STRING")
    got = [r[0] for r in df.select(epoch_text_to_time_text("s")).collect()]
    assert got == ["2019-08-14 21:04:23", None, None, None]


def test_nanos(spark):
    df = spark.createDataFrame([(1424686734992111222,)], "n BIGINT")
    assert df.select(nanos_to_timestamp("n").cast("string")).first()[0] == "2015-02-23 10:18:54.992111"


def test_month_and_exact_totals(spark):
    df = spark.createDataFrame(
        [("c", "p", "n", "2021-08-03 10:11:12", 1.0, 0.1), ("c", "p", "n", "2021-08-31 00:00:00", 2.0, 0.2),
         ("c", "p", "n", None, 1.0, -0.35)],
        "ProductCategory STRING, ProductName STRING, CustomerName STRING, OrderDateTime STRING, Quantity DOUBLE, "
        "OrderAmount DOUBLE",
    )
    got = {str(r.YearMonth): (r.Quantity, r.OrderAmount) for r in rel.monthly_sales(df).collect()}
    assert got == {"2021-08-01": (3.0, 0.3), "None": (1.0, -0.35)}


def test_totals_of_large_amounts(spark):
    df = spark.range(1000).select(F.lit(9e12 + 0.25).alias("a"))
    assert df.agg(rel.total("a").alias("t")).first().t == 9e15 + 250.0


def test_division_by_zero_is_null(spark):
    df = spark.createDataFrame([(10.0, 0.0)], "p DOUBLE, q DOUBLE")
    assert df.select(F.try_divide("p", "q")).first()[0] is None


def test_duplicates_and_uniqueness(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k INT, v STRING")
    assert [tuple(r) for r in rel.find_duplicates(df, "k").collect()] == [(1, 2)]
    with pytest.raises(rel.DuplicateKey):
        rel.require_unique(df, "k")
    assert rel.require_unique(df, "k", "v") is df
    assert sorted(tuple(r) for r in rel.keep_first(df, ["k"], ["v"]).collect()) == [(1, "a"), (2, "c")]


def test_dedup_sends_one_row_per_key_and_task(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    first = rel.keep_first(df, ["k"], ["v"])
    assert "WindowGroupLimit" in first._jdf.queryExecution().executedPlan().toString()
    assert sorted(tuple(r) for r in first.collect()) == [(0, 0), (1, 1)]


def test_unmatched_lines_form_the_null_category(spark):
    lines = spark.createDataFrame([(1, 2.0, 20.0), (9, 1.0, 5.0)], "ProductID BIGINT, Quantity DOUBLE, OrderAmount DOUBLE")
    products = spark.createDataFrame([(1, "A", "n")], "ProductID BIGINT, ProductCategory STRING, ProductName STRING")
    assert sorted(((r[0] or "-"), r[1], r[2]) for r in rel.sales_by_category(lines, products).collect()) == [
        ("-", 5.0, 1.0), ("A", 20.0, 2.0)
    ]
    assert [tuple(r) for r in rel.sales_by_category(lines, products, ["A"]).collect()] == [("A", 20.0, 2.0)]


@pytest.mark.parametrize("seed", range(4))
def test_quantile_equals_sorting(spark, seed):
    rng = random.Random(seed)
    values = [rng.choice((rng.randrange(-(10**15), 10**15), 5, rng.randrange(100))) for _ in range(501)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x BIGINT")
    for q in (0.01, 0.5, 0.8, 1.0):
        want = sorted(values)[max(0, -(-int(round(q * len(values) * 1e6)) // 10**6) - 1)]
        assert rel.numeric_quantile(df, F.col("x"), q, buckets=7) == want
    assert rel.numeric_quantile(df.limit(0), F.col("x"), 0.5) is None


def test_time_split_with_equal_and_missing_times(spark):
    times = ["2024-01-01 00:00:00.000001"] * 3 + ["2024-01-01 00:00:00.000002"] * 4 + ["2031-05-01 10:00:00"] * 3
    df = spark.createDataFrame([(t,) for t in times], "t STRING").select(F.col("t").cast("timestamp"))
    counts = {r["split"]: r["count"] for r in rel.time_split(df, "t", 0.5).groupBy("split").count().collect()}
    assert counts == {"train": 7, "test": 3}
    counts = {r["split"]: r["count"] for r in rel.time_split(df, "t", 0.3).groupBy("split").count().collect()}
    assert counts == {"train": 3, "test": 7}


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(20_000).withColumnRenamed("id", "k")
    a = {r.k for r in rel.hash_sample(df.repartition(3), "k", 0.05, 42).collect()}
    b = {r.k for r in rel.hash_sample(df.repartition(11), "k", 0.05, 42).collect()}
    assert a == b and 800 < len(a) < 1200
    assert a != {r.k for r in rel.hash_sample(df, "k", 0.05, 43).collect()}


@pytest.fixture
def hot_orders(spark, folder):
    """Orders of which one holds most of the lines, many of them exact copies; one order has none."""
    lines = [(1, 1, 10, 1, 1.0, 2.0, "O")] * 300 + [(1, n, n, 1, 3.0, 1.0, "F") for n in range(300)]
    lines += [(2, 1, 5, 1, 9.0, 1.0, "O")]
    spark.createDataFrame(
        lines,
        "l_orderkey BIGINT, l_linenumber INT, l_partkey BIGINT, l_suppkey BIGINT, l_extendedprice DOUBLE, "
        "l_quantity DOUBLE, l_linestatus STRING",
    ).repartition(3).write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame(
        [(1, 7, "O"), (2, 7, "P"), (3, 8, "F")], "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING"
    ).selectExpr("*", "timestamp_ntz'1996-01-02' AS o_orderdate").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(7, "Ada"), (8, "Bob")], "c_custkey BIGINT, c_name STRING").write.parquet(
        f"{folder}/customer.parquet"
    )
    return folder


def test_hot_order_is_spread_over_documents(spark, hot_orders):
    documents = nested.order_documents(spark, hot_orders, lines_per_document=50)
    rows = documents.collect()
    sizes = [r.number_of_line_items for r in rows if r.order_number == 1]
    assert sorted(sizes) == [50] * 5 + [350]  # a document covers 50 line numbers, and copies of them
    assert [(r.number_of_line_items, r.ordered_products) for r in rows if r.order_number == 3] == [(0, None)]
    lines = nested.order_lines(nested.bronze_orders(documents))
    assert lines.count() == 602
    assert sorted(r.LineNo for r in lines.filter("OrderNo = 1").collect()) == list(range(1, 601))
    assert {r.CustomerName for r in documents.withColumnsRenamed(nested.BRONZE_NAMES).collect()} == {"Ada", "Bob"}
    assert lines.agg(F.sum("OrderAmount")).first()[0] == 300 * 2.0 + 300 * 3.0 + 9.0
    headers = nested.bronze_orders(nested.order_headers(spark, hot_orders, lines_per_document=50))
    for counted in (
        rel.orders_per_customer(headers),
        rel.orders_per_customer(nested.bronze_orders(documents)),
        rel.orders_per_customer(
            documents.withColumnsRenamed(nested.BRONZE_NAMES), counts_once=F.col("DocumentPart") == 0
        ),
    ):
        assert sorted((r.CustomerID, r.NoOfOrders, r.LineItemCount) for r in counted.collect()) == [
            (7, 2, 601), (8, 1, 0)
        ]


def test_documents_of_normal_orders(spark, hot_orders):
    rows = nested.order_documents(spark, hot_orders).collect()
    assert sorted((r.order_number, r.number_of_line_items, r.order_datetime) for r in rows) == [
        (1, 600, "820540800"), (2, 1, ""), (3, 0, "820540800")
    ]
    assert nested.silver_customers(nested.bronze_orders(nested.order_documents(spark, hot_orders))).count() == 2
