"""Joins, deduplication, grouping and sampling of the sales and sensor pipelines."""

from __future__ import annotations

import math
from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class DuplicateKey(ValueError):
    """A column that must identify rows does not."""


def require_unique(df: DataFrame, *keys: str) -> DataFrame:
    """Return the rows if the keys identify them, else raise; only one offending key is fetched."""
    twice = find_duplicates(df, *keys).first()
    if twice is not None:
        raise DuplicateKey(f"{twice.asDict()} occurs more than once")
    return df


def find_duplicates(df: DataFrame, *keys: str, count: str = "count") -> DataFrame:
    """Key values that occur more than once, and how often."""
    return df.groupBy(*keys).agg(F.count("*").alias(count)).filter(F.col(count) > 1)


def keep_first(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """One row per key, the first in the given order (make it total).

    The row_number = 1 filter is pushed below the shuffle as a group limit, so each task sends at most
    one row per key however many copies a key has.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == 1).drop("_rank")


def star_join(fact: DataFrame, *dimensions: tuple[DataFrame, str]) -> DataFrame:
    """Left-join each dimension on its key column; facts without a match stay with NULLs.

    No broadcast hint: the optimizer broadcasts a dimension whose size it knows to be small, and else
    sorts and merges with the fact side open to skew splitting. Dimension keys must be unique.
    """
    for dimension, key in dimensions:
        fact = fact.join(dimension, key, "left")
    return fact


def gold_lines(lines: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    joined = star_join(
        lines.select("CustomerID", "ProductID", "OrderDateTime", "Quantity", "OrderAmount"),
        (products.select("ProductID", "ProductCategory", "ProductName"), "ProductID"),
        (customers, "CustomerID"),
    )
    return joined.select(
        "ProductCategory", "ProductName", "CustomerName", "OrderDateTime", "Quantity", "OrderAmount"
    )


#: Amounts are added in millionths, in blocks of so many units and the rest.
SCALE = 1_000_000
BLOCK = 1_000_000
#: Digits that totals are rounded to when they come out.
DIGITS = 2


def unit_parts(column: str) -> tuple[Column, Column]:
    """An amount in millionths, cut into blocks of a million units and the rest.

    Sums of whole numbers are exact and do not depend on the order of addition; cut in two, 64 bits hold
    the sum of any number of rows a table can have. Far cheaper than adding decimals.
    """
    units = f"cast(rint({column} * {SCALE}) AS BIGINT)"
    return F.expr(f"{units} div {BLOCK}"), F.expr(f"{units} % {BLOCK}")


def from_unit_parts(blocks: Column, rest: Column, digits: int = DIGITS) -> Column:
    """The amount, as a double, whose summed parts these are; only the sum is rounded."""
    units = blocks.cast("decimal(20,0)") * BLOCK + rest
    return F.round(units.cast("decimal(32,0)") / F.lit(SCALE).cast("decimal(7,0)"), digits).cast("double")


def total(column: str, digits: int = DIGITS) -> Column:
    """Exact sum of an amount, as a double."""
    blocks, rest = unit_parts(column)
    return from_unit_parts(F.sum(blocks), F.sum(rest), digits)


def monthly_sales(gold: DataFrame) -> DataFrame:
    """Quantity and amount per product category, product, customer and month."""
    month = F.trunc(F.to_date("OrderDateTime"), "MM")
    return gold.groupBy("ProductCategory", "ProductName", "CustomerName", month.alias("YearMonth")).agg(
        total("Quantity").alias("Quantity"), total("OrderAmount").alias("OrderAmount")
    )


def sales_by_category(lines: DataFrame, products: DataFrame, categories: list[str] | None = None) -> DataFrame:
    """Totals per product category; ``categories`` keeps only the listed ones.

    Lines of unknown products form the NULL category, which a list leaves out.
    """
    how = "left"
    if categories is not None:
        products = products.filter(F.col("ProductCategory").isin(categories))
        how = "inner"
    return _per_product(
        lines, products, "ProductCategory", how, {"OrderAmount": "TotalSales", "Quantity": "TotalQuantity"}
    )


def popular_products(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Quantity per product name: the totals the monthly table adds up to, without building it."""
    return _per_product(lines, products, "ProductName", "left", {"Quantity": "TotalQuantity"})


def _per_product(
    lines: DataFrame, products: DataFrame, column: str, how: str, totals: dict[str, str]
) -> DataFrame:
    """Exact totals per value of a product column; ``totals`` maps amounts to the names of their sums.

    Lines are added up per product first. That collapses a hot product before anything is shuffled, and
    the join to the product list reuses the same partitioning where the list is too big to broadcast.
    """
    parts = {}
    for amount in totals:
        parts[f"_{amount}_blocks"], parts[f"_{amount}_rest"] = unit_parts(amount)
    per_id = lines.groupBy("ProductID").agg(*[F.sum(c).alias(n) for n, c in parts.items()])
    named = per_id.join(products.select("ProductID", column), "ProductID", how)
    sums = [
        from_unit_parts(F.sum(f"_{amount}_blocks"), F.sum(f"_{amount}_rest")).alias(name)
        for amount, name in totals.items()
    ]
    return named.groupBy(column).agg(*sums)


def orders_per_customer(bronze: DataFrame, counts_once: Column | None = None) -> DataFrame:
    """Number of orders and of their lines per customer.

    ``counts_once`` marks one row of each order where an order may be spread over several documents; by default
    that is its first document.
    """
    if counts_once is None and "DocumentPart" in bronze.columns:
        counts_once = F.col("DocumentPart") == 0
    orders = F.count("*") if counts_once is None else F.count_if(counts_once)
    return bronze.groupBy("CustomerID", "CustomerName").agg(
        orders.alias("NoOfOrders"), F.sum("LineItemCount").alias("LineItemCount")
    )


def hash_sample(df: DataFrame, key: str, fraction: float, seed: int) -> DataFrame:
    """Rows whose hashed key falls below the fraction: the same rows however the data is partitioned."""
    limit = f"{int(fraction * 2**32):08x}"
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return df.filter(F.substring(digest, 1, 8) < limit)


def numeric_quantile(
    df: DataFrame,
    value: Column,
    q: float,
    buckets: int = 10_000,
    within: Callable[[int, int], Column] | None = None,
) -> int | None:
    """Exact discrete quantile of a whole-number expression: the smallest value with at least q of all rows
    at or below it.

    Each pass counts rows per equal-width bucket of the remaining value range and narrows the range to
    the bucket the quantile lies in. Only the counts of at most ``buckets`` buckets are fetched, and no
    rows are sorted. ``within`` may give the range condition in a form the file reader can use, so that
    all passes but the first read little.
    """
    within = within or value.between
    values = df.select(value.alias("v")).filter(F.col("v").isNotNull())
    low, high, n = values.agg(F.min("v"), F.max("v"), F.count("v")).first()
    if not n:
        return None
    wanted = max(1, math.ceil(Fraction(str(q)) * n))
    below = 0
    while low < high:
        width = (high - low) // buckets + 1
        counts = (
            df.filter(within(low, high))
            .select(value.cast("bigint").alias("v"))
            .groupBy(F.expr(f"(v - {low}L) div {width}L").alias("bucket"))
            .agg(F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
            .collect()
        )
        for row in sorted(counts, key=lambda r: r.bucket):
            if below + row.n >= wanted:
                low, high = row.low, row.high
                break
            below += row.n
    return low


def time_split(df: DataFrame, time: str, train_fraction: float) -> DataFrame:
    """Mark rows ``train`` up to the cut-off time that has the wanted share of rows at or before it."""

    def within(low: int, high: int) -> Column:
        return F.col(time).between(F.timestamp_micros(F.lit(low)), F.timestamp_micros(F.lit(high)))

    cut = numeric_quantile(df, F.unix_micros(time), train_fraction, within=within)
    if cut is None:
        return df.withColumn("split", F.lit("train"))
    is_train = F.col(time) <= F.timestamp_micros(F.lit(cut))
    return df.withColumn("split", F.when(is_train, "train").otherwise("test"))
