"""Places of rows in the order of their group, without bringing a group together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreflow.llm.common import discard, small, stored


def numbered(rows: DataFrame, group: str, order: list[Column], compression: str | None = None) -> DataFrame:
    """``rows``, stored, with ``place`` (0, 1, ... by ``order`` within the group) and ``places`` (the group's rows).

    The rows are dealt by ranges of (group, order), so that a group of any size lies over as many partitions as it
    needs; a row's place is its place in its partition plus the rows of the group in partitions before. Only these
    counts, one row for each group and partition, meet in a window. Groups must not be null. Rows that are alike in
    ``order`` get their places in any order.
    """
    ranged = rows.repartitionByRange(F.col(group), *order).sortWithinPartitions(F.col(group), *order)
    sorted_rows = stored(ranged.withColumn("_at", F.monotonically_increasing_id()), "ranged", compression)
    sorted_rows_part = F.shiftright("_at", 33).alias("_part")
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spans = (
        sorted_rows.groupBy(group, sorted_rows_part)
        .agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .withColumn("places", F.sum("_n").over(Window.partitionBy(group)))
        .select(group, "_part", (F.col("_before") - F.col("_first")).alias("_shift"), "places")
    )
    spans = stored(spans, "spans")
    placed = sorted_rows.withColumn("_part", sorted_rows_part).join(small(spans), [group, "_part"])
    placed = placed.withColumn("place", F.col("_at") + F.col("_shift")).select(*rows.columns, "place", "places")
    out = stored(placed, "numbered", compression)
    discard(sorted_rows)
    discard(spans)
    return out
