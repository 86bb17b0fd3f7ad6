"""UPDATE, DELETE and MERGE as DataFrame transformations: old rows in, new rows out."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.operators.schemas import SchemaMismatch, conform


def _as_column(value: object) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Drop the rows where the condition is TRUE; rows where it is NULL stay."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def update_where(df: DataFrame, assignments: dict[str, object], condition: Column | None = None) -> DataFrame:
    """Set columns where the condition is TRUE (everywhere if none); a column keeps its type."""
    unknown = set(assignments) - set(df.columns)
    if unknown:
        raise SchemaMismatch(f"no such columns: {sorted(unknown)}")

    def new_value(field: T.StructField) -> Column:
        if field.name not in assignments:
            return F.col(field.name)
        value = _as_column(assignments[field.name]).cast(field.dataType)
        if condition is not None:
            value = F.when(F.coalesce(condition, F.lit(False)), value).otherwise(F.col(field.name))
        return value.alias(field.name)

    return df.select(*[new_value(f) for f in df.schema.fields])


def key_matches(left: DataFrame, right: DataFrame, on: list[str], null_safe: bool) -> Column:
    """Whether rows have the same key; the right side's columns are named with a leading ``_``."""
    pairs = [(left[k], right[f"_{k}"]) for k in on]
    return reduce(and_, [l.eqNullSafe(r) if null_safe else l == r for l, r in pairs])


def fitted(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source rows in the target's columns and types; an error if columns are missing on either side."""
    missing = set(target.columns) - set(source.columns)
    extra = set(source.columns) - set(target.columns)
    if missing or extra:
        raise SchemaMismatch(f"source lacks {sorted(missing)}, target lacks {sorted(extra)}")
    return conform(source, target.schema)


def merge_matched(target: DataFrame, source: DataFrame, on: list[str], hit: str, null_safe: bool = False) -> DataFrame:
    """All target rows, matched ones with the source row's values; the column ``hit`` tells which those are.

    A NULL key matches nothing unless ``null_safe``. A target row that meets more than one source row is an error.
    The target is read once, as the left side of a left join, which the runtime may split at a hot key; the source
    is reduced to one row per key before.
    """
    source = fitted(source, target)
    rest = [c for c in target.columns if c not in on]
    per_key = source if null_safe else source.dropna(subset=on)
    per_key = per_key.groupBy(*[F.col(k).alias(f"_{k}") for k in on]).agg(
        F.count("*").alias("_n"), F.first(F.struct(F.lit(1).alias("_one"), *rest)).alias("_new")
    )
    joined = target.join(per_key, key_matches(target, per_key, on, null_safe), "left")
    several = F.raise_error(F.lit("merge: a target row matches more than one source row")).cast("boolean")
    joined = joined.withColumn(hit, F.when(F.col("_n") > 1, several).otherwise(F.col("_n").isNotNull()))
    values = [
        F.col(c) if c in on else F.when(F.col(hit), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in target.columns
    ]
    return joined.select(*values, hit)


def merge_unmatched(source: DataFrame, keys: DataFrame, on: list[str], null_safe: bool = False) -> DataFrame:
    """Source rows whose key is not among ``keys``, the ones that were met in the target."""
    keys = keys.select(*[F.col(k).alias(f"_{k}") for k in on]).distinct()
    if null_safe:
        return source.join(keys, key_matches(source, keys, on, null_safe), "left_anti")
    # a NULL key matches nothing, so its rows need not be shuffled
    whole = source.dropna(subset=on)
    unkeyed = source.filter(reduce(or_, [F.col(k).isNull() for k in on]))
    return whole.join(keys, key_matches(whole, keys, on, null_safe), "left_anti").unionByName(unkeyed)


def merge_rows(target: DataFrame, source: DataFrame, on: list[str], null_safe: bool = False) -> DataFrame:
    """Upsert: a matched target row takes the source row's values, unmatched source rows are inserted.

    A plain query over both sides; a table, which stores the first part, reads its target only once.
    """
    updated = merge_matched(target, source, on, "_hit", null_safe).drop("_hit")
    return updated.unionByName(merge_unmatched(fitted(source, target), target, on, null_safe))
