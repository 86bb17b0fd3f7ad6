"""The list of runnable queries, filled by the modules in ``oreflow.plans``."""

from __future__ import annotations

import functools
import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from oreflow.session import prepare

QueryFn = Callable[[SparkSession, str], DataFrame]

PLAN_MODULES = ("sales", "versions", "scans", "features", "streams", "scoring", "learning")


@dataclass(frozen=True)
class Query:
    name: str
    run: QueryFn
    sql: str | None
    about: str


_QUERIES: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register a plan under its function name, with the SQL that gives the same rows."""

    def register(fn: QueryFn) -> QueryFn:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        if fn.__name__ in _QUERIES:
            raise ValueError(f"query {fn.__name__} is registered twice")
        _QUERIES[fn.__name__] = Query(fn.__name__, run, sql, (fn.__doc__ or "").strip())
        return run

    return register


def all_queries() -> dict[str, Query]:
    for module in PLAN_MODULES:
        importlib.import_module(f"oreflow.plans.{module}")
    return dict(_QUERIES)
