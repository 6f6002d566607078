"""Registry of driver queries: name -> (Spark callable, oracle SQL or None)."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from filingflow.session import ensure_conf, ship_package

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its DuckDB oracle (None: rows-only check)."""
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_conf(spark)  # UTC, AQE, map-key policy: the queries rely on them
            ship_package(spark, os.path.dirname(os.path.abspath(__file__)))
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    from . import queries_a, queries_b, queries_c, queries_d, queries_e  # noqa: F401
