"""Registry of named plans: ``name -> (spark_fn(spark, sf_dir) -> DataFrame, oracle SQL)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: register a plan and (optionally) its DuckDB-runnable twin."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def with_ctes(*ctes: str) -> str:
    """Join CTE bodies (``name AS (...)``) into one ``WITH`` prefix."""
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"
