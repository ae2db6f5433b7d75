"""Registry of named queries: ``QUERIES[name](spark, sf_dir) -> DataFrame`` and
``ORACLE[name]`` = the same result as DuckDB SQL over the raw test tables.

Query modules add themselves with :func:`query`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def load_all() -> tuple[dict[str, QueryFn], dict[str, str]]:
    # Importing the modules registers their queries.
    from . import queries_drift, queries_features, queries_keys, queries_model, queries_stats  # noqa: F401
    return QUERIES, ORACLE
