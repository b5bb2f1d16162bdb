"""Registered queries over the driver test data: ``name -> (spark, sf_dir) -> DataFrame`` plus, where the
result is expressible in SQL, an independent DuckDB oracle with identical column names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from ecospark.plans import (queries_composite, queries_core, queries_exprs, queries_files,  # noqa: F401
                                queries_joins, queries_parts, queries_rows)
