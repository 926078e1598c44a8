"""Registered queries: name -> (spark, sf_dir) -> DataFrame, with DuckDB twins.

The queries are split by area into ``q_*`` modules; each registers itself with
``register``. ``QUERIES`` and ``ORACLE`` are filled on import of
``cadence.plans.catalog``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query under ``name``; ``sql`` is its DuckDB twin (None: rows-only check)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco
