"""All registered operator checks (Spark plan + optional DuckDB SQL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _registry():
    from tidemark.plans import fixture_queries  # noqa: F401  (registers on import)
    from tidemark.plans import control_queries  # noqa: F401
    from tidemark.plans import sink_queries  # noqa: F401
    return fixture_queries.REGISTRY


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for name, (fn, _sql) in _registry().items()}


def all_sql() -> dict[str, str]:
    return {name: sql for name, (_fn, sql) in _registry().items() if sql is not None}
