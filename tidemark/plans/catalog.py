"""Query catalogue: every operator as a (spark, sf_dir) -> DataFrame query,
next to the DuckDB SQL that computes the same result independently.

Column names match between a query and its SQL; doubles that are aggregated
are rounded on both sides; NULL ordering is spelled out in the SQL (DuckDB
sorts NULLs last by default, Spark first).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: add a query (and its oracle SQL, when SQL can express it)."""
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from . import q_config, q_core, q_events, q_joins, q_marts, q_patterns, q_quality, q_reports, q_rules, q_stream  # noqa: F401,E501
