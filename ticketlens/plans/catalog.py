"""Registry of named queries: ``name -> (spark, sf_dir) -> DataFrame`` plus its oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, fn: QueryFn, sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"duplicate query {name}")
    QUERIES[name] = fn
    if sql is not None:
        ORACLES[name] = sql


def load_all() -> None:
    """Import the modules that register queries."""
    from ticketlens.plans import registry  # noqa: F401
