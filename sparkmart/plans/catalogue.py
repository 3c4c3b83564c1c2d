"""Registry of queries: what Spark runs and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkmart.plans.oracle_base import with_views
from sparkmart.plans.workspace import Workspace, workspace

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
VIEWS: dict[str, str] = {}


def register(name: str, build: Callable[[Workspace], DataFrame], sql: str | None = None) -> None:
    """Add a query over the snapshot of a driver folder, with its DuckDB statement."""
    if name in QUERIES:
        raise ValueError(f"{name} is registered twice")
    QUERIES[name] = lambda spark, folder: build(workspace(spark, folder))
    if sql is not None:
        ORACLES[name] = sql


def all_queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    _load()
    return {name: with_views(sql, VIEWS) for name, sql in ORACLES.items()}


def _load() -> None:
    from sparkmart.plans import analysis_queries, mart_queries, zone_queries  # noqa: F401
