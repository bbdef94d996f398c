"""Named queries over the driver's tables, each with SQL for DuckDB where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function as the query of its name."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def load() -> tuple[dict[str, Query], dict[str, str]]:
    from marketlane.plans import catalog, demand, intake, lookups, monitor, page_records, resolve, selection, shops, streams, texts, upkeep  # noqa: F401

    return QUERIES, SQL
