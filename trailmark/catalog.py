"""All queries of the engine by name, each with its oracle SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Decorator: files a query under its name, with the SQL that must give the same rows."""

    def put(f: Query) -> Query:
        _QUERIES[name] = f
        if sql is not None:
            _ORACLES[name] = sql
        return f

    return put


def _load() -> None:
    from trailmark.plans import counting, flows, ingestion, joining, metrics, outputs  # noqa: F401


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
