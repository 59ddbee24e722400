"""Named queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with the DuckDB SQL for the same rows where there is any."""

    def add(f: Query) -> Query:
        assert name not in _QUERIES, name
        _QUERIES[name] = f
        if sql is not None:
            _ORACLES[name] = sql
        return f

    return add


def _load() -> None:
    import importlib

    for part in ("core", "more", "choice", "cleaning", "rules", "release", "space", "reviews", "words", "streams"):
        importlib.import_module(f"pairloom.plans.{part}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
