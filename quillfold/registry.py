"""Collects each operator module's queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register fn(spark, sf_dir) under name, with the SQL text that must give the same rows."""

    def put(fn):
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = sql
        return fn

    return put


def _load() -> None:
    from quillfold import catalog  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return _QUERIES


def oracles() -> dict[str, str]:
    _load()
    return _ORACLES
