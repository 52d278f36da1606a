"""Every query of the library by name."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

FLAGSHIP = "sta05_association_pipeline"
Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where there is one, the SQL it must agree with."""

    def put(f: Query) -> Query:
        _QUERIES[name] = f
        if sql:
            _ORACLES[name] = sql
        return f

    return put


def _load() -> None:
    for module in ("cohort", "tables", "reports", "evidence", "imports", "modelling"):
        import_module(f"cohortry.plans.{module}")


def queries() -> dict[str, Query]:
    _load()
    return _QUERIES


def oracle_sql() -> dict[str, str]:
    _load()
    return _ORACLES
