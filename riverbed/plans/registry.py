"""Query registry: key → (Spark callable, DuckDB oracle SQL or None).

Plan modules register with ``@query(key, sql)``; ``__spark_entry__`` only
re-exports ``queries()`` and ``oracle_sql()`` from here.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}

_PLAN_MODULES = (
    "riverbed.plans.tips",
    "riverbed.plans.basics",
    "riverbed.plans.geo_places",
    "riverbed.plans.ride_state",
    "riverbed.plans.text_mail",
    "riverbed.plans.cars_patterns",
    "riverbed.plans.graph_plans",
    "riverbed.plans.codecs_io",
    "riverbed.plans.alerts",
    "riverbed.plans.sql_forms",
    "riverbed.plans.heartbeats",
    "riverbed.plans.rules",
    "riverbed.plans.udfs",
    "riverbed.plans.travel",
    "riverbed.plans.stream_plans",
    "riverbed.plans.stream_io",
    "riverbed.plans.stream_state",
    "riverbed.plans.stream_writers",
)


def query(key: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if key in _QUERIES:
            raise ValueError(f"duplicate query key {key}")
        _QUERIES[key] = fn
        if sql is not None:
            _ORACLE[key] = sql
        return fn
    return deco


def oracle_sql_of(key: str) -> str:
    """The SQL of a query registered before, for another form of the same answer."""
    return _ORACLE[key]


def _load() -> None:
    for m in _PLAN_MODULES:
        importlib.import_module(m)


def _shipping(fn: QueryFn) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from riverbed.session import ship_package
        ship_package(spark)
        return fn(spark, sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


def queries() -> dict[str, QueryFn]:
    """Registered queries; each first makes the package importable on executors."""
    _load()
    return {k: _shipping(f) for k, f in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLE)
