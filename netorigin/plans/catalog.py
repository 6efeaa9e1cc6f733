"""Registry of runnable queries: name -> (Spark callable, SQL twin)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from netorigin.plans.tables import Tables, duck

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; `sql` may use @table names."""
    def add(fn):
        assert name not in QUERIES, name
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = duck(sql)
        return fn

    return add


def load() -> None:
    from netorigin.plans import q_functions, q_ranges, q_routing, q_networks, q_quality, q_io  # noqa: F401


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    load()
    return {n: (lambda spark, folder, fn=fn: fn(Tables(spark, folder))) for n, fn in QUERIES.items()}


def oracles() -> dict[str, str]:
    load()
    return dict(ORACLES)
