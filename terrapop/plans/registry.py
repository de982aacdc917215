"""Registered queries: a name, a function of the fixtures, and DuckDB text if there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from terrapop.sources.fixtures import Fixtures, with_adapters

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Callable[[Fixtures], DataFrame]], Callable[[Fixtures], DataFrame]]:
    """Registers ``f`` under ``name``; ``sql`` may use the adapters by name."""

    def register(f: Callable[[Fixtures], DataFrame]) -> Callable[[Fixtures], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: f(Fixtures(spark, sf_dir))
        if sql is not None:
            ORACLE_SQL[name] = with_adapters(sql)
        return f

    return register
