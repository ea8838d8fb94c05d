"""The registered queries: a Spark callable and, where SQL can express it, the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bindings import Entities, with_entities

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Registers a function of ``Entities``; the SQL may use the entities as tables."""

    def add(f: Callable[[Entities], DataFrame]) -> Callable[[Entities], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: f(Entities(spark, sf_dir))
        if sql:
            ORACLES[name] = with_entities(sql)
        return f

    return add
