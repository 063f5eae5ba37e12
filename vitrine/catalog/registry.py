"""Named queries over the given tables, each with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vitrine.catalog.fixtures import collection, oracle
from vitrine.plans.model import Collection
from vitrine.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``."""

    def register(fn: Callable[[Collection], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, sf_dir: fn(collection(tune(spark), sf_dir))
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return fn

    return register
