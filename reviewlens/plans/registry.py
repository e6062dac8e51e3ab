"""Registered queries: each takes (spark, sf_dir) and may have an SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from reviewlens.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
MODULES = ["source", "conform", "scoring", "long_table", "mart", "text", "topic", "vector", "stream"]


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its operator id."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def load() -> None:
    for m in MODULES:
        import_module(f"reviewlens.plans.{m}_queries")
