"""Named queries over the test tables, each with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a query, by default under its function's name; without SQL only its rows are checked."""

    def register(function):
        QUERIES[name or function.__name__] = function
        if sql:
            ORACLES[name or function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load() -> None:
    """Import every module that registers queries."""
    from riskloom.checks import (  # noqa: F401
        aggregates, cleaning, encoding, entities, learning, plan, profiles, samples, scalars, scores, terms)
