"""Collects queries with the SQL they must agree with."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its DuckDB SQL."""

    def register(run: Query) -> Query:
        add(run.__name__, run, sql)
        return run

    return register


def add(name: str, run: Query, sql: str) -> None:
    if name in QUERIES:
        raise ValueError(f"two queries named {name}")
    QUERIES[name] = run
    ORACLES[name] = sql


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
