"""The three jobs, each from one folder of tables to another; stages meet in the file system only.

Every job goes on with the tables that can be opened, read and written in full, and returns why the others failed. What
stood in the place of a table that failed still stands there.
"""
from __future__ import annotations

import inspect
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from pavilion.plans.analytics import ANALYTICS, Tables
from pavilion.plans.cleaning import CleanSpec, run_cleaning
from pavilion.plans.specs import SPECS
from pavilion.sources import FAILURES, SCHEMAS, as_text, load_tables, register_views, replaced, write_table
from pavilion.sources.schemas import PLAYER_MATCH

# Raw file names that differ from the table name.
_RAW_NAMES = {PLAYER_MATCH: "Player_match"}

Errors = dict[str, str]


class Opened(dict):
    """Tables by name; asking for one that did not open says why."""

    def __init__(self, tables: Mapping[str, DataFrame], errors: Errors):
        super().__init__(tables)
        self.errors = errors

    def __missing__(self, name: str) -> DataFrame:
        raise LookupError(f"{name} did not open: {self.errors.get(name, 'no such table')}")


def load_text(spark: SparkSession, base: str, suffix: str = ".csv") -> tuple[dict[str, DataFrame], Errors]:
    """The raw CSV tables, every cell as its text."""
    paths = {name: f"{base}/{_RAW_NAMES.get(name, name)}{suffix}" for name in SCHEMAS}
    return load_tables(spark, paths, "csv", {name: as_text(schema) for name, schema in SCHEMAS.items()})


def ingest(spark: SparkSession, source: str, target: str) -> Errors:
    """Copy the raw tables in full, cell by cell as text, replacing what was there; returns the tables that failed.

    Spark's CSV writer trims each value, so a date kept from parsing by a leading space
    is readable in the copy.
    """
    _keep_apart(source, target)
    tables, errors = load_text(spark, source)
    for name, df in tables.items():
        try:
            with replaced(spark, f"{target}/{_RAW_NAMES.get(name, name)}") as path:
                write_table(df, path, "csv")
        except FAILURES as problem:
            errors[name] = str(problem)
    return errors


def clean_all(
    spark: SparkSession,
    raw: str,
    target: str,
    fmt: str = "parquet",
    suffix: str = "",
    specs: Mapping[str, CleanSpec] = SPECS,
) -> tuple[DataFrame, Errors]:
    """Clean every raw table that ``specs`` name into ``target``; returns the audit and the tables that failed."""
    _keep_apart(raw, target)
    tables, errors = load_text(spark, raw, suffix)
    found = {name: spec for name, spec in specs.items() if name in tables}
    audit, failed = run_cleaning(spark, tables, found, target, fmt, SCHEMAS)
    return audit, {name: e for name, e in errors.items() if name in specs} | failed


def load_clean(spark: SparkSession, base: str) -> tuple[Tables, Errors]:
    """The cleaned Parquet tables, also registered as views, and those that failed."""
    tables, errors = load_tables(spark, {name: f"{base}/{name}" for name in SCHEMAS})
    register_views(tables)
    return Opened(tables, errors), errors


def report(spark: SparkSession, base: str, name: str, k: int | None = None) -> DataFrame:
    """One named analytic over the cleaned tables, in full or its first ``k`` rows."""
    analytic: Callable[..., DataFrame] = ANALYTICS[name]
    tables, _ = load_clean(spark, base)
    if "k" in inspect.signature(analytic).parameters:
        return analytic(tables, k=k)
    found = analytic(tables)
    return found if k is None else found.limit(k)


def _keep_apart(source: str, target: str) -> None:
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError(f"{target} would be emptied before it is read; write to another folder")
