"""Grouping. Each function is one hash aggregation.

Spark pre-aggregates on the map side, so a key that holds a large share of the rows
leaves each task as a single partial row.
"""
from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, functions as F

from pavilion.operators.filters import require_keys
from pavilion.operators.ranking import ranked


def group_sum(df: DataFrame, keys: Sequence[str], value: str, total: str) -> DataFrame:
    """Sum per group; a null key is a group of its own."""
    return df.groupBy(*keys).agg(F.sum(value).alias(total))


def group_stats(df: DataFrame, keys: Sequence[str], value: str, total: str, mean: str) -> DataFrame:
    """Sum and mean per group."""
    return df.groupBy(*keys).agg(F.sum(value).alias(total), F.avg(value).alias(mean))


def group_mean(df: DataFrame, keys: Sequence[str], value: str, mean: str) -> DataFrame:
    """Mean per group, groups with a null key left out."""
    return require_keys(df, keys).groupBy(*keys).agg(F.avg(value).alias(mean))


def group_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per group in ``count``; a null key is a group of its own."""
    return df.groupBy(*keys).count()


def value_counts(
    df: DataFrame,
    column: str,
    k: int | None = None,
    by_value: bool = False,
    exclude: Iterable[str] = (),
) -> DataFrame:
    """Rows per value, nulls left out: most frequent first, or in value order.

    ``k`` keeps the k most frequent, ties decided by value. ``exclude`` leaves out
    placeholder values such as the one the cleaning writes for blanks.
    """
    present = df.filter(F.col(column).isNotNull())
    unwanted = list(exclude)
    if unwanted:
        present = present.filter(~F.col(column).isin(unwanted))
    counted = group_count(present, [column])
    return ranked(counted, [] if by_value else [F.desc("count")], [column], k)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The values that occur, in order, nulls left out."""
    return df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)


def totals_by_column(
    df: DataFrame, columns: Sequence[str], name: str = "name", total: str = "total"
) -> DataFrame:
    """One row per column with its sum, 0 where a column holds no value at all."""
    sums = df.agg(*[F.coalesce(F.sum(c).cast("long"), F.lit(0).cast("long")).alias(c) for c in columns])
    return sums.unpivot([], list(columns), name, total)
