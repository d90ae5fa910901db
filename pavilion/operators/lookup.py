"""Lookups into other tables, all left outer joins on equality.

No join is hinted. Spark broadcasts a side only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold``; above it both sides are shuffled, and
adaptive execution splits a key that holds too many rows. It can do so only where both
sides are shuffled for the join itself, which ``split_keys`` makes sure of. Where a
result is aggregated anyway, the rows are aggregated to the join key first, so that no
key is hot when the join runs.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from pavilion.operators.filters import require_keys


def lookup_left(
    df: DataFrame, other: DataFrame, left_key: str, right_key: str, columns: Sequence[str], split_keys: bool = False
) -> DataFrame:
    """Add ``columns`` of the other table by key; null where the key is not there.

    A column that ``df`` already has is replaced. A key that occurs twice in ``other``
    doubles the row: keep the table unique. Set ``split_keys`` when ``df`` has many rows
    per key and ``other`` is the result of a grouping by that key: wrapped in a struct,
    the key no longer matches the grouping's partitions, so the join gets its own.
    """
    marker = "__lookup_key"
    wanted = require_keys(other, [right_key]).select(F.col(right_key).alias(marker), *columns)
    keys = F.col(left_key), F.col(marker)
    if split_keys:
        keys = F.struct(keys[0].alias("key")), F.struct(keys[1].alias("key"))
    kept = df.drop(*[c for c in columns if c != left_key])
    return kept.join(wanted, keys[0] == keys[1], "left").drop(marker)


def lookup_codes(df: DataFrame, column: str, names: DataFrame, code: str, name: str) -> DataFrame:
    """Replace codes by names held in a table; unknown codes and null pass through as text."""
    found = "__name"
    pairs = names.select(F.col(code).cast("string").alias("__code"), F.col(name).alias(found))
    coded = df.withColumn(column, F.col(column).cast("string"))
    joined = lookup_left(coded, pairs, column, "__code", [found])
    return joined.withColumn(column, F.coalesce(found, column)).drop(found)


def joined_mean(
    df: DataFrame, other: DataFrame, left_key: str, right_key: str, by: str, value: str, mean: str
) -> DataFrame:
    """Mean of ``value`` per attribute of the table it is looked up in, null attributes left out.

    Joins one (sum, count) per key instead of the rows; the quotient is the same.
    """
    per_key = df.groupBy(left_key).agg(F.sum(value).alias("__sum"), F.count(value).alias("__n"))
    placed = require_keys(lookup_left(per_key, other, left_key, right_key, [by]), [by])
    sums = placed.groupBy(by).agg(F.sum("__sum").alias("__sum"), F.sum("__n").alias("__n"))
    return sums.select(by, F.try_divide("__sum", "__n").alias(mean))


def mean_of_group_sums(
    df: DataFrame, other: DataFrame, left_key: str, right_key: str, by: str, value: str, mean: str
) -> DataFrame:
    """Sum per key, look the key up, then mean of the sums per attribute; a null attribute stays."""
    per_key = df.groupBy(left_key).agg(F.sum(value).alias("__sum"))
    placed = lookup_left(per_key, other, left_key, right_key, [by])
    return placed.groupBy(by).agg(F.avg("__sum").alias(mean))
