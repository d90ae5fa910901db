"""Order and top-k."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def ranked(
    df: DataFrame, order: Sequence[Column | str], ties: Sequence[Column | str], k: int | None = None
) -> DataFrame:
    """Sort by ``order`` and then by ``ties``; with ``k`` keep the first k rows.

    ``ties`` should be unique so that the rows kept do not depend on the run. With
    ``k``, each task sends on k rows and nothing is shuffled in full. Without it, the
    tie columns also let the sort split a run of equal values over several tasks.
    """
    placed = df.orderBy(*order, *ties)
    return placed if k is None else placed.limit(k)


def best_per_group(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The rows that hold the highest value of their group, all of them on a tie.

    The highest value is found by aggregation and matched back, so a large group is
    never sorted in one task. Matching on group and value as one struct spreads a large
    group by its values, and lets a null group match itself.
    """
    best = df.groupBy(*keys).agg(F.max(value).alias(value)).select(F.struct(*keys, value).alias("__best"))
    return df.join(best, F.struct(*[df[c] for c in (*keys, value)]) == F.col("__best"), "left_semi")
