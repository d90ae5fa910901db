"""Row filters. All are plain predicates, so Parquet scans can apply them."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F


def rows_where_zero(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Rows on which every flag is 0; a null flag drops the row."""
    return df.filter(reduce(and_, [F.col(f) == 0 for f in flags]))


def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows on which every key is present.

    Spelled out key by key, which reaches the Parquet scan; ``dropna`` does not.
    """
    return df.filter(reduce(and_, [F.col(k).isNotNull() for k in keys])) if keys else df


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """Rows with at least one value."""
    return df.dropna(how="all")
