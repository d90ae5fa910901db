"""Table sinks."""
from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    compact: bool = False,
) -> None:
    """Write a table, by default as Parquet in place of what was there.

    ``path`` must not be one that ``df`` reads from: it is emptied before the rows are read.
    ``compact`` asks Spark to even out the output, at the price of a shuffle: a small table becomes a
    single file, a large one as many as it needs. The same happens for ``partition_by``,
    where it also splits a value that holds far more rows than the others, so no
    option ever sends a whole table through one task.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    elif compact:
        df = df.hint("rebalance")
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


@contextmanager
def replaced(spark: SparkSession, path: str) -> Iterator[str]:
    """A folder beside ``path`` to write a table into, which takes its place once the block has ended well.

    If the block fails, what was written goes and what stood at ``path`` still stands. The swap itself is two
    renames, so a reader finds the old table, the new one or, for a moment, none, but never part of one. On stores
    without renames they are copies; there a table format with commits serves better.
    """
    files = spark._jvm.org.apache.hadoop.fs
    own = uuid.uuid4().hex
    final, staging, old = (files.Path(path.rstrip("/") + suffix) for suffix in ("", f"__new_{own}", f"__old_{own}"))
    system = final.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        yield staging.toString()
        if not system.exists(staging):
            raise OSError(f"nothing was written to {staging.toString()}")
        stood = system.exists(final)
        if stood and not system.rename(final, old):
            raise OSError(f"{path} cannot be moved aside")
        moved = False
        try:
            moved = system.rename(staging, final)
        finally:
            if stood and not moved:
                system.rename(old, final)
        if not moved:
            raise OSError(f"{staging.toString()} cannot be moved to {path}")
        if stood:
            system.delete(old, True)
    finally:
        system.delete(staging, True)
