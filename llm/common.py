"""What the operators share: text as numpy arrays, checkpoints, registered queries."""
from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its DuckDB SQL where there is one."""

    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return register


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors share. Where that is unset, a temporary one in local mode, and an error on a cluster."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def tasks_for(df: DataFrame, rows: int = 65_536) -> int:
    """How many tasks the rows of a checkpointed table are enough for: one for each core, or one for every ``rows`` if that is more.

    Coalesced to that, a small table and what is computed from it do not leave a few rows in each of many shuffle
    partitions, whose files take a block of disk each however short they are.
    """
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))


def store(df: DataFrame) -> tuple[DataFrame, Callable[[], None]]:
    """Cut the lineage by a Parquet table in the shared folder, of which later reads take only the columns they need; also what removes it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)

    def remove() -> None:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)

    return spark.read.schema(df.schema).parquet(path), remove


def type_of(df: DataFrame, column: str) -> str:
    """A column's type as text."""
    return df.schema[column].dataType.simpleString()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a batch of strings end to end, and the n + 1 places where they start; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, starts, data = column.buffers()
    starts = np.frombuffer(starts, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[starts[0] : starts[-1]], starts - starts[0]


def slices(batches: Iterator[pa.RecordBatch], limit: int, text: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut batches by rows so that each holds about ``limit`` bytes of text; a longer text stays whole, by itself."""
    for batch in batches:
        ends = utf8(batch.column(text))[1][1:]
        first = 0
        while first < len(ends):
            start = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, start + limit, "right")))
            yield batch.slice(first, last - first)
            first = last


def codepoints(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of texts end to end, and the n + 1 places where they start; null counts as empty."""
    texts = [t or "" for t in texts]
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)]).astype(np.int64)
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), starts


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start and length, end to end."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return np.zeros(0, np.int64)
    return np.arange(ends[-1]) + np.repeat(starts - ends + lengths, lengths)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(32))
