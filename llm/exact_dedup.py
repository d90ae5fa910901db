"""Exact duplicates by content sort."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from llm.common import checkpoint, given, query, type_of

BLANKS = " \t\n\x0b\x0c\r"  # [\x20\x09-\x0D]
BROADCAST_ROWS = 1_000_000  # merged runs that are broadcast; more are joined by shuffle


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical without ASCII white space; null counts as empty. Of equal
    texts the one with the most code points stays, then the smallest ``doc_id``; a null id comes
    last. Rows that also share that id are told apart by nothing, so each counts in
    ``group_size`` and exactly one has ``kept``. Other columns are ignored. ``doc_id`` may have any type with an order.

    Sampled splitters deal rows into ranges, and each range is sorted, on disk where it must, so that equal
    texts are neighbours and their first row is the one that stays. Splitters are short, as the sample
    passes through the driver: the first 32 characters of the normalised text, a hash of all of it for
    texts that begin alike, then length and id, so that a text held by a third of all rows spreads
    over many ranges. Within a range whole texts are sorted and neighbours compared in full. Only
    the first and last run of a range can go on in another: these, two rows per range, are merged
    by their full text, and the result, without texts, is broadcast as long as two rows per range are at most 1,000,000.
    """
    normal = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id", F.translate("text", BLANKS, "").alias("norm"), (-F.char_length("text")).alias("short")
    ).withColumn("begins", F.substring("norm", 1, 32)).withColumn("rest", F.xxhash64("norm"))
    last, kind = ["short", F.asc_nulls_last("doc_id")], type_of(docs, "doc_id")
    ranged = normal.repartitionByRange("begins", "rest", *last).sortWithinPartitions("begins", "rest", "norm", *last)
    runs = ranged.select("doc_id", "norm", "short", F.sha2("norm", 256).alias("sha")).mapInArrow(
        _runs, f"doc_id {kind}, short int, sha string, first boolean, keep_id {kind}, n long, edge boolean, head string"
    )
    rows = checkpoint(runs)
    best = F.min(F.struct("short", F.col("keep_id").isNull().alias("none"), "keep_id"))
    heads = rows.filter(F.col("head").isNotNull())
    merged = heads.groupBy("head", F.col("sha").alias("of")).agg(best.alias("best"), F.sum("n").alias("total"))
    merged = merged.select("of", F.col("best.keep_id").alias("kept_id"), F.col("best.short").alias("kept_short"), "total")
    merged = F.broadcast(merged) if 2 * rows.rdd.getNumPartitions() <= BROADCAST_ROWS else merged
    joined = rows.join(merged, F.col("edge") & (F.col("sha") == F.col("of")), "left")
    # Of ranges that share a text only the first one's first row stays; ranges follow the sort order,
    # so it is the row whose (length, id) is the group's best. Equal rows at a splitter lie in one range.
    is_first = F.col("first") & (F.col("of").isNull() | (F.col("short") == F.col("kept_short")) & F.col("doc_id").eqNullSafe(F.col("kept_id")))
    return joined.select(
        "doc_id", F.when(F.col("of").isNull(), F.col("keep_id")).otherwise(F.col("kept_id")).alias("keep_id"),
        F.coalesce("total", "n").alias("group_size"), is_first.alias("kept"), F.col("sha").alias("text_sha256"),
    )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut one sorted range into runs of equal text; ``head`` has the text of a run that may go on in another range."""
    last: str | None = None  # text of the open run
    held: list[pa.Array] = []  # ids of the open run
    short, sha, opening = 0, None, True  # of its first row; whether it is the range's first run

    def close(final: bool) -> pa.RecordBatch:
        ids = pa.concat_arrays(held)
        n = len(ids)
        edge = opening or final
        return pa.record_batch({
            "doc_id": ids, "short": pa.array(np.full(n, short, np.int32)), "sha": pa.repeat(sha, n),
            "first": pa.array(np.arange(n) == 0), "keep_id": ids.take(pa.array(np.zeros(n, np.int64))), "n": pa.repeat(pa.scalar(n, pa.int64()), n),
            "edge": pa.repeat(edge, n), "head": pa.array([last if edge else None] + [None] * (n - 1), pa.string()),
        })

    for batch in batches:
        n = len(batch)
        if not n:
            continue
        norm, ids, shas = batch.column("norm"), batch.column("doc_id"), batch.column("sha")
        lengths = batch.column("short").to_numpy(zero_copy_only=False)
        same = np.zeros(n, bool)
        same[1:] = pc.equal(norm[1:], norm[:-1]).to_numpy(zero_copy_only=False)
        same[0] = last is not None and norm[0].as_py() == last
        cuts = np.flatnonzero(~same)
        if not len(cuts):
            held.append(ids)
            continue
        if held:
            held.append(ids[: cuts[0]])
            yield close(False)
            opening, held = False, []
        # Whole runs inside the batch leave together; the last one stays open.
        starts, sizes = cuts[:-1], np.diff(cuts)
        if len(starts) and opening:
            last, held, short, sha = norm[0].as_py(), [ids[: cuts[1]]], lengths[0], shas[0]
            yield close(False)
            opening, held, starts, sizes = False, [], starts[1:], sizes[1:]
        if len(starts):
            rows = np.arange(starts[0], cuts[-1])
            of = np.repeat(starts, sizes)
            yield pa.record_batch({
                "doc_id": ids.take(rows), "short": pa.array(lengths[of].astype(np.int32)), "sha": shas.take(of).cast(pa.string()),
                "first": pa.array(rows == of), "keep_id": ids.take(of), "n": pa.array(np.repeat(sizes, sizes).astype(np.int64)),
                "edge": pa.repeat(False, len(rows)), "head": pa.nulls(len(rows), pa.string()),
            })
        at = int(cuts[-1])
        last, held, short, sha = norm[at].as_py(), [ids[at:]], lengths[at], shas[at]
    if held:
        yield close(True)


@query("""
with t as (
  select doc_id, coalesce(text, '') as text, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') as norm from documents
), g as (
  select doc_id, norm, first_value(doc_id) over w as keep_id, count(*) over (partition by norm) as group_size,
    row_number() over w = 1 as kept
  from t window w as (partition by norm order by length(text) desc, doc_id)
)
select doc_id, keep_id, group_size, kept, sha256(norm) as text_sha256 from g
""")
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(given(spark, sf_dir, "documents"))
