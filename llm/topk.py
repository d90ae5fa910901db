"""Exact top-k search by inner product, term at a time."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from llm.common import given, query

ENTRIES = 1 << 20  # weights of the vectors whose postings one task holds at a time, and of the queries that meet them
TILE = 4_096  # vectors that are scored at a time, so that the score arrays stay in the processor's cache
ROWS = 64  # dense score arrays at a time


def scaled(vectors: Column, by: int = 1024) -> Column:
    """Each component x as floor(by * x), counted in double."""
    return F.transform(vectors, lambda x: F.floor(x.cast("double") * by))


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """For each query its ``k`` highest inner products, ties to the smaller ``vec_id``.

    Both tables have ``vec_id`` (long) and ``weights`` (integers, one per term); other columns
    are ignored. Returns ``query_id``, ``rank``, ``vec_id``, ``score``. A query never meets a row
    of its own id. Of rows that share an id only the smallest vector counts, so repeated rows
    change nothing. Rows with a null id, null vector or null weight take no part; vectors of
    different lengths are compared over the terms that both have. Sums are 64-bit and wrap.

    Candidates are dealt into shards, queries into blocks, and each (shard, block) is one
    group. Both hold about 1,048,576 weights (ids are dealt by hash), so fewer vectors the wider
    they are; a candidate is sent once per block, a query once per shard. In a group each term's
    postings are scattered, times the query's weight, into dense score arrays, of which the
    k best are selected by partition, tile by tile; a window merges the winners of the shards.
    """
    whole = lambda df: (
        df.select("vec_id", F.col("weights").cast("array<bigint>").alias("weights"))
        .filter(F.col("vec_id").isNotNull() & F.col("weights").isNotNull() & ~F.exists("weights", lambda x: x.isNull()))
        .groupBy("vec_id").agg(F.min("weights").alias("weights"))
    )
    size = F.sum(F.coalesce(F.array_size("weights"), F.lit(0)) + 1)  # a vector without weights takes room, too
    shards, blocks = ((df.agg(size).first()[0] or 0) // ENTRIES + 1 for df in (candidates, queries))
    deal = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = whole(candidates).withColumn("shard", deal(shards)).withColumn("block", every(blocks))
    right = whole(queries).withColumn("block", deal(blocks)).withColumn("shard", every(shards))

    def search(found: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found, asked = found.sort_values("vec_id"), asked.sort_values("vec_id")
        parts = [part for first in range(0, len(found), TILE) for part in _search(found[first : first + TILE], asked, k)]
        if not parts:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        best = pd.concat(parts).sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
        return best.groupby("query_id").head(k)

    best = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInPandas(
        search, "query_id long, vec_id long, score long"
    )
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search(found: pd.DataFrame, asked: pd.DataFrame, k: int) -> Iterator[pd.DataFrame]:
    ids, terms, weights = _sparse(found)
    query_ids, query_terms, query_weights = _sparse(asked)
    if not len(ids) or not len(query_ids):
        return
    # Postings: entries by term, each with the place of its vector.
    order = np.argsort(terms[1], kind="stable")
    holders, posted = terms[0][order], weights[order]
    width = int(max(terms[1].max(initial=-1), query_terms[1].max(initial=-1))) + 1
    cuts = np.searchsorted(terms[1][order], np.arange(width + 1))
    # Where no sum can reach 2^31, arrays of half the width hold the same scores.
    highest = lambda x: max(int(x.max(initial=0)), -int(x.min(initial=0)))
    kind = np.int32 if highest(posted) * highest(query_weights) * width < 1 << 31 else np.int64
    posted, query_weights = posted.astype(kind), query_weights.astype(kind)
    products = np.empty((ROWS, len(ids)), kind)
    for first in range(0, len(query_ids), ROWS):
        some = query_ids[first : first + ROWS]
        scores = np.zeros((len(some), len(ids)), kind)
        mine = (query_terms[0] >= first) & (query_terms[0] < first + ROWS)
        rows, at, by = query_terms[0][mine] - first, query_terms[1][mine], query_weights[mine]
        for term in np.unique(at):
            postings = slice(cuts[term], cuts[term + 1])
            of = at == term
            if 2 * (cuts[term + 1] - cuts[term]) * of.sum() > scores.size:  # a common term: with its zeros, without picking cells
                column, row = np.zeros(len(ids), kind), np.zeros(len(some), kind)
                column[holders[postings]], row[rows[of]] = posted[postings], by[of]
                scores += np.multiply(row[:, None], column, out=products[: len(some)])
            else:
                scores[np.ix_(rows[of], holders[postings])] += by[of][:, None] * posted[postings]
        places = [_best(line, np.flatnonzero(ids != query_id), k) for query_id, line in zip(some, scores)]
        of, at = np.repeat(np.arange(len(some)), list(map(len, places))), np.concatenate(places)
        yield pd.DataFrame({"query_id": some[of], "vec_id": ids[at], "score": scores[of, at].astype(np.int64)})


def _sparse(df: pd.DataFrame) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray], np.ndarray]:
    """Ids, and the weights that are not zero with their row and term."""
    lengths = df["weights"].map(len).to_numpy(np.int64)
    flat = np.concatenate([np.zeros(0, np.int64), *df["weights"]]).astype(np.int64)
    rows = np.repeat(np.arange(len(df)), lengths)
    terms = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    some = flat != 0
    return df["vec_id"].to_numpy(np.int64), (rows[some], terms[some]), flat[some]


def _best(line: np.ndarray, open_to: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest, the earlier (smaller id) first among equals."""
    if len(open_to) <= k:
        return open_to
    at = line[open_to]
    least = np.partition(at, len(at) - k)[len(at) - k]
    over = open_to[at > least]
    return np.concatenate([over, open_to[at == least][: k - len(over)]])


def vectors(embeddings: DataFrame) -> DataFrame:
    """``vec_id`` and integer ``weights`` of the vectors that hold only finite numbers."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return embeddings.filter(F.col("embedding").isNotNull()).filter(finite).select("vec_id", scaled(F.col("embedding")).alias("weights"))


@query("""
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as w from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.w, c.w)::bigint as score
  from v q join v c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id
)
select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::int as rank, vec_id, score
from s qualify rank <= 10
""")
def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = vectors(given(spark, sf_dir, "embeddings"))
    return top_k(every, every.filter(F.col("vec_id") % 100 == 0), 10)
