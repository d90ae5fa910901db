import random

import numpy as np
from pyspark.sql import functions as F

from llm import topk


def brute(rows, queries, k):
    found = {}
    for q, a in queries.items():
        scores = sorted((-sum(x * y for x, y in zip(a, b)), v) for v, b in rows.items() if v != q)[:k]
        found[q] = [(i + 1, v, -s) for i, (s, v) in enumerate(scores)]
    return found


def result(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(rows) for q, rows in out.items()}


def test_ties_sparse_rows_and_many_shards(spark, monkeypatch):
    monkeypatch.setattr(topk, "ENTRIES", 520)
    monkeypatch.setattr(topk, "TILE", 16)
    monkeypatch.setattr(topk, "ROWS", 3)
    rng = random.Random(1)
    rows = {i: [rng.choice([0, 0, 0, -2, 1, 3]) for _ in range(12)] for i in range(300)}
    df = spark.createDataFrame(list(rows.items()), "vec_id long, weights array<bigint>")
    queries = {i: rows[i] for i in rows if i % 20 == 0}
    found = result(topk.top_k(df, df.filter(F.col("vec_id") % 20 == 0), 7))
    assert found == brute(rows, queries, 7)


def test_bad_vectors_repeated_rows_and_clashing_columns(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [0.5, 0.25]), (0, [0.5, 0.25]), (1, [1.0, -0.0001]), (2, [nan, 1.0]), (3, None), (4, [inf, 0.0]), (5, [None, 1.0]), (6, [2.0]), (None, [1.0, 1.0]), (100, [0.0, 0.0]), (7, [])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumn("score", F.lit("x")).withColumn("shard", F.lit(1))
    every = topk.vectors(df)
    found = result(topk.top_k(every, every.filter("vec_id % 100 = 0"), 10))
    scaled = {0: [512, 256], 1: [1024, int(np.floor(1024 * np.float64(np.float32(-0.0001))))], 6: [2048], 100: [0, 0], 7: []}
    assert found == brute(scaled, {0: scaled[0], 100: scaled[100]}, 10)


def test_empty(spark):
    df = topk.vectors(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert topk.top_k(df, df, 3).count() == 0


def test_wide_weights(spark):
    """Sums beyond 32 bits, next to queries whose sums stay below."""
    rng = random.Random(2)
    rows = {i: [rng.choice([-1, 1]) * rng.randrange(10 ** (1 if i % 2 else 7)) for _ in range(40)] for i in range(120)}
    rows[7] = [2**31 - 1, -(2**31)] + [0] * 38
    df = spark.createDataFrame(list(rows.items()), "vec_id long, weights array<bigint>")
    queries = {i: rows[i] for i in rows if i < 10}
    assert result(topk.top_k(df, df.filter("vec_id < 10"), 6)) == brute(rows, queries, 6)
