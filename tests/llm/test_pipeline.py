"""The pipeline against its stages' brute-force versions, and on edge cases."""
import random
from collections import defaultdict

import pytest

import corpus_pipeline
from tests.llm.conftest import DOCS, edge_rows, words
from tests.llm.test_exact_dedup import brute as brute_exact
from tests.llm.test_near import brute_components, brute_repeats
from tests.llm.test_tokens import pieces_of, tokenized

FOLDER = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, tmp_path):
    docs, tables = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        tables[name] = docs = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert docs.columns == spark.read.parquet(f"{FOLDER}/documents.parquet").columns
    rows = {name: {r["doc_id"]: r["text"] for r in df.collect()} for name, df in tables.items() if name != "packing"}
    kept = {k for (k, _, _, stays, _) in brute_exact(rows["quality"].items()) if stays}
    assert set(rows["exact"]) == kept
    assert set(rows["near"]) == {i for (i, _, component) in brute_components(list(rows["exact"].items())) if i == component}
    texts = list(rows["near"].items())
    for (i, text), (_, spans, _) in zip(texts, brute_repeats([t for _, t in texts], 200)):
        data, left = text.encode(), b""
        at = 0
        for a, b in spans:
            left, at = left + data[at:a], b
        assert rows["repeats"][i] == (left + data[at:]).decode("utf-8", "ignore")
    want = {(i, *p[:2]) for (i, _), ids in zip(rows["repeats"].items(), tokenized(rows["repeats"].values())) for p in pieces_of(ids)}
    assert {(r["doc_id"], r["start"], r["length"]) for r in tables["packing"].collect()} == want
    found = corpus_pipeline.run(spark, FOLDER)
    assert {(r["doc_id"], r["start"], r["length"]) for r in found.collect()} == want


def test_edges_and_empty(spark, tmp_path):
    labels = spark.createDataFrame([(3, 1, 0), (8, 1, 0), (-7, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    for case, rows in (("edge", edge_rows()), ("empty", [])):
        base = tmp_path / case
        labels.write.parquet(str(base / "labels.parquet"))
        spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as `row`", "'x' as kept").write.parquet(str(base / "documents.parquet"))
        docs = spark.read.parquet(str(base / "documents.parquet"))
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, docs, str(base)).write.parquet(str(base / name))
            docs = spark.read.parquet(str(base / name))
        if case == "empty":
            assert docs.count() == 0
            continue
        exact = defaultdict(int)
        for r in spark.read.parquet(str(base / "exact")).collect():
            exact["".join((r["text"] or "").split())] += 1
        assert set(exact.values()) == {1}


@pytest.mark.parametrize("name", ["exact", "near"])
def test_rows_are_told_apart_when_scans_are_split_differently(spark, tmp_path, name):
    """The stage decides in one scan and drops in a later one, which splits the files in another way."""
    rng = random.Random(11)
    texts = [words(rng, 60 + 10 * i) for i in range(6)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate([*texts, texts[1], texts[4]])]
    for i in range(4):  # files of different sizes
        spark.createDataFrame(rows[2 * i : 2 * i + 2], DOCS).coalesce(1).write.mode("append").parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    settings = {"spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1", "spark.sql.files.maxPartitionBytes": "100000000"}
    parts = docs.rdd.getNumPartitions()
    left = dict(corpus_pipeline.STAGES)[name](spark, docs, FOLDER)
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        assert spark.read.parquet(str(tmp_path / "docs")).rdd.getNumPartitions() < parts
        found = sorted(r["doc_id"] for r in left.collect())
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert found == [0, 1, 2, 3, 4, 5]
