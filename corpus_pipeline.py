"""From raw documents to training sequences: filter, remove duplicates, cut repeats, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's ``docs``. All but the last return the columns of ``docs``. A stage looks at all rows
that its predecessor kept. ``docs`` must be a table read from Parquet files, as its rows are named by file and place.
Rows of a null ``doc_id`` are documents like any other, and rows that share an id are told apart.
"""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from llm.common import given, shared_folder
from llm.exact_dedup import exact_groups
from llm.jaccard import near_duplicates
from llm.packing import decompose, tokenizer_file
from llm.quality import classify, trusted_ids
from llm.repeats import remove_repeats

BROADCAST_ROWS = 1_000_000  # dropped rows that are broadcast; more are joined by shuffle


def _place() -> list[Column]:
    """A row's file (its hash) and number therein, the same in every scan, however Spark splits the files among tasks."""
    return [F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]


def _named(docs: DataFrame) -> DataFrame:
    """``doc_id`` (a name of its own for every row, in the order of ids, nulls last) and ``text``."""
    name = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), *_place())
    return docs.select(name.alias("doc_id"), "text")


def _without(docs: DataFrame, dropped: DataFrame, on: list[Column], names: list[str]) -> DataFrame:
    """The rows of ``docs`` whose values ``on`` are not among the rows of ``dropped``, null-safe."""
    dropped = dropped.select(*[F.col(n).alias(f"__dropped_{i}") for i, n in enumerate(names)]).distinct()
    dropped = F.broadcast(dropped) if dropped.count() <= BROADCAST_ROWS else dropped
    keyed = docs.withColumns({f"__key_{i}": c for i, c in enumerate(on)})
    same = [F.col(f"__key_{i}").eqNullSafe(F.col(f"__dropped_{i}")) for i in range(len(on))]
    return keyed.join(dropped, same, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects. Null and empty texts go; equal texts of a language share one decision; a null language is one of its own."""
    judged = classify(docs, trusted_ids(given(spark, sf_dir, "labels")))
    return _without(docs, judged.filter("not kept"), [F.xxhash64("text"), F.col("lang")], ["text_hash", "lang"])


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, white space aside: the longest, then the smallest id (nulls last), then by file and place. Null counts as empty."""
    dropped = exact_groups(_named(docs)).filter("not kept").select("doc_id.file", "doc_id.row")
    return _without(docs, dropped, _place(), ["file", "row"])


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id (nulls last, ties by file and place) of each component of similar documents. Texts without words, null ones too, are linked with nothing and stay."""
    dropped = near_duplicates(_named(docs)).filter("doc_id <> component_id").select("doc_id.file", "doc_id.row")
    return _without(docs, dropped, _place(), ["file", "row"])


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the passages that also stand elsewhere; ``n_chars`` follows the new text. A null text becomes an empty one, repeated rows lose theirs, ids play no part."""
    rest = [c for c in docs.columns if c != "text"]
    carried = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("doc_id"), "text")
    cut = remove_repeats(carried, as_text=True)
    columns = {c: F.col("kept") if c == "text" else F.col("doc_id").getField(c) for c in docs.columns}
    if "n_chars" in columns:
        columns["n_chars"] = F.char_length("kept").cast(docs.schema["n_chars"].dataType)
    return cut.select(*[column.alias(c) for c, column in columns.items()])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences of a power of two of ids; a null or empty text is the end id alone, and repeated rows give their sequences again."""
    return decompose(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("repeats", repeats), ("packing", packing)]

#: Tokenizers and language models are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; tables between stages stand in the shared folder, and go once they are read."""
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs = given(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES[:-1]:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            place = spark._jvm.org.apache.hadoop.fs.Path(before)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
