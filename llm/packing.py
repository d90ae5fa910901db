"""Packing by power-of-two decomposition."""
from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from llm.common import codepoints, given, query, ranges, slices
from llm.words import WordCache, byte_bpe_starts

SLICE = 1 << 20  # bytes of text that a task encodes at a time


def tokenizer_file(name: str) -> str:
    """The file of a public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(4)
def byte_bpe(path: str, plain: bool = False) -> tuple[WordCache, re.Pattern | None]:
    """A cache of pre-tokens' ids, and what finds the vocabulary's added tokens in a text (nothing if they count as ``plain`` text)."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = plain
    added = [] if plain else list(tokenizer.get_added_tokens_decoder().values())
    if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added):
        raise ValueError(f"{path}: only added tokens that match their own text are read")
    names = sorted((t.content for t in added), key=len, reverse=True)
    found = re.compile("|".join(map(re.escape, names))) if names else None
    return WordCache(lambda words: [e.ids for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)]), found


def text_ids(texts: list[str | None], cache: WordCache, added: re.Pattern | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the texts end to end, and the n + 1 places where each text's begin. Texts are cut at ``added`` tokens first."""
    points, starts = codepoints(texts)
    text = "".join(t or "" for t in texts)
    if not len(points):
        return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    # Searched text by text, as a token does not cross texts.
    spans = [(a + m.start(), a + m.end()) for t, a in zip(texts, starts.tolist()) if t for m in added.finditer(t)] if added else []
    edges = np.array(spans, np.int64).reshape(-1, 2)
    first = byte_bpe_starts(points, np.union1d(starts, edges) if len(edges) else starts)
    if len(edges):
        token = np.searchsorted(edges[:, 0], first, "right") - 1
        inside = (token >= 0) & (first > edges[token, 0]) & (first < edges[token, 1])
        first = first[~inside]
    ids, sizes = cache.ids(text, points, first, np.append(first[1:], len(points)))
    return ids, np.concatenate([[0], np.cumsum(sizes)])[np.searchsorted(first, starts)]


def binary_pieces(totals: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """How many pieces each total splits into, and their lengths end to end: whole ``longest`` ones, then its binary digits."""
    digits = longest.bit_length() - 1
    below = np.arange(digits - 1, -1, -1)
    counts = np.column_stack([totals >> digits, (totals[:, None] >> below) & 1]) if digits else totals[:, None]
    kinds = np.concatenate([[longest], 1 << below]) if digits else np.array([1])
    return counts.sum(1), np.repeat(np.tile(kinds, len(totals)), counts.ravel())


def decompose(docs: DataFrame, tokenizer: str, longest: int = 2048, end_id: int = 1, plain: bool = False) -> DataFrame:
    """Split every document into pieces whose lengths are powers of two, each a sequence by itself.

    Returns ``doc_id``, ``start``, ``length``, ``ids`` (little-endian unsigned 32-bit), ``doc_tokens``,
    ``bucket`` (the length's binary logarithm), ``sequence_id`` and ``offset`` (0). A document is its
    ids by the vocabulary at ``tokenizer`` and ``end_id``; a null or empty text is that id alone. First
    come whole pieces of ``longest`` (a power of two) ids, then one piece per binary digit of what
    is left, largest first, so no sequence crosses documents and none needs padding. The strings of added
    tokens in a text become these tokens, as the library has it, unless ``plain`` makes them plain text. Repeated rows give their pieces again, under other
    sequence ids; a null id is kept; other columns are ignored.

    Nothing is shuffled, so a hot source or length cannot gather in a task. Distinct pre-tokens are
    encoded once per worker, and their cache is bounded. ``sequence_id`` is unique within a result: it
    comes from the place of the piece in its partition, with ``bucket`` in its last four bits.
    ``write_buckets`` puts equal lengths into one folder each.
    """
    if longest < 1 or longest & (longest - 1) or longest > 32768:
        raise ValueError(f"longest is {longest}; it must be a power of two up to 32768")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, added = byte_bpe(tokenizer, plain)
        for batch in slices(batches, SLICE):
            ids, places = text_ids(batch.column("text").to_pylist(), cache, added)
            ids, totals = np.insert(ids, places[1:], end_id), np.diff(places) + 1
            numbers, lengths = binary_pieces(totals, longest)
            of, ends = np.repeat(np.arange(len(totals)), numbers), np.cumsum(lengths)
            starts = ends - lengths - np.repeat(np.cumsum(totals) - totals, numbers)
            cuts = pa.py_buffer(np.concatenate([[0], ends * 4]).astype(np.int32))
            binary = pa.Array.from_buffers(pa.binary(), len(lengths), [None, cuts, pa.py_buffer(ids.astype("<u4"))])
            yield pa.record_batch({
                "doc_id": batch.column("doc_id").take(pa.array(of)), "start": pa.array(starts), "length": pa.array(lengths),
                "ids": binary, "doc_tokens": pa.array(totals[of]), "bucket": pa.array(np.log2(lengths).astype(np.int32)),
            })

    cut = docs.select("doc_id", "text").mapInArrow(
        pieces, "doc_id long, start long, length long, ids binary, doc_tokens long, bucket int"
    )
    number = F.monotonically_increasing_id() * 16 + F.col("bucket")
    return cut.withColumn("sequence_id", number).withColumn("offset", F.lit(0).cast("long"))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Write the sequences with one folder per length, from which batches of equal length can be read."""
    pieces.write.mode("overwrite").partitionBy("bucket").parquet(path)


@query()
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = decompose(given(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
