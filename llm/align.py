"""Alignment of two tokenizers' tokens by coalescing their byte ranges."""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from llm.common import given, query, ranges, slices, store, utf8
from llm.packing import byte_bpe, text_ids, tokenizer_file
from llm.pieces import piece_ids, spellings

SLICE = 1 << 19  # bytes of text that a task aligns at a time
LINKS = 1 << 20  # links that a task counts or looks up at a time
HELD = 1 << 21  # pairs whose counts a task holds
HOT = 1 << 20  # pairs whose counts are broadcast; occurrences of the others are joined
STEPS = 16  # classes of counts between two powers of two, for choosing these


@lru_cache(2)
def byte_spellings(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of every entry of a byte-level vocabulary end to end, where each begins and how many it has.

    An entry is spelt with one character per byte: printable bytes stand for themselves, the others, in order, for 256 and on.
    """
    from tokenizers import Tokenizer

    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    byte_of = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}
    vocabulary = Tokenizer.from_file(path).get_vocab(with_added_tokens=False)
    spelt = [b""] * (max(vocabulary.values()) + 1)
    for entry, i in vocabulary.items():
        spelt[i] = bytes(byte_of[c] for c in entry)
    sizes = np.fromiter(map(len, spelt), np.int64, len(spelt))
    return np.frombuffer(b"".join(spelt), np.uint8), np.cumsum(sizes) - sizes, sizes


@lru_cache(1)
def _digits(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The decimal digits of the numbers below n, a comma after each, end to end, where each begins and how many bytes it has."""
    texts = [b"%d," % i for i in range(n)]
    sizes = np.fromiter(map(len, texts), np.int64, n)
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum(sizes) - sizes, sizes


class Side:
    """The tokens of one tokenizer over some texts, as ranges of bytes of the texts end to end."""

    def __init__(self, ids: np.ndarray, places: np.ndarray, table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
        flat, begin, sizes = table
        self.ids, self.size = ids.astype(np.int64), sizes[ids]
        self.of = np.repeat(np.arange(len(places) - 1), np.diff(places))
        self.data = flat[ranges(begin[ids], self.size)]
        self.bytes = np.concatenate([[0], np.cumsum(self.size)])[places]  # where each text's begin

    def keep(self, texts: np.ndarray) -> None:
        """Only the tokens of the texts that are marked, whose bytes then close up."""
        if not texts.all():
            mine = texts[self.of]
            self.ids, self.size, self.of = self.ids[mine], self.size[mine], self.of[mine]
        self.end = np.cumsum(self.size)
        self.start = self.end - self.size


def spelt(side: Side, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Which texts the side's tokens spell byte for byte."""
    same = np.diff(side.bytes) == np.diff(starts)
    if same.all() and np.array_equal(side.data, data):
        return same
    for i in np.flatnonzero(same).tolist():
        same[i] = np.array_equal(side.data[side.bytes[i] : side.bytes[i + 1]], data[starts[i] : starts[i + 1]])
    return same


def groups(a: Side, b: Side) -> np.ndarray:
    """The group of every token of ``a``, then of ``b``: sorted by start, a new one opens where a start reaches the furthest end so far."""
    start, end = np.concatenate([a.start, b.start]), np.concatenate([a.end, b.end])
    order = np.lexsort((np.arange(len(start)), start))
    reached = np.maximum.accumulate(end[order])
    opens = np.ones(len(order), bool)
    opens[1:] = start[order][1:] >= reached[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(opens) - 1
    return group


def links(a: Side, b: Side, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places in ``a`` and in ``b`` of all pairs of tokens that share a byte, expanded within the groups."""
    own, other = group[: len(a.ids)], group[len(a.ids) :]
    # In a group with one token on either side the pair is known; only the rest is searched.
    first = np.searchsorted(other, own, "left")
    last = first + 1
    many = np.flatnonzero((np.bincount(own) + np.bincount(other))[own] > 2) if len(own) else own
    first[many] = np.searchsorted(b.end, a.start[many], "right")
    last[many] = np.searchsorted(b.start, a.end[many], "left")
    return np.repeat(np.arange(len(own)), last - first), ranges(first, last - first)


def _hashed(a: Side, b: Side, group: np.ndarray, texts: int) -> list[str]:
    """Per text the SHA-256 of its groups: ids with commas, sides with a bar, groups with semicolons between them; "" without tokens."""
    key = 2 * group
    key[len(a.ids) :] += 1
    order = np.argsort(key, kind="stable")
    key, ids = key[order], np.concatenate([a.ids, b.ids])[order]
    flat, begin, sizes = _digits(1 << int(max(1 << 16, ids.max(initial=0) + 1) - 1).bit_length())
    written = flat[ranges(begin[ids], sizes[ids])]
    commas = np.cumsum(sizes[ids]) - 1
    last = np.flatnonzero(key[1:] != key[:-1])
    written[commas[last]] = np.where(key[last] & 1, ord(";"), ord("|"))
    number = np.bincount(a.of, minlength=texts) + np.bincount(b.of, minlength=texts)
    ends = np.concatenate([[0], commas + 1])[np.concatenate([[0], np.cumsum(number)])].tolist()
    whole = written.tobytes()
    return [hashlib.sha256(whole[x : y - 1]).hexdigest() if y > x else "" for x, y in zip(ends, ends[1:])]


def _aligned(batches: Iterator[pa.RecordBatch], byte_file: str, piece_file: str) -> Iterator[pa.RecordBatch]:
    table_a, table_b = byte_spellings(byte_file), spellings(piece_file)
    kind = _code_type(byte_file, piece_file)
    cache, _ = byte_bpe(byte_file, True)
    for batch in slices(batches, SLICE):
        texts = [t or "" for t in batch.column("text").to_pylist()]
        full = pa.array([" " + t if t else "" for t in texts], pa.string())
        data, starts = utf8(full)
        a = Side(*text_ids(full.to_pylist(), cache), table_a)
        b = Side(*piece_ids(texts, piece_file), table_b)
        good = spelt(a, data, starts) & spelt(b, data, starts)
        a.keep(good)
        b.keep(good)
        n = len(texts)
        group = groups(a, b)
        left, right = links(a, b, group)
        of = a.of[left]
        number = np.bincount(of, minlength=n)
        codes = (a.ids[left] * len(table_b[1]) + b.ids[right]).astype(kind)
        cuts = pa.py_buffer(np.concatenate([[0], np.cumsum(number) * codes.itemsize]).astype(np.int32))
        opens = np.flatnonzero(np.diff(group[: len(a.ids)], prepend=-1))  # every group has a token of either side
        yield pa.record_batch({
            "row": batch.column("row"), "doc_id": batch.column("doc_id"), "n_a": pa.array(np.bincount(a.of, minlength=n)),
            "n_b": pa.array(np.bincount(b.of, minlength=n)), "n_groups": pa.array(np.bincount(a.of[opens], minlength=n)), "n_links": pa.array(number),
            "groups_sha256": pa.array(_hashed(a, b, group, n), pa.string()),
            "codes": pa.Array.from_buffers(pa.binary(), n, [None, cuts, pa.py_buffer(codes)]),
        })


def _code_type(byte_file: str, piece_file: str) -> str:
    pairs = len(byte_spellings(byte_file)[1]) * len(spellings(piece_file)[1])
    return "<i4" if pairs < 1 << 31 else "<i8"


def _codes(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches of about ``LINKS`` links, their links end to end, and the n + 1 places where each row's begin."""
    size = np.dtype(kind).itemsize
    for batch in slices(batches, LINKS * size, "codes"):
        data, starts = utf8(batch.column("codes"))
        yield batch, data.view(kind) if data.ctypes.data % size == 0 else data.copy().view(kind), starts // size


def _counted(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    """Pairs and how often the task has them, handed on when there are many."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def merged() -> tuple[np.ndarray, np.ndarray]:
        codes, counts = (np.concatenate(x) for x in zip(*held))
        codes, of = np.unique(codes, return_inverse=True)
        return codes, np.bincount(of, counts, len(codes)).astype(np.int64)

    for _, codes, _ in _codes(batches, kind):
        held.append(np.unique(codes, return_counts=True))
        if sum(len(c) for c, _ in held) > HELD:
            held = [merged()]
            if len(held[0][0]) > HELD // 2:
                yield pa.record_batch({"code": pa.array(held[0][0].astype(np.int64)), "n": pa.array(held[0][1])})
                held = []
    if held:
        codes, counts = merged()
        yield pa.record_batch({"code": pa.array(codes.astype(np.int64)), "n": pa.array(counts)})


def _looked_up(batches: Iterator[pa.RecordBatch], table, kind: str) -> Iterator[pa.RecordBatch]:
    """Per row the sums over the links whose pair is broadcast, and a row for each other pair with its times."""
    hot, counts, best = table.value
    carried = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    for batch, codes, starts in _codes(batches, kind):
        n = len(batch)
        of = np.repeat(np.arange(n), np.diff(starts))
        at = np.minimum(np.searchsorted(hot, codes), max(0, len(hot) - 1))
        known = hot[at] == codes if len(hot) else np.zeros(len(codes), bool)
        sums = np.concatenate([[0], np.cumsum(np.where(known, counts[at], 0) if len(hot) else known, dtype=np.int64)])
        bests = np.concatenate([[0], np.cumsum(known & best[at] if len(hot) else known, dtype=np.int64)])
        yield pa.record_batch([*[batch.column(c) for c in carried], pa.array(bests[starts[1:]] - bests[starts[:-1]]),
                               pa.array(sums[starts[1:]] - sums[starts[:-1]]), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())],
                              names=[*carried, "n_best", "count_sum", "code", "times"])
        rare = np.flatnonzero(~known)
        if len(rare):
            rare = rare[np.lexsort((codes[rare], of[rare]))]
            new = np.ones(len(rare), bool)
            new[1:] = (codes[rare[1:]] != codes[rare[:-1]]) | (of[rare[1:]] != of[rare[:-1]])
            first = np.flatnonzero(new)
            m = len(first)
            none = [pa.nulls(m, batch.column(c).type) for c in carried[1:]]
            yield pa.record_batch([batch.column("row").take(pa.array(of[rare[first]])), *none, pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()),
                                   pa.array(codes[rare[first]].astype(np.int64)), pa.array(np.diff(np.append(first, len(rare))))],
                                  names=[*carried, "n_best", "count_sum", "code", "times"])


def pair_counts(linked: DataFrame, width: int, kind: str) -> DataFrame:
    """``code``, ``n`` and ``best`` (whether no pair with its B id has more) of every pair that is linked anywhere."""
    counts = linked.select("codes").mapInArrow(lambda b: _counted(b, kind), "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    counts, remove = store(counts)
    of = F.pmod("code", F.lit(width).cast("long")).alias("b")
    most = counts.groupBy(of).agg(F.max("n").alias("most"))  # a row per entry of B's vocabulary at most, so it can be broadcast
    marked, _ = store(counts.withColumn("b", of).join(F.broadcast(most), "b").select("code", "n", (F.col("n") == F.col("most")).alias("best")))
    remove()
    return marked


def _frequent(counts: DataFrame) -> DataFrame:
    """The most frequent pairs, at most ``HOT``: all from the lowest class of counts on, of some per power of two, from which they are that few."""
    size = F.floor(F.log2("n") * STEPS)
    left, least = HOT, None
    for row in sorted(counts.groupBy(size.alias("size")).count().collect(), reverse=True):
        left -= row["count"]
        if left < 0:
            break
        least = row["size"]
    return counts.filter(size >= least) if least is not None else counts.limit(0)


def align(docs: DataFrame, byte_file: str, piece_file: str) -> DataFrame:
    """Align the tokens of a byte-level vocabulary (A) and of a merge-type one with byte fallback (B) in every whole text.

    A encodes a space and the text, B the text, to which it adds the space; the strings of special tokens are plain text. Returns
    per row ``doc_id``, ``n_a`` and ``n_b`` (tokens), ``n_groups`` (ranges between the byte offsets where tokens of both end),
    ``n_links`` (pairs of an A and a B token that share a byte), ``n_best`` (links whose pair of ids has the most links of its B id in
    the whole of ``docs``, ties included), ``count_sum`` (over the links, how many links their pair has) and ``groups_sha256``
    (of the groups' ids, "" without tokens). A null or empty text has no tokens, nor has one whose A or B tokens do
    not spell the space and the text byte for byte (one with U+2581, say, which B takes for a space). Such a text has
    zeros. Repeated rows come out again and count again, a null id is kept, other columns are ignored.

    Texts are encoded once: groups and links are found by sorting token ranges, in numpy, and links are written with the counts of
    their text as a table. A pass over that counts pairs of ids, in each task first; their number is bounded by the vocabularies. The
    most frequent pairs, at most ``HOT``, are broadcast for a second pass; occurrences of the others, a row per text and pair, are
    joined with the counts by shuffle, where no pair is hot.
    """
    kind, width = _code_type(byte_file, piece_file), len(spellings(piece_file)[1])
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    linked, remove = store(rows.mapInArrow(
        lambda b: _aligned(b, byte_file, piece_file),
        "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, codes binary",
    ))
    counts = pair_counts(linked, width, kind)
    hot = _frequent(counts).toArrow().sort_by("code")
    columns = hot["code"].to_numpy().astype(kind), hot["n"].to_numpy(), hot["best"].to_numpy()
    table = docs.sparkSession.sparkContext.broadcast(columns)
    found, _ = store(linked.mapInArrow(
        lambda b: _looked_up(b, table, kind),
        "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long, code long, times long",
    ))
    remove()
    rare = found.filter("code is not null").select("row", "code", "times").join(counts, "code")
    rest = rare.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum")
    )
    whole = found.filter("code is null").join(rest, "row", "left")
    none = F.lit(0).cast("long")
    return whole.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("more_best", none)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", none)).alias("count_sum"), "groups_sha256",
    )


@query()
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(given(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))
