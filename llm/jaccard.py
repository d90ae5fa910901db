"""Near duplicates: documents linked by the Jaccard similarity of their word shingles."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from llm.common import checkpoint, given, mix, query, slices, store, type_of, utf8
from llm.components import components
from llm.words import segment_hashes

SLICE = 1 << 19  # bytes of text that a task reads at a time
WORDS = 5
BUCKETS, CHUNK = 1 << 22, 4096  # of the table of shingle frequencies: 16 MB, whatever the input
HELD = 1 << 21  # shingles that a task gathers before it counts them
SEEDS = (0x2545F4914F6CDD1D, 0x9E6C63D0876A9A47, 0xD1342543DE82EF95, 0xA0761D6478BD642F)  # of the other orders
BROADCAST_ROWS = 1_000_000  # rows of a table of two numbers that are broadcast; more are joined by shuffle


def shingles(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of every text by hash, and the n + 1 places where each text's begin; sorted within a text."""
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    gap = np.zeros(256, bool)
    gap[[32, 9, 10, 11, 12, 13]] = True
    inside = np.r_[False, ~gap[data], False]
    begins = np.zeros(len(data) + 1, bool)
    begins[starts] = True
    first = np.flatnonzero(inside[1:-1] & (~inside[:-2] | begins[:-1]))
    last = np.flatnonzero(inside[1:-1] & (~inside[2:] | begins[1:])) + 1
    words = segment_hashes(lower[data], first, last)
    at = np.searchsorted(first, starts)  # each text's first word
    number = np.diff(at)
    step = np.uint64(0x9E3779B97F4A7C15)
    if len(words) >= WORDS:
        folded = words[: len(words) - WORDS + 1].copy()
        for k in range(1, WORDS):
            folded = folded * step ^ words[k : len(words) - WORDS + 1 + k]
        folded = mix(folded)
    else:
        folded = np.zeros(0, np.uint64)
    many = np.maximum(number - WORDS + 1, 0)
    of = np.repeat(np.arange(len(number)), many)
    place = np.repeat(at[:-1], many) + np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
    values = folded[place]
    few = np.flatnonzero((number > 0) & (number < WORDS))
    if len(few):
        short = np.array([_fold(words[at[i] : at[i + 1]], step) for i in few.tolist()], np.uint64)
        values, of = np.concatenate([values, mix(short)]), np.concatenate([of, few])
    order = np.lexsort((values, of))
    values, of = values[order], of[order]
    new = np.r_[True, (of[1:] != of[:-1]) | (values[1:] != values[:-1])] if len(of) else np.zeros(0, bool)
    values, of = values[new], of[new]
    return values, np.searchsorted(of, np.arange(len(number) + 1))


def _fold(words: np.ndarray, step: np.uint64) -> int:
    value = np.uint64(len(words))
    with np.errstate(over="ignore"):
        for word in words:
            value = value * step ^ word
    return value


def _classes(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash per set, whatever the order."""
    number = np.diff(ends)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(values ^ np.uint64(SEEDS[0])), dtype=np.uint64)])
    return mix(sums[ends[1:]] - sums[ends[:-1]] + number.astype(np.uint64)).view(np.int64)


def _buckets(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(42)).astype(np.int32)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row.

    A text's words are its stretches without ASCII white space, A-Z in lower case; its set holds its distinct
    5-word shingles, or the whole sequence where it has fewer words; texts without words (and null) have none. Two documents link
    when their sets share at least three quarters of their union. ``component_id`` is the smallest ``doc_id`` that links reach, the
    document's own included. Equal sets are one class: each class is compared once, however many rows share
    it. Rows without words link with nothing. Repeated rows are linked; a null id is kept and is no one's component
    unless a component has no other. Other columns are ignored. ``doc_id`` may have any type with an order.

    Shingles, sets and texts are told apart by 64-bit hashes. Links are found in two steps, both exact in what they link:

    1. Under four orders of the shingles by hash, classes that share their first shingle are compared with the one
       of them whose shingles are the most frequent, as a copy with few changes has. This joins most copies
       of one text into a component without looking at their pairs.
    2. All remaining pairs: similar sets share a shingle among the first quarter (``n - ceil(3n / 4) + 1``) of either, under any global
       order. Candidates share one under the order that puts rare shingles first, lie in different components
       and pass the bounds on size and position.

    In both steps a pair must then also share a prefix shingle under each of two other global orders: prefixes of all orders are
    in one table, made in one pass, and only the texts of pairs that pass every filter are fetched and compared.

    Frequencies come from a fixed table of 4,194,304 counters, filled by all documents and broadcast; as the order is by
    counter, then hash, it is the same everywhere, so counters that shingles share cost time, never a link.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    members = checkpoint(rows.mapInArrow(_members, f"doc_id {type_of(docs, 'doc_id')}, text_hash long, n_shingles long, class long"))
    added = rows.select("text").mapInArrow(_counted, "chunk int, counts binary").repartition("chunk").mapInArrow(_added, "chunk int, counts binary")
    table = np.zeros(BUCKETS, np.int32)
    for row in added.collect():
        table[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = np.minimum(np.frombuffer(row["counts"], np.int64), 2**31 - 1)
    shared = docs.sparkSession.sparkContext.broadcast(table)
    classes = checkpoint(members.filter("n_shingles > 0").groupBy("class").agg(F.min("doc_id").alias("least_id"), F.min("text_hash").alias("text_hash")))

    signs, remove = store(rows.select("text").mapInArrow(
        lambda b: _signs(b, shared), "class long, n int, common double, least array<long>, prefix array<long>, second array<int>, third array<int>"
    ))
    firsts = signs.select("class", "n", "common", F.posexplode("least").alias("order", "shingle"))
    stars = firsts.groupBy("order", "shingle").agg(F.max(F.struct("common", "class", "n")).alias("star"))
    stars = stars.select(F.struct("order", "shingle").alias("of"), "star")  # in a struct, so that a common shingle can be split
    seeds = firsts.join(stars, F.struct("order", "shingle") == F.col("of")).select(F.col("star.class").alias("a"), F.col("class").alias("b"), F.col("star.n").alias("m"), "n")
    seeds = seeds.filter("a <> b and 4 * least(m, n) >= 3 * greatest(m, n)").select("a", "b").distinct()
    links = checkpoint(_linked(_filtered(checkpoint(seeds), signs), classes, rows))
    groups = components(links).withColumnRenamed("node", "class")

    marked = signs.select("class", "n", "prefix").join(_broadcast(groups), "class", "left")
    tokens = marked.select("class", "n", F.coalesce("component", "class").alias("part"), F.posexplode("prefix").alias("place", "shingle"))
    x, y = tokens.alias("x"), tokens.alias("y")
    small, large = F.least("x.n", "y.n"), F.greatest("x.n", "y.n")
    room = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
    pairs = x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.class") < F.col("y.class")) & (F.col("x.part") != F.col("y.part"))
                   & (4 * small >= 3 * large) & (7 * room >= 3 * (F.col("x.n") + F.col("y.n"))))
    pairs = checkpoint(pairs.select(F.col("x.class").alias("a"), F.col("y.class").alias("b")).distinct())
    more = checkpoint(_linked(_filtered(pairs, signs), classes, rows))
    remove()
    groups = components(links.union(more)).withColumnRenamed("node", "class")

    named = classes.join(groups, "class", "left").select("class", "least_id", F.coalesce("component", "class").alias("part"))
    least = named.groupBy("part").agg(F.min("least_id").alias("component_id"))
    ids = named.join(least, "part").select(F.col("class").alias("of"), "component_id")
    joined = members.join(ids, (F.col("class") == F.col("of")) & (F.col("n_shingles") > 0), "left")
    return joined.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def _broadcast(df: DataFrame) -> DataFrame:
    """Marked for broadcast if its size, which is counted, is within bounds; else Spark joins it as it finds best."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every row's class and the size of its set."""
    for batch in slices(batches, SLICE):
        values, ends = shingles(*utf8(batch.column("text")))
        yield pa.record_batch({
            "doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash"),
            "n_shingles": pa.array(np.diff(ends).astype(np.int64)), "class": pa.array(_classes(values, ends)),
        })


def _new_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Class, size and shingles of every set that the task has not had before."""
    seen: set[int] = set()
    for batch in slices(batches, SLICE):
        values, ends = shingles(*utf8(batch.column("text")))
        classes, number = _classes(values, ends), np.diff(ends)
        new = np.array([not (c in seen or seen.add(c)) for c in classes.tolist()], bool) & (number > 0)
        if new.any():
            yield classes[new], number[new], values[np.repeat(new, number)]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many distinct sets of the task have a shingle in each counter."""
    table, held = np.zeros(BUCKETS, np.uint32), []

    def count() -> None:
        np.add(table, np.bincount(np.concatenate(held), minlength=BUCKETS), out=table, casting="unsafe")
        held.clear()

    for _, _, values in _new_sets(batches):
        held.append(_buckets(values))
        if sum(map(len, held)) > HELD:
            count()
    if held:
        count()
    table = np.minimum(table, 2**16 - 1).astype(np.uint16).reshape(-1, CHUNK)
    some = np.flatnonzero(table.any(axis=1))
    yield pa.record_batch({"chunk": pa.array(some.astype(np.int32)), "counts": pa.array([table[c].tobytes() for c in some], pa.binary())})


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist()):
            sums[chunk] = sums.get(chunk, 0) + np.frombuffer(counts, np.uint16).astype(np.int64)
    if sums:
        yield pa.record_batch({"chunk": pa.array(list(sums), pa.int32()), "counts": pa.array([c.tobytes() for c in sums.values()], pa.binary())})


def _prefix_sizes(number: np.ndarray) -> np.ndarray:
    return np.where(number > 0, number - (3 * number + 3) // 4 + 1, 0)


def _signs(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """Of every new set of the task what links are looked for by.

    How frequent its shingles are (mean logarithm), the first one under each order by hash, the prefix with rare shingles first, and
    the prefixes under two other orders, of which 32 bits are enough: two shingles that share them let a pair pass, and lose none.
    """
    table = shared.value
    for classes, number, values in _new_sets(batches):
        of, starts = np.repeat(np.arange(len(number)), number), np.cumsum(number) - number
        counts = table[_buckets(values)]
        common = np.add.reduceat(np.log2(counts.astype(np.float64) + 1), starts) / number
        mixed = [mix(values ^ np.uint64(seed)) for seed in SEEDS]
        least = np.stack([np.minimum.reduceat(m, starts) for m in mixed], axis=1)
        taken = np.arange(len(of)) - np.repeat(starts, number) < np.repeat(_prefix_sizes(number), number)
        ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(of[taken], minlength=len(number)))]).astype(np.int32))
        prefix = values[np.lexsort((values, counts, of))][taken].view(np.int64)
        others = [(m[np.lexsort((m, of))][taken] & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32) for m in mixed[:2]]
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(number) + 1, dtype=np.int32) * len(SEEDS)), pa.array(least.ravel().view(np.int64)))
        columns = [pa.array(classes), pa.array(number.astype(np.int32)), pa.array(common), lists]
        columns += [pa.ListArray.from_arrays(ends, pa.array(some)) for some in (prefix, *others)]
        yield pa.record_batch(columns, names=["class", "n", "common", "least", "prefix", "second", "third"])


def _filtered(pairs: DataFrame, signs: DataFrame) -> DataFrame:
    """The pairs ``a``, ``b`` of classes that share a prefix shingle under the two other orders as well."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    own = signs.select("class", "second", "third").join(_broadcast(checkpoint(ids)), "class").groupBy("class").agg(F.first("second").alias("second"), F.first("third").alias("third"))
    sides = {}
    for side in ("a", "b"):  # in a struct, so that a class of many pairs can be split
        sides[side] = own.select(F.struct("class").alias(f"is_{side}"), F.col("second").alias(f"second_{side}"), F.col("third").alias(f"third_{side}"))
    both = pairs
    for side, some in sides.items():
        both = both.join(some, F.struct(F.col(side).alias("class")) == F.col(f"is_{side}"))
    shared = [F.arrays_overlap(f"{order}_a", f"{order}_b") for order in ("second", "third")]
    return checkpoint(both.filter(shared[0] & shared[1]).select("a", "b"))


def _linked(pairs: DataFrame, classes: DataFrame, rows: DataFrame) -> DataFrame:
    """Of the pairs ``a``, ``b`` of classes those that link, compared by a text of each."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    wanted = _broadcast(checkpoint(classes.join(ids, "class").select("class", "text_hash")))
    texts = rows.select("text_hash", "text").join(wanted, "text_hash").groupBy("class").agg(F.first("text").alias("text"))
    left = texts.select(F.struct("class").alias("is_a"), "text")  # in a struct, so that a class of many pairs can be split
    right = texts.select(F.struct("class").alias("is_b"), F.col("text").alias("other"))
    both = pairs.join(left, F.struct(F.col("a").alias("class")) == F.col("is_a")).join(right, F.struct(F.col("b").alias("class")) == F.col("is_b"))
    return both.select("a", "b", "text", "other").mapInArrow(_verified, "a long, b long")


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, SLICE // 2):
        left, left_ends = shingles(*utf8(batch.column("text")))
        right, right_ends = shingles(*utf8(batch.column("other")))
        sides = (left, np.diff(left_ends)), (right, np.diff(right_ends))
        common = _common([(values, np.repeat(np.arange(len(batch)), number)) for values, number in sides], len(batch))
        linked = 7 * common >= 3 * (sides[0][1] + sides[1][1])  # 4 * common >= 3 * union
        yield pa.record_batch({"a": batch.column("a"), "b": batch.column("b")}).filter(pa.array(linked))


def _common(sides: list[tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
    """How many values the two sides share, by pair."""
    values, of = (np.concatenate(x) for x in zip(*sides))
    order = np.lexsort((values, of))
    values, of = values[order], of[order]
    twice = (values[1:] == values[:-1]) & (of[1:] == of[:-1])
    return np.bincount(of[1:][twice], minlength=n)


@query()
def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(given(spark, sf_dir, "documents"))
