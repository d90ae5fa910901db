"""Repeated byte strings by depth-limited radix sort of suffixes."""
from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from llm.common import checkpoint, given, mix, query, slices, type_of, utf8

SLICE = 1 << 20  # bytes of text that a task reads at a time
STRETCH = 1 << 21  # window starts that are looked at together; longer texts go on in the next stretch
GRAM = 32  # bytes of the first digit
GROUP = 8_192  # contexts of one first digit that a task compares by itself
HELD = 250_000  # runs that a task settles among themselves before it sends them on
COMMON = 32  # contexts of one first digit among these, beyond which they are dealt one by one
SORTED, SETTLED, OPEN = 0, 1, 2  # kinds of runs: to be sorted by digit, repeated, known to go on
MARK = -1  # in the place of a run's start: says that a digit has other contexts elsewhere
A = pa.int64()


PRIME = np.uint64((1 << 31) - 1)
BASES = (1_234_567_891, 987_654_323)  # of the two hashes, whose first 31 and last 31 bits make one


def _reduced(x: np.ndarray) -> np.ndarray:
    """Modulo 2^31 - 1, for x below 2^62."""
    x = (x & PRIME) + (x >> np.uint64(31))
    x = (x & PRIME) + (x >> np.uint64(31))
    return np.where(x == PRIME, np.uint64(0), x)


@lru_cache(2)
def _powers(bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The powers of either base and of its inverse."""
    tables = []
    for base in BASES:
        pair = []
        for b in (base, pow(base, -1, int(PRIME))):
            table = np.ones(1, np.uint64)
            while len(table) <= 1 << bits:
                table = np.concatenate([table, _reduced(table * np.uint64(pow(b, len(table), int(PRIME))))])
            pair.append(table)
        tables.append(tuple(t.astype(np.uint32) for t in pair))
    return tables


class Rolling:
    """Hashes of any stretch of some bytes: two polynomials modulo the prime 2^31 - 1.

    Modulo 2^64 certain strings would collide whatever the base; here any two stretches of n bytes differ but for n in 2^31 bases of each.
    """

    def __init__(self, data: np.ndarray) -> None:
        values = _reduced(mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(2))[data]
        self.parts = []
        for up, down in _powers(max(21, int(len(data)).bit_length())):
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(_reduced(values * up[: len(data)]), out=sums[1:])  # below 2^64, as no task has 2^33 bytes at a time
            self.parts.append((_reduced(sums).astype(np.uint32), down))

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        high, low = (_reduced(_reduced(sums[last] + (PRIME - sums[first])) * down[first]) for sums, down in self.parts)
        return mix((high << np.uint64(31) | low) ^ ((last - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` values in a row."""
    n = len(values) - width + 1
    blocks = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    blocks[: len(values)] = values
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def contexts(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """The suffixes of at least ``length`` bytes, in runs that share their first digit.

    A suffix's first digit is the ``GRAM`` bytes with the least hash among its first ``length`` bytes, the leftmost if several, and how
    far in they lie. It depends on these bytes alone, so equal windows have equal digits; and neighbouring
    suffixes mostly have the same bytes for it, which is why they leave as one run. Returns per run the hash of the digit's bytes, the
    hash of all bytes under the run's windows, the text's index, the first start in the text, the number
    of starts, and where the digit lies after the first start.
    """
    found = []
    width = length - GRAM + 1
    for chunk in range(0, max(0, len(data) - length + 1), STRETCH):
        part = data[chunk : chunk + STRETCH + length - 1]
        hashed = Rolling(part)
        places = np.arange(len(part) - GRAM + 1)
        grams = hashed.of(places, places + GRAM)
        bits = np.uint64(22)
        least = _least((grams >> bits) << bits | places.astype(np.uint64), width)
        n = len(part) - length + 1
        text = np.searchsorted(starts, np.arange(chunk, chunk + n), "right") - 1
        at = np.flatnonzero(starts[text + 1] - np.arange(chunk, chunk + n) >= length)
        if not len(at):
            continue
        anchor = (least[at] & np.uint64((1 << 22) - 1)).astype(np.int64)
        begins = np.flatnonzero(np.r_[True, (np.diff(at) != 1) | (np.diff(anchor) != 0)])
        first, number = at[begins], np.diff(np.r_[begins, len(at)])
        ahead = anchor[begins] - first
        whole = mix(hashed.of(first, first + number - 1 + length) ^ ahead.astype(np.uint64))
        found.append((grams[anchor[begins]], whole, text[first], first + chunk - starts[text[first]], number, ahead))
    if not found:
        return tuple(np.zeros(0, d) for d in (np.uint64, np.uint64, *[np.int64] * 4))
    return tuple(np.concatenate(x) for x in zip(*found))


def _pack(first: np.ndarray, number: np.ndarray, ahead: np.ndarray) -> np.ndarray:
    return first << 24 | number << 12 | ahead


def repeated_spans(docs: DataFrame, length: int = 200, group: int = GROUP) -> DataFrame:
    """``text_hash`` and ``spans`` of every text of which a ``length``-byte string also starts elsewhere.

    ``spans`` are ``[start, end)`` in bytes, unordered and overlapping; a null marks a text that several rows share, all of which is repeated.

    Suffixes are ordered only as far as ``length`` bytes, digit by digit from the most significant one, and leave as soon as they
    are alone. The first pass deals runs of suffixes by their first digit (see ``contexts``) and sorts them by the digit and all
    the bytes under the run. A run equal to a neighbour is repeated as a whole. Of the others only those
    whose digit occurs with other bytes around it go on, one for each distinct context. The second pass
    fetches their bytes and sorts their suffixes by the digits to the left and to the right of the first; groups that
    are still equal after that are exactly the repeated windows. Digits are compared by 64-bit hashes, two or more in a row.

    No group is gathered, however common a text, passage or line is. Copies of a text leave a task once, and equal
    runs are settled in their task, which sends one of them on. A digit with many contexts in one task is known to
    go on: its contexts are dealt by themselves, and only a mark is dealt with the digit. In the second
    pass, a digit with more than ``group`` contexts is counted by a shuffle of its suffixes' digits with partial sums.
    """
    if not GRAM < length < 1 << 11:
        raise ValueError(f"length is {length}; it must be over {GRAM} and below 2048")
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text")).filter(F.octet_length("text") >= length)
    texts = texts.withColumn("text_hash", F.xxhash64("text"))
    runs = texts.mapInArrow(lambda b: _runs(b, length), "digit long, whole long, text_hash long, at long, kind int")
    deal = F.when(F.col("kind") == SORTED, F.col("digit")).when(F.col("kind") == SETTLED, F.col("text_hash") + F.col("at")).otherwise(F.col("whole"))
    sorted_ = runs.repartition(deal).sortWithinPartitions("digit", "whole")
    passed = checkpoint(sorted_.mapInArrow(_first_pass, "digit long, text_hash long, at long, open boolean"))
    settled = passed.filter(~F.col("open")).select("text_hash", _span(F.col("at"), length).alias("span"))
    open_ = passed.filter("open").select("digit", "text_hash", "at")
    many = open_.groupBy("digit").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > group).select("digit", F.lit(True).alias("many"))
    open_ = open_.join(many, "digit", "left").groupBy("text_hash").agg(F.collect_list(F.struct("digit", "at", "many")).alias("runs"))
    cut = texts.join(open_, "text_hash").mapInArrow(
        lambda b: _cut(b, length), "digit long, text_hash long, at long, bytes binary, start long, end long, left long, right long"
    )
    second = cut.repartition(F.coalesce("left", "digit")).sortWithinPartitions("digit")
    compared = checkpoint(second.mapInArrow(lambda b: _second_pass(b, length), "text_hash long, start long, end long, left long, right long"))
    certain = compared.filter(F.col("left").isNull()).select("text_hash", F.struct("start", "end").alias("span"))
    counted = compared.filter(F.col("left").isNotNull())
    shared = counted.groupBy("left", "right").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    counted = counted.join(shared, ["left", "right"]).select("text_hash", F.struct("start", "end").alias("span"))
    copies = texts.groupBy("text_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    copies = copies.select("text_hash", F.lit(None).cast("struct<start:long,end:long>").alias("span"))
    spans = settled.unionByName(certain).unionByName(counted).unionByName(copies)
    every = F.collect_list("span").alias("spans")
    whole = F.max(F.col("span").isNull()).alias("whole")
    return spans.groupBy("text_hash").agg(every, whole).select("text_hash", F.when(~F.col("whole"), F.col("spans")).alias("spans"))


def _span(at, length: int):
    first = F.shiftright(at, 24)
    number = F.shiftright(at, 12).bitwiseAND(4095)
    return F.struct(first.alias("start"), (first + number - 1 + length).alias("end"))


def _runs(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The runs of every new text of the task, to be sorted, settled or already known to go on (see ``repeated_spans``)."""
    seen: set[int] = set()
    held: list[np.ndarray] = []

    def out(rows: np.ndarray, kind: int) -> pa.RecordBatch:
        names = ("digit", "whole", "text_hash", "at")
        return pa.record_batch({**{n: pa.array(r) for n, r in zip(names, rows)}, "kind": pa.repeat(pa.scalar(kind, pa.int32()), rows.shape[1])})

    def flush() -> Iterator[pa.RecordBatch]:
        rows = np.concatenate(held, axis=1)
        held.clear()
        rows = rows[:, np.lexsort((rows[1], rows[0]))]
        new_digit = np.r_[True, rows[0, 1:] != rows[0, :-1]]
        new = new_digit | np.r_[True, rows[1, 1:] != rows[1, :-1]]
        repeated = ~new | ~np.r_[new[1:], True]
        if repeated.any():
            yield out(rows[:, repeated], SETTLED)
        ones, digit = rows[:, new], np.cumsum(new_digit[new]) - 1
        common = np.bincount(digit)[digit] > COMMON
        yield out(ones[:, ~common], SORTED)
        if common.any():
            yield out(ones[:, common], OPEN)
            marks = ones[:, common & new_digit[new]].copy()
            marks[1:3], marks[3] = 0, MARK
            yield out(marks, SORTED)

    for batch in slices(batches, SLICE):
        keys = batch.column("text_hash").to_pylist()
        new = [i for i, key in enumerate(keys) if not (key in seen or seen.add(key))]
        if not new:
            continue
        batch = batch.take(pa.array(new))
        digit, whole, text, first, number, ahead = contexts(*utf8(batch.column("text")), length)
        if len(digit):
            names = batch.column("text_hash").to_numpy()[text]
            held.append(np.stack([digit.view(np.int64), whole.view(np.int64), names, _pack(first, number, ahead)]))
        if sum(h.shape[1] for h in held) > HELD:
            yield from flush()
    if held:
        yield from flush()


def _first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over runs sorted by digit and whole: repeated runs, and one run (``open``) for each context of a digit that has several.

    The last row of a batch waits for the next batch, and so does the first run of a digit until another context follows.
    """
    held: np.ndarray | None = None  # the last row: digit, whole, text, at, and whether it equals the row before
    waiting: np.ndarray | None = None  # first row of the first run of the current digit

    def out(rows: np.ndarray, open_: bool) -> pa.RecordBatch:
        rows = rows[:, rows[3] != MARK]
        return pa.record_batch({"digit": pa.array(rows[0]), "text_hash": pa.array(rows[2]), "at": pa.array(rows[3]), "open": pa.repeat(open_, rows.shape[1])})

    for batch in batches:
        kind = batch.column("kind").to_numpy()
        rows = np.stack([*[batch.column(c).to_numpy() for c in ("digit", "whole", "text_hash", "at")], np.zeros(len(batch), np.int64)])
        for done, open_ in ((SETTLED, False), (OPEN, True)):
            if (kind == done).any():
                yield out(rows[:, kind == done], open_)
        rows = rows[:, kind == SORTED]
        if not rows.shape[1]:
            continue
        fresh = held is None
        if not fresh:
            rows = np.concatenate([held, rows], axis=1)
        n = rows.shape[1]
        same_digit = np.r_[False, rows[0, 1:] == rows[0, :-1]]
        same = same_digit & np.r_[False, rows[1, 1:] == rows[1, :-1]]
        same[0] = bool(rows[4, 0])
        followed = np.r_[same[1:], False]
        # Rows to settle now: all but the last one, whose next row is not known yet.
        repeated = np.flatnonzero((same | followed)[: n - 1])
        if len(repeated):
            yield out(rows[:, repeated], False)
        # Run starts; the held row's own start was looked at with its batch.
        begins = np.flatnonzero(~same)
        if not fresh:
            begins = begins[begins > 0]
        if len(begins):
            more = same_digit[begins]  # a second or later context of its digit
            picked = [rows[:, begins[more]]]
            if more[0] and waiting is not None:
                picked.append(waiting)
            leading = begins[:-1][~more[:-1] & more[1:]]
            picked.append(rows[:, leading])
            chosen = np.concatenate(picked, axis=1)
            if chosen.shape[1]:
                yield out(chosen, True)
            waiting = None if more[-1] else rows[:, begins[-1:]]
        held = rows[:, -1:].copy()
        held[4] = same[-1]
    if held is not None and held[4, 0]:
        yield out(held, False)


def _cut(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The bytes of every context; of digits with ``many`` contexts the digits of every window instead."""
    seen: set[int] = set()
    for batch in slices(batches, SLICE):
        keys = batch.column("text_hash").to_pylist()
        new = [i for i, key in enumerate(keys) if not (key in seen or seen.add(key))]
        if not new:
            continue
        batch = batch.take(pa.array(new))
        data, starts = utf8(batch.column("text"))
        lists = batch.column("runs")
        number = np.diff(lists.offsets.to_numpy())
        rows = lists.flatten()
        digit, at = rows.field("digit").to_numpy(), rows.field("at").to_numpy()
        many = rows.field("many").is_valid().to_numpy(zero_copy_only=False)
        text = batch.column("text_hash").to_numpy()[np.repeat(np.arange(len(batch)), number)]
        begin = np.repeat(starts[:-1], number)
        if (~many).any():
            first = (at >> 24) + begin
            sizes = (at >> 12 & 4095) - 1 + length
            cuts = [data[a : a + n].tobytes() for a, n in zip(first[~many].tolist(), sizes[~many].tolist())]
            none = pa.nulls(len(cuts), A)
            yield pa.record_batch({
                "digit": pa.array(digit[~many]), "text_hash": pa.array(text[~many]), "at": pa.array(at[~many]),
                "bytes": pa.array(cuts, pa.binary()), "start": none, "end": none, "left": none, "right": none,
            })
        if many.any():
            of, start, left, right = _window_digits(data, begin[many] + (at[many] >> 24), at[many], digit[many], length)
            n = len(of)
            yield pa.record_batch({
                "digit": pa.nulls(n, A), "text_hash": pa.array(text[many][of]), "at": pa.nulls(n, A), "bytes": pa.nulls(n, pa.binary()),
                "start": pa.array(start), "end": pa.array(start + length), "left": pa.array(left.view(np.int64)), "right": pa.array(right.view(np.int64)),
            })


def _window_digits(data: np.ndarray, places: np.ndarray, at: np.ndarray, digit: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Of every window of contexts that lie at ``places`` in ``data``: the context, the start in its text, and the digits left and right of the first."""
    first, number, ahead = at >> 24, at >> 12 & 4095, at & 4095
    of = np.repeat(np.arange(len(at)), number)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(number) - number, number)
    here, middle = places[of] + nth, places[of] + ahead[of]
    hashed = Rolling(data)
    return of, first[of] + nth, mix(digit.view(np.uint64)[of] ^ hashed.of(here, middle)), hashed.of(middle, here + length)


def _second_pass(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Compare the windows of the contexts of each digit, some thousand contexts at a time; windows that are to be counted pass."""
    kept: list[pa.RecordBatch] = []
    size, last = 0, None
    carried = ["text_hash", "start", "end", "left", "right"]
    for batch in batches:
        counted = batch.filter(batch.column("left").is_valid())
        if len(counted):
            yield counted.select(carried)
        batch = batch.filter(batch.column("left").is_null())
        if not len(batch):
            continue
        keys = batch.column("digit").to_numpy()
        starts = np.r_[0, np.flatnonzero(keys[1:] != keys[:-1]) + 1]
        for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(keys)]):
            if keys[start] != last and size > GROUP // 2:
                yield from _windows(pa.Table.from_batches(kept).combine_chunks(), length)
                kept, size = [], 0
            last = keys[start]
            kept.append(batch.slice(start, end - start))
            size += end - start
    if kept:
        yield from _windows(pa.Table.from_batches(kept).combine_chunks(), length)


def _windows(rows: pa.Table, length: int) -> Iterator[pa.RecordBatch]:
    data, starts = utf8(rows.column("bytes"))
    at = rows.column("at").to_numpy()
    text = rows.column("text_hash").to_numpy()
    of, start, left, right = _window_digits(data, starts[:-1], at, rows.column("digit").to_numpy(), length)
    alive = np.arange(len(of))
    for values in (left, right):  # a pass per digit; after each, suffixes that are alone leave
        group = np.zeros(len(alive), np.int64) if values is left else group
        order = np.lexsort((values[alive], group))
        alive, group = alive[order], group[order]
        change = np.r_[True, (np.diff(group) != 0) | (values[alive][1:] != values[alive][:-1])] if len(alive) else np.zeros(0, bool)
        group = np.cumsum(change)
        several = np.bincount(group)[group] > 1 if len(group) else np.zeros(0, bool)
        alive, group = alive[several], group[several]
    alive.sort()
    if not len(alive):
        return
    cuts = np.flatnonzero(np.r_[True, (np.diff(alive) != 1) | (np.diff(of[alive]) != 0)])
    head, tail = alive[cuts], alive[np.r_[cuts[1:], len(alive)] - 1]
    none = pa.nulls(len(head), A)
    yield pa.record_batch({
        "text_hash": pa.array(text[of[head]]), "start": pa.array(start[head]), "end": pa.array(start[tail] + length), "left": none, "right": none,
    })


def remove_repeats(docs: DataFrame, length: int = 200, group: int = GROUP, as_text: bool = False) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``removed`` and ``kept`` of every row.

    Every byte goes that lies in a ``length``-byte string (of the text in UTF-8) which also starts anywhere else, in this or
    another row; strings are judged on the input. ``removed`` lists the maximal removed runs as ``[start, end)`` in order,
    ``kept`` holds the bytes that are left, or with ``as_text`` the whole characters that are left. A null text is empty, shorter texts lose nothing. Rows that repeat another's
    text lose all of it if it has ``length`` bytes. A null id is kept, other columns are ignored. Texts are told
    apart by a 64-bit hash. ``doc_id`` may have any type.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    found = repeated_spans(docs, length, group).withColumn("hit", F.lit(True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", A), ("end", A)]))
        for batch in slices(batches, SLICE):
            data, starts = utf8(batch.column("text"))
            hits, lists = batch.column("hit").to_pylist(), batch.column("spans")
            removed, kept = [], []
            for i, (a, b) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist())):
                own = data[a:b]
                if not hits[i]:
                    removed.append([])
                    kept.append(own.tobytes())
                    continue
                spans = lists[i]
                if not spans.is_valid:
                    removed.append([{"start": 0, "end": b - a}])
                    kept.append(b"")
                    continue
                edges = np.zeros(b - a + 1, np.int32)
                np.add.at(edges, spans.values.field("start").to_numpy(), 1)
                np.add.at(edges, spans.values.field("end").to_numpy(), -1)
                inside = np.cumsum(edges[:-1]) > 0
                turns = np.flatnonzero(np.diff(np.r_[False, inside, False]))
                removed.append([{"start": x, "end": y} for x, y in zip(turns[::2].tolist(), turns[1::2].tolist())])
                kept.append(own[~inside].tobytes())
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "n_bytes": pa.array(np.diff(starts)), "removed": pa.array(removed, kind), "kept": pa.array(kept, pa.binary()) if not as_text else pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string())})

    return rows.join(found, "text_hash", "left").select("doc_id", "text", "hit", "spans").mapInArrow(
        run, f"doc_id {type_of(docs, 'doc_id')}, n_bytes long, removed array<struct<start:long,end:long>>, kept {'string' if as_text else 'binary'}"
    )


@query()
def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeats(given(spark, sf_dir, "documents"))
    lengths = F.transform("removed", lambda s: s["end"] - s["start"])
    return done.select(
        "doc_id", "n_bytes", F.aggregate(lengths, F.lit(0).cast("long"), lambda a, b: a + b).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
