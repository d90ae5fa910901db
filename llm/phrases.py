"""Phrase collocations: frequent n-grams by Misra-Gries summaries, counted exactly in a second pass."""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from llm.common import given, mix, query, slices, store, utf8
from llm.words import segment_hashes

SLICE = 1 << 20  # bytes of text that a task reads at a time
HELD = 1 << 20  # n-grams that a task gathers before it hands its summaries on
PARTS, PART_BYTES = 1024, 1 << 24  # hash partitions at least, and text per hash partition
SLACK = 2  # counters of a summary, as a multiple of mass / threshold
MERGED = 1 << 15  # counters that a merge takes in at least
CHUNKS, CHUNK_BITS = 256, 1 << 18  # of the table of survivors: 8 MB, whatever the input
KEPT = 42  # leading bits of a hash that summaries tell n-grams apart by; if two share them, both survive, and are counted exactly
PHRASES = 1 << 19  # phrases that a task counts before it hands them on
BUCKETS = 256  # groups of phrases at least, of which one is counted at a time
RANKED = 500_000  # phrases of one language that one task ranks
ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]
UNKNOWN = "und"


class Words:
    """The words of some texts, A-Z in lower case: hashes, where they lie, and the piece of text that each is in."""

    def __init__(self, data: np.ndarray, starts: np.ndarray) -> None:
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        cut, gap = np.zeros(256, bool), np.zeros(256, bool)
        cut[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
        gap[[0x20, 0x09]] = True
        self.data = lower[data]
        cuts = cut[data]
        inside = np.concatenate([[False], ~(gap | cut)[data], [False]])
        begins = np.zeros(len(data) + 1, bool)
        begins[starts] = True
        self.first = np.flatnonzero(inside[1:-1] & (~inside[:-2] | begins[:-1]))
        self.last = np.flatnonzero(inside[1:-1] & (~inside[2:] | begins[1:])) + 1
        self.text = np.searchsorted(starts, self.first, "right") - 1
        self.piece = np.cumsum(cuts | begins[:-1])[self.first]
        self.hash = segment_hashes(self.data, self.first, self.last)

    def starts(self, n: int) -> np.ndarray:
        """Which words open n words of one piece."""
        some = len(self.first) - n + 1
        return self.piece[:some] == self.piece[n - 1 :] if some > 0 else np.zeros(0, bool)

    def grams(self, n: int, langs: np.ndarray) -> np.ndarray:
        """A hash of the n words from each one on, of their text's language and of n."""
        some = max(0, len(self.first) - n + 1)
        value = langs[self.text[:some]] * ODD[-1] + np.uint64(n)
        for k in range(n):
            value += self.hash[k : k + some] * ODD[k]
        return mix(value)

    def phrase(self, at: int, n: int) -> bytes:
        """The n words from one on, with single spaces."""
        return b" ".join([self.data[a:b].tobytes() for a, b in zip(self.first[at : at + n].tolist(), self.last[at : at + n].tolist())])


def _probes(kept: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The chunk of the first ``KEPT`` bits of each hash in the table of survivors, and its two bits there."""
    width = np.uint64(CHUNK_BITS.bit_length() - 1)
    mask = np.uint64(CHUNK_BITS - 1)
    spread = mix(kept + np.uint64(1))
    return (spread >> np.uint64(56)).astype(np.int64), (spread & mask).astype(np.int64), (spread >> width & mask).astype(np.int64)


def _survives(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    chunk, one, two = _probes(hashes >> np.uint64(64 - KEPT))
    base = chunk * (CHUNK_BITS // 8)
    both = table[base + (one >> 3)] >> (one & 7).astype(np.uint8) & table[base + (two >> 3)] >> (two & 7).astype(np.uint8)
    return (both & 1).astype(bool)


def _marked(words: Words, n: int, langs: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
    """Which words open an n-gram of one piece whose two (n-1)-grams survived."""
    start = words.starts(n)
    if n > 1:
        shorter = _survives(tables[n - 2], words.grams(n - 1, langs))
        start = start & shorter[:-1] & shorter[1:]
    return start


def _summaries(batches: Iterator[pa.RecordBatch], n: int, bits: int, shared: list) -> Iterator[pa.RecordBatch]:
    """A task's summary of each hash partition, as binary keys (the bits behind the partition's) and counts, and its mass on a row of its own that sorts before."""
    tables, held, size = [s.value for s in shared], [], 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        keys, counts = (np.concatenate(x) for x in zip(*held))
        keys, of = np.unique(keys, return_inverse=True)
        return keys, np.bincount(of, counts, len(keys)).astype(np.int64)

    def hand_on(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        part = (keys >> np.uint64(64 - bits)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(part, prepend=-1))
        mass = np.add.reduceat(counts, cuts) if len(cuts) else counts
        rows = len(cuts)
        lengths = np.diff(np.append(cuts, len(part)))
        short = (keys >> np.uint64(64 - KEPT) & np.uint64((1 << KEPT - bits) - 1)).astype(_key_type(bits))
        blocks = []
        for values in (short, counts.astype(np.uint32)):  # a task has fewer n-grams than 2^32
            ends = np.concatenate([np.zeros(rows + 1, np.int64), np.cumsum(values.itemsize * lengths)]).astype(np.int32)
            blocks.append(pa.Array.from_buffers(pa.binary(), 2 * rows, [None, pa.py_buffer(ends), pa.py_buffer(values)]))
        return pa.record_batch({
            "part": pa.array(np.tile(part[cuts], 2)), "kind": pa.array(np.repeat(np.array([0, 1], np.int32), rows)),
            "mass": pa.array(np.tile(mass, 2)), "keys": blocks[0], "counts": blocks[1],
        })

    for batch in slices(batches, SLICE):
        words, langs = Words(*utf8(batch.column("text"))), batch.column("lang_hash").to_numpy().view(np.uint64)
        some = _marked(words, n, langs, tables)
        if some.any():
            held.append(np.unique(words.grams(n, langs)[some], return_counts=True))
            size += len(held[-1][0])
        if size > HELD:
            held = [merged()]
            size = len(held[0][0])
            if size > HELD // 2:
                yield hand_on(*held[0])
                held, size = [], 0
    if held:
        yield hand_on(*merged())


def _key_type(bits: int) -> type:
    return np.uint32 if KEPT - bits <= 32 else np.uint64


class Summary:
    """A Misra-Gries summary: at most ``capacity`` counters, each short of the true count by ``error`` at most."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.error = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.held: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Take in another summary; some are merged together."""
        self.held.append((keys, counts))
        if sum(len(k) for k, _ in self.held) > max(MERGED, self.capacity):
            self.merge()

    def merge(self) -> None:
        keys, counts = (np.concatenate(x) for x in zip((self.keys, self.counts), *self.held))
        self.held = []
        self.keys, of = np.unique(keys, return_inverse=True)
        self.counts = np.bincount(of, counts, len(self.keys)).astype(np.int64)
        if len(self.keys) > self.capacity:
            # What the first counter beyond the capacity has goes from all: more than ``capacity`` times that from the whole mass.
            less = int(np.partition(self.counts, len(self.counts) - self.capacity - 1)[len(self.counts) - self.capacity - 1])
            self.error += less
            left = self.counts > less
            self.keys, self.counts = self.keys[left], self.counts[left] - less

    def survivors(self, threshold: int) -> np.ndarray:
        """The keys that may have ``threshold`` occurrences; all that do are among them if mass / capacity is below it."""
        if self.held:
            self.merge()
        return self.keys[self.counts + self.error >= threshold]


def _merged(batches: Iterator[pa.RecordBatch], threshold: int, bits: int) -> Iterator[pa.RecordBatch]:
    """The survivors of each hash partition, whose rows come in a row, masses first, and the chunk of each in the table of survivors."""
    part, mass, summary = None, 0, None
    kinds = _key_type(bits), np.uint32

    def out() -> pa.RecordBatch:
        kept = np.uint64(part << KEPT - bits) + summary.survivors(threshold).astype(np.uint64)
        return pa.record_batch({"chunk": pa.array(_probes(kept)[0]), "kept": pa.array(kept.view(np.int64))})

    for batch in batches:
        blocks = [batch.column(c) for c in ("keys", "counts")]
        for i, (own, kind, weight) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("part", "kind", "mass")])):
            if own != part:
                if summary:
                    yield out()
                part, mass, summary = own, 0, None
            if not kind:
                mass += weight
                continue
            summary = summary or Summary(SLACK * mass // threshold + 1)
            summary.add(*[np.frombuffer(block[i].as_buffer(), of) for block, of in zip(blocks, kinds)])
    if summary:
        yield out()


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The chunks of the table of survivors that the task's hashes lie in."""
    chunks: dict[int, np.ndarray] = {}
    for batch in batches:
        chunk, one, two = _probes(batch.column("kept").to_numpy().view(np.uint64))
        for c in np.unique(chunk).tolist():
            table = chunks.setdefault(c, np.zeros(CHUNK_BITS, bool))
            table[one[chunk == c]] = True
            table[two[chunk == c]] = True
    packed = [np.packbits(t, bitorder="little").tobytes() for t in chunks.values()]
    yield pa.record_batch({"chunk": pa.array(list(chunks), pa.int32()), "bits": pa.array(packed, pa.binary())})


def survivors(rows: DataFrame, n: int, threshold: int, bits: int, shared: list) -> np.ndarray:
    """The table of n-grams that survive their hash partition's summary: a blocked Bloom filter of fixed size."""
    made = rows.select("text", "lang_hash").mapInArrow(
        lambda b: _summaries(b, n, bits, shared), "part long, kind int, mass long, keys binary, counts binary"
    )
    found = made.repartition("part").sortWithinPartitions("part", "kind").mapInArrow(lambda b: _merged(b, threshold, bits), "chunk long, kept long")
    chunks = found.repartition("chunk").mapInArrow(_bits, "chunk int, bits binary").collect()
    table = np.zeros(CHUNKS * CHUNK_BITS // 8, np.uint8)
    for row in chunks:
        at = row["chunk"] * (CHUNK_BITS // 8)
        table[at : at + CHUNK_BITS // 8] |= np.frombuffer(row["bits"], np.uint8)
    return table


class Tally:
    """Counts of phrases by hash, with the text of each kept once."""

    def __init__(self) -> None:
        self.keys, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # sorted by key; a slot is a phrase's place below
        self.phrases: list[bytes] = []
        self.langs: list[int] = []
        self.counts = np.zeros(0, np.int64)

    def add(self, keys: np.ndarray, counts: np.ndarray, phrase: Callable[[int], tuple[int, bytes]]) -> None:
        """Counts of distinct keys in order; ``phrase`` gives the language's number and the text of one by its place among them."""
        place = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == keys[inside]
        new = np.flatnonzero(~known)
        slots = len(self.phrases) + np.arange(len(new))
        for i in new.tolist():
            lang, text = phrase(i)
            self.phrases.append(text)
            self.langs.append(lang)
        if len(self.phrases) > len(self.counts):
            self.counts = np.concatenate([self.counts, np.zeros(max(len(self.phrases), 1 << 14), np.int64)])
        self.counts[self.slots[place[known]]] += counts[known]
        self.counts[slots] = counts[new]
        self.keys, self.slots = np.insert(self.keys, place[new], keys[new]), np.insert(self.slots, place[new], slots)


def _counted(batches: Iterator[pa.RecordBatch], longest: int, shared: list, buckets: int) -> Iterator[pa.RecordBatch]:
    """Phrases that may be frequent with how often the task has them, in blocks of one bucket and language, and the words of each language."""
    tables = [s.value for s in shared]
    squeeze = zstandard.ZstdCompressor()
    tally, names, words_of = Tally(), {}, []

    def hand_on() -> pa.RecordBatch:
        lang_of, total = np.array(tally.langs, np.int64), len(tally.phrases)
        bucket = np.empty(total, np.int64)
        bucket[tally.slots] = (tally.keys >> np.uint64(32)).astype(np.int64) % buckets
        order = sorted(range(total), key=tally.phrases.__getitem__)  # equal beginnings together, as they take less room
        order = np.array(order, np.int64)
        order = order[np.lexsort((lang_of[order], bucket[order]))]
        cuts = np.flatnonzero((np.diff(bucket[order], prepend=-1) != 0) | (np.diff(lang_of[order], prepend=-1) != 0))
        rows = [
            (int(bucket[some[0]]), int(lang_of[some[0]]), squeeze.compress(b"\n".join([tally.phrases[i] for i in some.tolist()])), tally.counts[some].tobytes())
            for some in np.split(order, cuts[1:]) if len(some)
        ]
        every = list(names)
        return pa.record_batch({
            "bucket": pa.array([*[r[0] for r in rows], *[None] * len(every)], pa.int64()), "lang": pa.array([*[every[r[1]] for r in rows], *every], pa.string()),
            "phrases": pa.array([*[r[2] for r in rows], *[None] * len(every)], pa.binary()), "counts": pa.array([*[r[3] for r in rows], *[None] * len(every)], pa.binary()),
            "words": pa.array([*[None] * len(rows), *words_of], pa.int64()),
        })

    for batch in slices(batches, SLICE):
        words, langs = Words(*utf8(batch.column("text"))), batch.column("lang_hash").to_numpy().view(np.uint64)
        number = np.array([names.setdefault(x, len(names)) for x in batch.column("lang").to_pylist()], np.int64)
        words_of += [0] * (len(names) - len(words_of))
        for i, some in enumerate(np.bincount(number[words.text], minlength=len(names)).tolist()):
            words_of[i] += some
        for n in range(1, longest + 1):
            hashes = words.grams(n, langs)
            at = np.flatnonzero(_marked(words, n, langs, tables))
            at = at[_survives(tables[n - 1], hashes[at])]
            keys, first, counts = np.unique(hashes[at], return_index=True, return_counts=True)
            tally.add(keys, counts, lambda i: (int(number[words.text[at[first[i]]]]), words.phrase(int(at[first[i]]), n)))  # noqa: B023
        if len(tally.phrases) > PHRASES or len(names) > PHRASES:
            yield hand_on()
            tally, names, words_of = Tally(), {}, []
    yield hand_on()


def _added(batches: Iterator[pa.RecordBatch], threshold: int) -> Iterator[pa.RecordBatch]:
    """The frequent phrases of each bucket and language, whose blocks come in a row."""
    expand = zstandard.ZstdDecompressor()
    at, held = None, []

    def out() -> pa.RecordBatch:
        summed = pa.concat_tables(held).group_by("phrase").aggregate([("n", "sum")])
        summed = summed.filter(pc.greater_equal(summed["n_sum"], threshold)).combine_chunks()
        phrase = summed["phrase"].cast(pa.string()).combine_chunks()
        size = pc.add(pc.count_substring(phrase, " "), 1).cast(pa.int32())
        return pa.record_batch({"lang": pa.repeat(pa.scalar(at[1], pa.string()), len(phrase)), "phrase": phrase, "size": size, "f": summed["n_sum"].combine_chunks()})

    for batch in batches:
        for bucket, lang, phrases, counts in zip(*[batch.column(c).to_pylist() for c in ("bucket", "lang", "phrases", "counts")]):
            if (bucket, lang) != at:
                if held:
                    yield out()
                at, held = (bucket, lang), []
            texts = pa.array(expand.decompress(phrases).split(b"\n"), pa.binary())
            held.append(pa.table({"phrase": texts, "n": pa.array(np.frombuffer(counts, np.int64))}))
    if held:
        yield out()


def frequent_phrases(docs: DataFrame, threshold: int = 30, longest: int = 4) -> DataFrame:
    """``lang``, ``phrase``, ``size`` (in words) and ``f``: every phrase of up to ``longest`` words that occurs ``threshold`` times
    in a language, counted exactly, and on a row of size 0 how many words the language has.

    Texts have A-Z in lower case and are split at ``.,;:!?`` and line ends (0x0A to 0x0D) into pieces, these at spaces and tabs
    into words; a phrase lies within a piece, its words are joined by single spaces. A null text is empty, a null ``lang`` is ``und``;
    other columns are ignored. Repeated rows count again. A language without a word has no row.

    First pass, for each length in turn: tasks summarise the n-grams of every hash partition, summaries are merged
    per partition as Misra-Gries summaries whose capacity exceeds the partition's mass / ``threshold``, and so every
    frequent n-gram survives. (A task's own share of a partition is below that capacity, so its summary is complete.) An n-gram goes
    in only if the two shorter ones in it survived. Survivors make a Bloom filter of fixed size that is broadcast; its false
    positives cost time only. Second pass: all that pass it are counted exactly. Tasks hand on their counts in blocks of a bucket (by the phrase's hash)
    and a language, whose texts are sorted and compressed; buckets grow in number with the text, and one is added up at a time. No n-gram is hot, as
    a task has it once. N-grams are told apart by 64-bit hashes within a task, by their text beyond.
    """
    if not 1 <= longest <= 4 or threshold < 1:
        raise ValueError(f"phrases of 1 to 4 words at a threshold from 1 on are found, not {longest} and {threshold}")
    lang = F.coalesce("lang", F.lit(UNKNOWN))
    rows = docs.select(F.coalesce("text", F.lit("")).alias("text"), lang.alias("lang"), F.xxhash64(lang).alias("lang_hash"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    bits = (max(PARTS, size // PART_BYTES) - 1).bit_length()
    context, shared = docs.sparkSession.sparkContext, []
    for n in range(1, longest + 1):
        shared.append(context.broadcast(survivors(rows, n, threshold, bits, shared[-1:] and shared)))
    buckets = max(BUCKETS, size // PART_BYTES)
    counted, _ = store(rows.mapInArrow(
        lambda b: _counted(b, longest, shared, buckets), "bucket long, lang string, phrases binary, counts binary, words long"
    ))
    blocks = counted.filter("bucket is not null").select("bucket", "lang", "phrases", "counts")
    blocks = blocks.repartition("bucket", "lang").sortWithinPartitions("bucket", "lang")
    found = blocks.mapInArrow(lambda b: _added(b, threshold), "lang string, phrase string, size int, f long")
    words = counted.filter("words is not null").groupBy("lang").agg(F.sum("words").alias("f")).filter("f > 0")
    return found.unionByName(words.select("lang", F.lit("").alias("phrase"), F.lit(0).alias("size"), "f"))


def _part(first: int, last: int) -> F.Column:
    """Words ``first`` to ``last`` of a phrase, counted from 1."""
    return F.array_join(F.slice("words", first, last - first + 1), " ")


def collocations(docs: DataFrame, threshold: int = 30, longest: int = 4, top: int = 2000, covered: int = 80) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score``: the ``top`` phrases of 2 to ``longest`` words of every language.

    ``a`` is how often the phrase occurs (``threshold`` times at least, see ``frequent_phrases``), ``n`` how many words the language has.
    Cut after its first k words, its parts occur ``l`` and ``r`` times, and ``floor(2000000 * a / (l + r))`` is the cut's
    score; the cut with the lowest counts, the first of several. Left out are phrases within a longer one that occurs ``covered``
    percent as often or more, whether that is left out itself or not. Ranks are by score, then a, both descending, then phrase by its
    bytes. Products are computed in decimals of 38 digits.
    """
    counts, _ = store(frequent_phrases(docs, threshold, longest))
    known = counts.filter("size > 0").select("lang", "phrase", "size", "f")
    phrases = known.filter("size > 1").withColumn("words", F.split("phrase", " "))
    # A phrase's parts occur at least as often as itself, so they are known.
    cuts = F.array(*[F.when(F.col("size") > k, F.struct(F.lit(k).alias("k"), _part(1, k).alias("left"), F.expr(f"array_join(slice(words, {k + 1}, size - {k}), ' ')").alias("right"))) for k in range(1, longest)])
    cut = phrases.select("lang", "phrase", F.col("f").alias("a"), F.inline(F.array_compact(cuts)))
    for name, column in (("left", "l"), ("right", "r")):
        cut = cut.join(known.select("lang", F.col("phrase").alias(name), F.col("f").alias(column)), ["lang", name])
    score = F.expr("(cast(a as decimal(20,0)) * 2000000bd) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    scored = cut.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = [F.when(F.col("size") >= first + n - 1 + (first == 1), _part(first, first + n - 1)) for n in range(2, longest) for first in range(1, longest - n + 2)]
    within = phrases.filter("size > 2").select("lang", "f", F.explode(F.array_compact(F.array(*inner))).alias("phrase"))
    within = within.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    best = scored.join(within, ["lang", "phrase"], "left").filter(F.expr(f"longer is null or 100 * longer < {covered} * a"))
    best, _ = store(best.select("lang", "phrase", "a", "cut.*"))

    order = [F.desc("score"), F.desc("a"), "phrase"]
    groups = -(-best.count() // RANKED)
    while groups > 1:  # a language's phrases in groups first, of which none is large
        within = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(groups))).orderBy(*order)
        best = best.withColumn("rank", F.row_number().over(within)).filter(F.col("rank") <= top)
        groups = min(groups - 1, -(-groups * top // RANKED))
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    totals = counts.filter("size = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@query("""
    with pieces as (
        select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) as piece
        from documents
    ), worded as (
        select lang, list_filter(regexp_split_to_array(piece, '[ \\x09]+'), lambda w: w <> '') as w from pieces
    ), totals as (
        select lang, cast(sum(len(w)) as bigint) as n from worded group by lang
    ), grams as (
        select lang, k, array_to_string(w[i : i + k - 1], ' ') as phrase
        from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from worded, (values (1), (2), (3), (4)) sizes(k))
    ), counts as (
        select lang, phrase, k, count(*) as f from grams group by lang, phrase, k having count(*) >= 30
    ), candidates as (
        select lang, phrase, f as a, string_split(phrase, ' ') as w, k as size from counts where k > 1
    ), cuts as (
        select lang, phrase, a, k, array_to_string(w[:k], ' ') as head, array_to_string(w[k + 1 :], ' ') as tail
        from candidates, (values (1), (2), (3)) sizes(k) where k < size
    ), scored as (
        select c.lang, c.phrase, a, c.k, h.f as l, t.f as r, cast((2000000::hugeint * a) // (h.f + t.f) as bigint) as score
        from cuts c join counts h on h.lang = c.lang and h.phrase = head join counts t on t.lang = c.lang and t.phrase = tail
    ), lowest as (
        select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1
    ), inner_phrases as (
        select lang, array_to_string(w[i : i + k - 1], ' ') as phrase, max(a) as longer
        from (select lang, w, a, k, unnest(range(1, size - k + 2)) as i from candidates, (values (2), (3)) sizes(k) where k < size) group by all
    )
    select s.lang, row_number() over (partition by s.lang order by score desc, a desc, s.phrase) as rank, s.phrase, a, l, r, n, score
    from lowest s join totals on totals.lang = s.lang left join inner_phrases i on i.lang = s.lang and i.phrase = s.phrase
    where longer is null or 100 * longer < 80 * a
    qualify rank <= 2000
""")
def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(given(spark, sf_dir, "documents"))
