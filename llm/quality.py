"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from llm.common import checkpoint, codepoints, given, query, slices, tasks_for
from llm.ngrams import Sorted, Tally, count, hashes, rolling

ORDER = 5  # characters
PAD = "\x02"  # stands before a text
SLICE = 1 << 20  # bytes of text that a task counts or scores at a time
BROADCAST_ROWS = 2_000_000  # trusted ids that are broadcast; more are joined by shuffle
SMOOTH = 50  # characters at the language's median that are added to a text, so that a short one is not judged by its first letters
HOT = 1 << 18  # n-grams that every task looks up by itself; the others are joined


def _points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the padded texts, their n + 1 starts, and the places of their own characters."""
    points, starts = codepoints([PAD * (ORDER - 1) + (t or "").replace("\0", "�") for t in texts])
    places = np.arange(len(points)) - np.repeat(starts[:-1], np.diff(starts))
    return points, starts, np.flatnonzero(places >= ORDER - 1)


def corpus_grams(docs: DataFrame) -> DataFrame:
    """``gram``, ``n`` (times in all texts) and ``trained`` (times in those whose ``train`` is true), summed in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies = {True: Tally(), False: Tally()}

        def hand_on(train: bool) -> Iterator[pa.RecordBatch]:
            for grams, n in tallies[train].take():
                yield pa.record_batch({"gram": pa.array(grams.tolist(), pa.string()), "n": pa.array(n), "trained": pa.array(n * train)})

        for batch in slices(batches, SLICE):
            train = np.array(batch.column("train").to_pylist(), bool)
            texts = np.array(batch.column("text").to_pylist(), object)
            for which, tally in tallies.items():
                points, _, ends = _points(list(texts[train == which]))
                if len(ends):
                    tally.add(*count(points, ends, ORDER))
                if tally.full:
                    yield from hand_on(which)
        for which in tallies:
            yield from hand_on(which)

    counted = docs.select("text", "train").mapInArrow(run, "gram string, n long, trained long")
    return counted.groupBy("gram").agg(F.sum("n").alias("n"), F.sum("trained").alias("trained"))


def gram_probabilities(grams: DataFrame) -> DataFrame:
    """``gram``, ``n`` and ``logp``: of every n-gram of the corpus, the model's log-probability of its last character.

    The longest n-grams have their counts in the trained text, shorter ones the number of different characters
    that precede them. Each order takes three discounts from its counts (for 1, 2 and 3 or more), computed from
    how many n-grams occur 1 to 4 times, and hands what it takes to the next lower order, the lowest
    to a uniform one. Counts, contexts and lower orders stay in tables that are dealt by hash of
    the n-gram and joined; only the counts of counts and the totals of order 1 reach the driver.
    """
    tasks = tasks_for(grams)
    grams = grams.coalesce(tasks)
    types = grams.filter(F.col("trained") > 0).select("gram", F.col("trained").alias("c"))
    every = types
    for _ in range(ORDER - 1):
        types = types.groupBy(F.expr("substring(gram, 2)").alias("gram")).agg(F.count(F.lit(1)).alias("c")).coalesce(tasks)
        every = every.unionByName(types)
    every = checkpoint(every.withColumn("k", F.char_length("gram")))
    few = {(r["k"], r["c"]): r["count"] for r in every.filter(F.col("c") <= 4).groupBy("k", "c").count().collect()}

    def discount(k: int) -> Column:
        n = [few.get((k, c), 0) for c in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
        d = [min(c, max(0.1, c - (c + 1) * y * n[c] / n[c - 1])) if n[c - 1] else 0.5 for c in (1, 2, 3)]
        return F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])

    wanted = {ORDER: grams.select("gram")}
    for k in range(ORDER - 1, 0, -1):
        wanted[k] = wanted[k + 1].select(F.expr("substring(gram, 2)").alias("gram")).distinct().coalesce(tasks)
    first = every.filter("k = 1").withColumn("d", discount(1)).agg(F.sum("c"), F.sum("d"), F.count(F.lit(1))).first()
    total, taken, kinds = first[0] or 1, first[1] or 1.0, first[2]
    below = None
    for k in range(1, ORDER + 1):
        known = every.filter(F.col("k") == k).select("gram", "c", discount(k).alias("d"))
        rows = wanted[k].join(known, "gram", "left")
        own = F.coalesce(F.col("c") - F.col("d"), F.lit(0.0))
        if k == 1:
            below = rows.select("gram", (own / total + taken / total / (kinds + 1)).alias("p"))
            continue
        head = F.expr(f"substring(gram, 1, {k - 1})")
        contexts = known.groupBy(head.alias("head")).agg(F.sum("c").alias("total"), (F.sum("d") / F.sum("c")).alias("back"))
        rows = rows.withColumn("head", head).withColumn("tail", F.expr("substring(gram, 2)")).join(contexts, "head", "left")
        rows = rows.join(below.select(F.col("gram").alias("tail"), F.col("p").alias("lower")), "tail")
        p = F.coalesce(own / F.col("total"), F.lit(0.0)) + F.coalesce("back", F.lit(1.0)) * F.col("lower")
        below = rows.select("gram", p.alias("p")).coalesce(tasks)
    return below.join(grams.select("gram", "n"), "gram").select("gram", "n", F.log("p").alias("logp")).coalesce(tasks)


def perplexities(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """``doc_id``, ``lang``, ``text_hash``, ``held``, ``length`` and ``entropy`` of every row of ``docs``.

    ``trusted`` has the ``doc_id`` of trusted documents; the model learns from all of them but for one in ten (by a hash
    of the id), which are ``held`` for calibration. ``entropy`` is the cross-entropy in nats per character (its exponential is
    the perplexity), null for a null or empty text. Every character of every text counts.

    The n-grams of all texts are counted once and their probabilities computed once each. The 262,144 most frequent ones, a
    bounded table, are broadcast; occurrences of the others leave their task as (row, n-gram, times) and are joined by n-gram.
    """
    return _entropies(_marked(docs, trusted))


def _marked(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """``doc_id``, ``lang``, ``text``, ``text_hash``, ``train`` and ``held`` of every row of ``docs``."""
    ids = trusted.filter(F.col("doc_id").isNotNull()).select("doc_id", F.lit(True).alias("trust")).distinct()
    marked = docs.select("doc_id", "lang", "text", F.xxhash64("text").alias("text_hash"))
    marked = marked.join(F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids, "doc_id", "left")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(10)) == 0
    trust = F.coalesce("trust", F.lit(False))
    return marked.withColumn("train", trust & ~held).withColumn("held", trust & held).drop("trust")


def _entropies(marked: DataFrame, only_held: bool = False) -> DataFrame:
    """What ``perplexities`` returns, of all rows or of those that are held."""
    known = checkpoint(gram_probabilities(checkpoint(corpus_grams(marked))))
    marked = marked.filter("held") if only_held else marked
    hot = known.orderBy(F.desc("n"), "gram").limit(HOT).select("gram", "logp").toArrow()
    names = np.array(hot.column("gram").to_pylist(), f"<U{ORDER}")
    keys, logs = hashes(names), hot.column("logp").to_numpy()
    order = np.argsort(keys)
    table = marked.sparkSession.sparkContext.broadcast((keys[order], logs[order].astype(np.float64)))
    found = checkpoint(marked.withColumn("row", F.monotonically_increasing_id()).drop("train").mapInArrow(
        lambda batches: _score(batches, table),
        "row long, doc_id long, lang string, text_hash long, held boolean, length long, logs double, gram string, n long",
    ))
    cold = found.filter(F.col("gram").isNotNull()).select("row", "gram", F.col("n").alias("times"))
    rest = cold.join(known, "gram").groupBy("row").agg(F.sum(F.col("times") * F.col("logp")).alias("rest"))
    whole = found.filter(F.col("gram").isNull()).join(rest, "row", "left")
    total = F.col("logs") + F.coalesce("rest", F.lit(0.0))
    return whole.select("doc_id", "lang", "text_hash", "held", "length", F.when(F.col("length") > 0, -total / F.col("length")).alias("entropy"))


def _score(batches: Iterator[pa.RecordBatch], table) -> Iterator[pa.RecordBatch]:
    keys, logs = table.value
    hot = Sorted(keys)
    carried = ["row", "doc_id", "lang", "text_hash", "held"]
    for batch in slices(batches, SLICE):
        points, starts, ends = _points(batch.column("text").to_pylist())
        of = np.searchsorted(starts, ends, "right") - 1
        hashed = rolling(points, ORDER)[ends - ORDER + 1]
        at = hot.find(hashed)
        n = len(batch)
        sums = np.bincount(of[at >= 0], logs[at[at >= 0]], n)
        empty = pa.nulls(n, pa.string()), pa.nulls(n, pa.int64())
        yield pa.record_batch([*[batch.column(c) for c in carried], pa.array(np.bincount(of, minlength=n)), pa.array(sums), *empty],
                              names=[*carried, "length", "logs", "gram", "n"])
        if len(missed := np.flatnonzero(at < 0)):
            missed = missed[np.lexsort((hashed[missed], of[missed]))]
            new = np.ones(len(missed), bool)
            new[1:] = (np.diff(hashed[missed]) != 0) | (np.diff(of[missed]) != 0)
            first = np.flatnonzero(new)
            times = np.diff(np.append(first, len(missed)))
            windows = np.lib.stride_tricks.sliding_window_view(points, ORDER)[ends[missed[first]] - ORDER + 1]
            grams = np.ascontiguousarray(windows).view(f"<U{ORDER}").ravel()
            m = len(first)
            yield pa.record_batch({
                "row": batch.column("row").take(pa.array(of[missed[first]])), "doc_id": pa.nulls(m, pa.int64()), "lang": pa.nulls(m, pa.string()),
                "text_hash": pa.nulls(m, pa.int64()), "held": pa.nulls(m, pa.bool_()), "length": pa.nulls(m, pa.int64()),
                "logs": pa.nulls(m, pa.float64()), "gram": pa.array(grams.tolist(), pa.string()), "n": pa.array(times),
            })


def classify(docs: DataFrame, trusted: DataFrame, quantile: float = 0.999, slack: float = 0.05, support: int = 30) -> DataFrame:
    """``doc_id``, ``lang``, ``text_hash``, ``perplexity`` (per character), ``limit`` and ``kept`` of every row of ``docs``.

    ``docs`` has ``doc_id``, ``text`` and ``lang``, ``trusted`` has ``doc_id``; other columns are ignored. A document is
    kept when its cross-entropy, smoothed by ``SMOOTH`` characters at the median of its language, is at most
    the ``quantile`` of that language's trusted documents which the model has not seen, and ``slack`` times it more
    (few of them may be at hand, and clean text should stay). A null language counts as one
    of its own. Where one in ten are fewer than ``support`` documents, all trusted ones of the language are used, either half judged by a
    model of the other half and the rest. A language with fewer than ``support`` even so has no limit: as with
    no trusted documents at all nothing can be told, and every text that is not empty is kept. A null or empty text has no perplexity
    and is not kept. Repeated rows come out again, as does a null id.
    """
    marked = _marked(docs, trusted)
    scored = checkpoint(_entropies(marked))
    held = scored.filter("held and entropy is not null")
    lang = F.coalesce("lang", F.lit(""))
    own = marked.filter("(train or held) and text <> ''").groupBy(lang.alias("lang"))
    counts = own.agg(F.countDistinct("doc_id").alias("every"), F.countDistinct(F.when(F.col("held"), F.col("doc_id"))).alias("held"))
    marks = {row["lang"]: row for row in counts.collect()}
    crossed = [name for name, row in marks.items() if row["held"] < support <= row["every"]]
    if crossed:
        trust, few = F.col("train") | F.col("held"), lang.isin(crossed)
        parts = [_entropies(_halved(marked.filter(trust), few, half), True) for half in (0, 1)]
        held = checkpoint(held.filter(~few).unionByName(parts[0].unionByName(parts[1]).filter("entropy is not null")))
    held = held.filter(lang.isin([name for name, row in marks.items() if row["every"] >= support]))
    held = held.withColumn("lang", lang)
    median = F.percentile_approx("entropy", 0.5, 10_000).alias("median")
    medians = {row["lang"]: row["median"] for row in held.groupBy("lang").agg(median).collect()}

    def by_lang(values: dict[str, float]) -> Column:
        pairs = F.create_map(*[F.lit(x) for pair in ({"": None} | values).items() for x in pair]).cast("map<string,double>")
        return F.try_element_at(pairs, lang)

    smooth = (F.col("entropy") * F.col("length") + SMOOTH * by_lang(medians)) / (F.col("length") + SMOOTH)
    limit = (F.percentile_approx("smooth", quantile, 10_000) * (1 + slack)).alias("limit")
    limits = {row["lang"]: row["limit"] for row in held.withColumn("smooth", smooth).groupBy("lang").agg(limit).collect()}
    scored = scored.withColumn("smooth", smooth).withColumn("limit", by_lang(limits))
    kept = F.col("entropy").isNotNull() & F.coalesce(F.col("smooth") <= F.col("limit"), F.lit(True))
    return scored.select("doc_id", "lang", "text_hash", F.exp("entropy").alias("perplexity"), F.exp("limit").alias("limit"), kept.alias("kept"))


def _halved(trusted: DataFrame, few: Column, half: int) -> DataFrame:
    """Trusted documents, of which those of few languages in one half (by a hash of the id) are held and all others train."""
    held = few & (F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)) == half)
    return trusted.withColumn("held", held).withColumn("train", ~held)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Documents whose every label says good quality."""
    return labels.filter("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("q")).filter("q > 0").select("doc_id")


@query()
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(given(spark, sf_dir, "documents"), trusted_ids(given(spark, sf_dir, "labels"))).drop("text_hash")
