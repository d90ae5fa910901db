"""Language identification by character language models."""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from llm.common import checkpoint, codepoints, given, query, slices, tasks_for
from llm.ngrams import Sorted, Tally, count, hashes, rolling

ORDER = 4
UNKNOWN = "und"
PAD = "\x02"  # stands before a text, whose first n-grams are shorter
SLICE = 1 << 20  # bytes of text that a task scores at a time
HOT = 1 << 18  # n-grams that every task looks up by itself; the others are joined
CELLS = 1 << 22  # bound of those n-grams times the languages


def normalise(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters, all else as single spaces, each text opened by one; code points and the n + 1 starts."""
    points, starts = codepoints([" " + (t or "").lower() + " " for t in texts])
    points = _LETTERS()[points]
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != 32) | (points[:-1] != 32)
    keep[starts[:-1]] = True
    return points[keep], np.concatenate([[0], np.cumsum(keep)])[starts]


def _LETTERS(cache: list[np.ndarray] = []) -> np.ndarray:  # noqa: B006  (one table per worker)
    if not cache:
        from llm.words import LETTER, classes

        cache.append(np.where(classes() == LETTER, np.arange(0x110000), 32).astype(np.uint32))
    return cache[0]


def gram_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``gram`` and ``n`` over all texts whose language is known, added up in each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies: dict[str, Tally] = {}

        def hand_on(lang: str) -> Iterator[pa.RecordBatch]:
            for grams, counts in tallies[lang].take():
                yield pa.record_batch({"lang": pa.repeat(lang, len(grams)), "gram": pa.array(grams.tolist(), pa.string()), "n": pa.array(counts)})

        for batch in slices(batches, SLICE):
            langs = np.array(batch.column("lang").to_pylist(), object)
            texts = np.array(batch.column("text").to_pylist(), object)
            for lang in sorted(set(langs)):
                points, starts = normalise(list(texts[langs == lang]))
                places = np.arange(len(points)) - np.repeat(starts[:-1], np.diff(starts))
                ends = np.flatnonzero(places >= ORDER - 1)
                tally = tallies.setdefault(lang, Tally())
                if len(ends):
                    tally.add(*count(points, ends, ORDER))
                if tally.full:
                    yield from hand_on(lang)
        for lang in tallies:
            yield from hand_on(lang)

    known = docs.select("lang", "text").filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    return known.mapInArrow(run, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Learned:
    """A model as tables: ``grams`` (``gram``, ``own``: per language that has it its share of the context, less the discount) and
    ``contexts`` (``head``, ``back``: per language that has it the weight of the next lower order), of all orders."""

    languages: list[str]
    grams: DataFrame | None = None
    contexts: DataFrame | None = None
    kinds: int = 0  # different characters
    scale: float = 1.0
    limits: dict[str, float] | None = None


def learn(docs: DataFrame, calibrate: int = 20, quantile: float = 0.999) -> Learned:
    """Learn a model from every row with a text and a ``lang``.

    All rows are counted, but for one in ``calibrate`` (by a hash of its text), on which the model is
    calibrated, and all n-grams of all languages are in the model. Calibration finds the
    scale that makes the softmax of the cross-entropies most likely, and per language the
    cross-entropy that only ``1 - quantile`` of its own texts exceed: beyond it, a prediction is marked as rejected.
    """
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    held = F.pmod(F.xxhash64("text"), F.lit(calibrate)) == 0
    model = tables(checkpoint(gram_counts(known.filter(~held))))
    if not model.languages:
        return model
    scored = _entropies(known.filter(held & F.col("lang").isin(model.languages)), model, ["lang"])
    own = F.element_at("entropies", F.array_position(F.array(*map(F.lit, model.languages)), F.col("lang")).cast("int"))
    scales = [1.0, 3.0, 10.0, 30.0, 100.0]
    odds = lambda s: F.log(F.aggregate(F.transform("entropies", lambda x: F.exp((F.col("own") - x) * s)), F.lit(0.0), lambda a, b: a + b))
    own_scored = scored.filter(F.col("entropies").isNotNull()).withColumn("own", own)
    loss = own_scored.agg(*[F.avg(odds(s)).alias(f"s{i}") for i, s in enumerate(scales)]).first()
    if loss[0] is not None:
        model.scale = min(zip(loss, scales))[1]
    limits = own_scored.groupBy("lang").agg(F.percentile_approx("own", quantile, 10_000).alias("limit")).collect()
    model.limits = {row["lang"]: row["limit"] for row in limits}
    return model


def tables(counted: DataFrame) -> Learned:
    """What ``fit`` computes, from ``lang``, ``gram`` and ``n`` of all longest n-grams, by grouping and joins.

    Continuation counts, counts of counts, contexts and shares stay in tables; only the names of the languages reach the driver.
    """
    languages = sorted(row["lang"] for row in counted.select("lang").distinct().collect())
    if not languages:
        return Learned([])
    tasks = tasks_for(counted)
    numbers = counted.sparkSession.createDataFrame(list(enumerate(languages)), "of int, lang string")
    types = counted.coalesce(tasks).join(F.broadcast(numbers), "lang").select("of", "gram", F.col("n").alias("c"))
    every = types
    for _ in range(ORDER - 1):
        types = types.groupBy("of", F.expr("substring(gram, 2)").alias("gram")).agg(F.count(F.lit(1)).alias("c")).coalesce(tasks)
        every = every.unionByName(types)
    every = checkpoint(every.withColumn("k", F.char_length("gram")))
    ones, twos = F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2)
    discounts = every.groupBy("of", "k").agg(F.when(ones > 0, ones / (ones + 2 * twos)).otherwise(0.5).alias("discount"))
    rows = every.join(F.broadcast(discounts), ["of", "k"]).select(
        "of", "gram", F.expr("substring(gram, 1, k - 1)").alias("head"), "c", F.least(F.col("c").cast("double"), "discount").alias("taken")
    )
    contexts = checkpoint(rows.groupBy("head", "of").agg(F.sum("c").alias("total"), (F.sum("taken") / F.sum("c")).alias("v")).coalesce(tasks))
    shares = rows.join(contexts.select("head", "of", "total"), ["head", "of"]).withColumn("v", (F.col("c") - F.col("taken")) / F.col("total"))
    grams = checkpoint(shares.groupBy("gram").agg(F.collect_list(F.struct("of", "v")).alias("own")).coalesce(tasks))
    backs = checkpoint(contexts.groupBy("head").agg(F.collect_list(F.struct("of", "v")).alias("back")).coalesce(tasks))
    return Learned(languages, grams, backs, grams.filter(F.char_length("gram") == 1).count())


def _padded(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the normalised and padded texts, their n + 1 starts, and the places to score: all after the opening space."""
    points, starts = normalise(texts)
    points = np.insert(points, np.repeat(starts[:-1], ORDER - 2), ord(PAD))
    starts = starts + (ORDER - 2) * np.arange(len(starts))
    places = np.arange(len(points)) - np.repeat(starts[:-1], np.diff(starts))
    return points, starts, np.flatnonzero(places >= ORDER - 1)


def corpus_grams(docs: DataFrame) -> DataFrame:
    """``gram`` and ``n`` of all padded texts, summed in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()

        def hand_on() -> Iterator[pa.RecordBatch]:
            for grams, n in tally.take():
                yield pa.record_batch({"gram": pa.array(grams.tolist(), pa.string()), "n": pa.array(n)})

        for batch in slices(batches, SLICE):
            points, _, ends = _padded(batch.column("text").to_pylist())
            if len(ends):
                tally.add(*count(points, ends, ORDER))
            if tally.full:
                yield from hand_on()
        yield from hand_on()

    return docs.select("text").mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def gram_probabilities(model: Learned, grams: DataFrame) -> DataFrame:
    """``gram``, ``n`` and ``logs``: of every padded n-gram, the log-probability of its last character in each language."""
    width, kinds = len(model.languages), model.kinds

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, lower = len(batch), batch.column("lower")
            if lower.null_count:
                p = np.full((n, width), 1.0 / (kinds + 1))
            else:
                p = lower.flatten().to_numpy().reshape(n, width).copy()
            for name, change in (("back", np.multiply), ("own", np.add)):
                lists = batch.column(name)
                rows = np.repeat(np.arange(n), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                of, values = (x.to_numpy(zero_copy_only=False) for x in lists.flatten().flatten())
                p[rows, of] = change(p[rows, of], values)
            yield pa.record_batch({"gram": batch.column("gram"), "p": pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * width, p.ravel())})

    real = F.ltrim("gram", F.lit(PAD))
    tasks = tasks_for(grams)
    grams = grams.coalesce(tasks)
    opened = grams.select(real.alias("gram"))
    wanted = {ORDER: opened.filter(F.char_length("gram") == ORDER)}
    for k in range(ORDER - 1, 0, -1):
        tails = wanted[k + 1].select(F.expr("substring(gram, 2)").alias("gram"))
        wanted[k] = tails.union(opened.filter(F.char_length("gram") == k)).distinct().coalesce(tasks)
    below = every = None
    for k in range(1, ORDER + 1):
        rows = wanted[k].join(model.grams, "gram", "left").withColumn("head", F.expr(f"substring(gram, 1, {k - 1})")).join(model.contexts, "head", "left")
        if below is None:
            rows = rows.withColumn("lower", F.lit(None).cast("array<double>"))
        else:
            rows = rows.withColumn("tail", F.expr("substring(gram, 2)")).join(below.select(F.col("gram").alias("tail"), F.col("p").alias("lower")), "tail")
        below = rows.select("gram", "own", "back", "lower").mapInArrow(run, "gram string, p array<double>").coalesce(tasks)
        if k < ORDER:
            below = checkpoint(below)
        every = below if every is None else every.unionByName(below)
    named = grams.select(F.col("gram").alias("padded"), "n", real.alias("gram"))
    return named.join(every, "gram").select(F.col("padded").alias("gram"), "n", F.transform("p", lambda x: F.log(x)).alias("logs")).coalesce(tasks)


def _entropies(docs: DataFrame, model: Learned, keep: list[str]) -> DataFrame:
    """The columns to keep and ``entropies``, by language; null for texts without a letter.

    The n-grams of all texts are counted once and their probabilities computed once each. The most frequent ones, a
    bounded table, are broadcast; occurrences of the others leave their task as (row, n-gram, times) and are joined by n-gram.
    """
    known = checkpoint(gram_probabilities(model, checkpoint(corpus_grams(docs))))
    most = max(1, min(HOT, CELLS // len(model.languages)))
    hot = known.orderBy(F.desc("n"), "gram").limit(most).select("gram", "logs").toArrow().combine_chunks()
    keys = hashes(np.array(hot.column("gram").to_pylist(), f"<U{ORDER}"))
    logs = hot.column("logs").combine_chunks().flatten().to_numpy().reshape(len(keys), len(model.languages))
    order = np.argsort(keys)
    table = docs.sparkSession.sparkContext.broadcast((keys[order], np.ascontiguousarray(logs[order].T)))
    kinds = dict(docs.dtypes)
    found = checkpoint(docs.select(*keep, "text", F.monotonically_increasing_id().alias("__row")).mapInArrow(
        lambda batches: _score(batches, table, keep),
        f"{', '.join(f'{k} {kinds[k]}' for k in keep)}, __row long, chars long, sums array<double>, gram string, n long",
    ))
    cold = found.filter(F.col("gram").isNotNull()).select("__row", "gram", F.col("n").alias("times")).join(known.select("gram", "logs"), "gram")
    rest = cold.select("__row", "times", F.posexplode("logs").alias("of", "v")).groupBy("__row", "of").agg(F.sum(F.col("times") * F.col("v")).alias("v"))
    rest = rest.groupBy("__row").agg(F.transform(F.sort_array(F.collect_list(F.struct("of", "v"))), lambda x: x["v"]).alias("rest"))
    whole = found.filter(F.col("gram").isNull()).join(rest, "__row", "left")
    total = F.coalesce(F.zip_with("sums", "rest", lambda a, b: a + b), F.col("sums"))
    return whole.select(*keep, F.when(F.col("chars") > 0, F.transform(total, lambda x: -x / F.col("chars"))).alias("entropies"))


def _score(batches: Iterator[pa.RecordBatch], table, keep: list[str]) -> Iterator[pa.RecordBatch]:
    keys, logs = table.value
    hot = Sorted(keys)
    carried = [*keep, "__row"]
    names = [*carried, "chars", "sums", "gram", "n"]
    for batch in slices(batches, SLICE):
        points, starts, ends = _padded(batch.column("text").to_pylist())
        of = np.searchsorted(starts, ends, "right") - 1
        hashed = rolling(points, ORDER)[ends - ORDER + 1]
        at = hot.find(hashed)
        n, hit = len(batch), at >= 0
        sums = np.stack([np.bincount(of[hit], column[at[hit]], n) for column in logs], 1).astype(np.float64)  # without any, bincount gives integers
        lists = pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * len(logs), sums.ravel())
        empty = pa.nulls(n, pa.string()), pa.nulls(n, pa.int64())
        yield pa.record_batch([*[batch.column(c) for c in carried], pa.array(np.bincount(of, minlength=n)), lists, *empty], names=names)
        if len(missed := np.flatnonzero(~hit)):
            missed = missed[np.lexsort((hashed[missed], of[missed]))]
            first = np.ones(len(missed), bool)
            first[1:] = (np.diff(hashed[missed]) != 0) | (np.diff(of[missed]) != 0)
            first = np.flatnonzero(first)
            times = np.diff(np.append(first, len(missed)))
            windows = np.lib.stride_tricks.sliding_window_view(points, ORDER)[ends[missed[first]] - ORDER + 1]
            grams = np.ascontiguousarray(windows).view(f"<U{ORDER}").ravel()
            m = len(first)
            yield pa.record_batch([
                *[pa.nulls(m, batch.column(c).type) for c in keep], batch.column("__row").take(pa.array(of[missed[first]])), pa.nulls(m, pa.int64()),
                pa.nulls(m, lists.type), pa.array(grams.tolist(), pa.string()), pa.array(times),
            ], names=names)


def identify(docs: DataFrame, model: Learned) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` and ``rejected`` of every whole text.

    ``lang_pred`` is the language of the lowest cross-entropy per character, the first by name among equals, and ``und`` with score 0
    for a null text, one without a letter, or a model that has learned nothing. ``score`` is its calibrated share among the
    languages. ``rejected``: the text is less likely than nearly all of that language's own, so that the
    prediction should not be relied on. Repeated rows come out again, a null id is kept, other columns are ignored.
    """
    if not model.languages:
        return docs.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    names = F.array(*map(F.lit, model.languages))
    best = F.array_min("entropies")
    odds = F.aggregate(F.transform("entropies", lambda x: F.exp((best - x) * model.scale)), F.lit(0.0), lambda a, b: a + b)
    limits = F.create_map(*[F.lit(x) for pair in (model.limits or {"": 0.0}).items() for x in pair])
    told = F.col("entropies").isNotNull()
    named = _entropies(docs, model, ["doc_id"]).select(
        "doc_id", F.when(told, F.element_at(names, F.array_position("entropies", best).cast("int"))).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(told, 1 / odds).otherwise(0.0).alias("score"), best.alias("least"),
    )
    beyond = F.coalesce(F.col("least") > F.try_element_at(limits, F.col("lang_pred")), F.col("least").isNull())
    return named.withColumn("rejected", beyond).drop("least")


@query()
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = given(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = learn(docs.filter(~held_out & F.col("doc_id").isNotNull()))
    return identify(docs, model).withColumn("held_out", held_out)
