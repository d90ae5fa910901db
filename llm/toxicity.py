"""Toxicity by multiple-instance learning: sentences scored, documents labelled."""
from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from llm.common import given, query

SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")
WORD = re.compile(r"\w+")


def features(word: str) -> tuple[str, str, str]:
    """The word itself and its first four and five letters, which stand for its stem."""
    return word, "^" + word[:4], "^" + word[:5]


def split(text: str) -> Iterator[tuple[int, int, set[str]]]:
    """Start, end and distinct lower-case words of every sentence."""
    low = text.lower()
    if len(low) != len(text):  # some letters become several in lower case; these stay as they are, so that places hold
        low = "".join([x if len(x) == 1 else c for c, x in zip(text, map(str.lower, text))])
    for match in SENTENCE.finditer(low):
        yield *match.span(), set(WORD.findall(match.group()))


@dataclass
class Model:
    """Weights of words and stems, and what a sentence without any of them has."""

    bias: float
    weights: dict[str, float]
    cut: float = 0.5  # the probability from which a document counts as toxic
    known: dict[str, float] = field(default_factory=dict)  # words met before

    def word(self, word: str) -> float:
        if len(self.known) > 500_000:
            self.known.clear()
        weight = self.known[word] = sum(self.weights.get(f, 0.0) for f in features(word))
        return weight

    def sentences(self, text: str) -> list[tuple[int, int, float]]:
        """Start, end and log-odds of every sentence."""
        get, found = self.known.get, []
        for start, end, words in split(text):
            weights = map(get, words)
            found.append((start, end, self.bias + sum([self.word(w) if x is None else x for w, x in zip(words, weights)])))
        return found


    def document(self, odds: np.ndarray) -> float:
        """The score of a document with such sentences: the noisy-or, its odds scaled so that 0.5 stands for ``cut``."""
        p = noisy_or(odds)
        return p * (1 - self.cut) / (p * (1 - self.cut) + (1 - p) * self.cut) if 0 < p < 1 else p


def noisy_or(odds: np.ndarray) -> float:
    """The probability that at least one sentence is toxic: 1 - prod(1 - p)."""
    return float(-np.expm1(-np.logaddexp(0.0, odds).sum())) if len(odds) else 0.0


def learn(docs: DataFrame, labels: DataFrame, per_class: int = 3000, least_z: float = 3.0, alarms: float = 0.005, steps: int = 150, seed: int = 7) -> Model:
    """Fit word weights so that the noisy-or over a document's sentences explains its label.

    ``docs`` has ``doc_id`` and ``text``, ``labels`` has ``doc_id`` and ``toxic``. The fit is on a bounded
    sample: the ``per_class`` labelled documents of either class with the smallest hash of their
    id, whole texts. Only words and stems get a weight whose share of the toxic documents differs from that of
    the clean ones by ``least_z`` standard errors: the others are noise at this sample. The cut between toxic and clean is the
    lowest of 0.5, 0.45, ... 0.2 at which, in either half of the sample under a model of the other, no more than ``alarms`` of the clean
    documents (or a single one) lie above it. Only labels of documents in ``docs`` count. Of several labels of a
    document the highest counts; null labels, ids and texts without a sentence teach nothing. Without
    toxic examples every score is 0; without clean ones every text with a sentence scores 1.
    """
    marks = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    marks = marks.join(docs.select("doc_id"), "doc_id", "left_semi")  # labels of other documents take no place in the sample
    order = F.xxhash64("doc_id", F.lit(seed))
    chosen = [marks.filter(F.col("toxic") == value).orderBy(order, "doc_id").limit(per_class) for value in (True, False)]
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen[0].union(chosen[1])), "doc_id")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[" ".join(sorted(words)) for _, _, words in split(text or "")] for text in batch.column("text").to_pylist()]
            yield pa.record_batch({"toxic": batch.column("toxic"), "words": pa.array(found, pa.list_(pa.string()))})

    sample = [(r["toxic"], r["words"]) for r in rows.mapInArrow(cut, "toxic boolean, words array<string>").collect() if r["words"]]
    sample.sort()  # so that the order in which tasks end does not matter
    labels_seen = {toxic for toxic, _ in sample}
    if labels_seen != {True, False}:
        return Model(50.0 if labels_seen == {True} else -50.0, {})
    toxic = np.array([t for t, _ in sample])
    seen = (Counter(), Counter())  # documents of each class that have a feature
    for label, sentences in sample:
        seen[label].update({f for word in set(" ".join(sentences).split()) for f in features(word)})
    sizes = (len(toxic) - toxic.sum(), toxic.sum())
    place = {w: i for i, w in enumerate(sorted(w for w in seen[1] | seen[0] if abs(_z(seen[1][w], sizes[1], seen[0][w], sizes[0])) >= least_z))}
    words = [[place[f] for w in s.split() for f in features(w) if f in place] for _, sentences in sample for s in sentences]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    at = np.fromiter((i for s in words for i in s), np.int64, int(lengths.sum()))
    sentence = np.repeat(np.arange(len(words)), lengths)
    of = np.repeat(np.arange(len(sample)), [len(s) for _, s in sample])
    bias, weights = _fit(at, sentence, of, toxic, len(place), steps, np.ones(len(toxic)))
    half, crossed = np.arange(len(toxic)) % 2, np.zeros(len(toxic))
    for own in (0, 1):  # the sample is in order of the labels, so both halves have both
        other = _fit(at, sentence, of, toxic, len(place), steps, (half != own).astype(float))
        crossed[half == own] = _probabilities(at, sentence, of, len(toxic), *other)[0][half == own]
    most = max(1.0, alarms * (~toxic).sum())
    cuts = [c for c in np.arange(0.2, 0.5, 0.05) if all((crossed[~toxic] >= x).sum() <= most for x in np.arange(c, 0.5, 0.05))]
    return Model(bias, dict(zip(place, weights.tolist())), float(min(cuts, default=0.5)))


def _z(a: int, of_a: int, b: int, of_b: int) -> float:
    """Standard errors between the shares a / of_a and b / of_b."""
    share = (a + b) / (of_a + of_b)
    return (a / of_a - b / of_b) / max(1e-12, (share * (1 - share) * (1 / of_a + 1 / of_b)) ** 0.5)


def _probabilities(at: np.ndarray, sentence: np.ndarray, of: np.ndarray, documents: int, bias: float, w: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of every document the noisy-or and -log of no toxic sentence, and the log-odds of every sentence."""
    z = bias + np.bincount(sentence, w[at], len(of))
    none = np.bincount(of, np.logaddexp(0.0, z), documents)
    return -np.expm1(-none), none, z


def _fit(at: np.ndarray, sentence: np.ndarray, of: np.ndarray, toxic: np.ndarray, words: int, steps: int, share: np.ndarray) -> tuple[float, np.ndarray]:
    """Bias and weights by Adam on the log-likelihood of the noisy-or; ``at``: words, of ``sentence``, which is ``of`` a document that counts by its ``share``."""
    w, bias = np.zeros(words), -4.0
    m, v = np.zeros(words + 1), np.zeros(words + 1)
    for step in range(1, steps + 1):
        _, none, z = _probabilities(at, sentence, of, len(toxic), bias, w)
        slope = share * np.where(toxic, -1.0 / np.expm1(np.clip(none, 1e-6, 50.0)), 1.0)
        g = slope[of] / (1.0 + np.exp(-z)) / share.sum()
        grad = np.append(np.bincount(at, g[sentence], words) + 1e-4 * w, g.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        move = 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        w -= move[:-1]
        bias -= move[-1]
    return float(bias), w


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1), ``predicted`` (1 from 0.5 on) and ``offending`` of every whole text.

    ``offending`` lists the sentences that are toxic rather than not, as ``[from, to)`` in characters with their score. A null
    or empty text scores 0. Repeated rows come out again, a null id is kept, other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32()), ("score", pa.float64())]))
        for batch in batches:
            scores, spans = [], []
            for text in batch.column("text").to_pylist():
                found = model.sentences(text or "")
                scores.append(model.document(np.array([z for _, _, z in found])))
                spans.append([{"from": a, "to": b, "score": float(1 / (1 + np.exp(-z)))} for a, b, z in found if z >= 0])
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "score": pa.array(scores, pa.float64()), "offending": pa.array(spans, kind)})

    scored = docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, score double, offending array<struct<from:int,to:int,score:double>>"
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query()
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, fold = given(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 5
    model = learn(docs.filter(fold != 0), given(spark, sf_dir, "labels"))
    held_out = F.coalesce(fold == 0, F.lit(False)).alias("held_out")
    return score(docs, model).select("doc_id", held_out, "score", "predicted", "offending")
