"""Phrase collocations against brute force, and the summaries' guarantee."""
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import llm.phrases as phrases
from llm.phrases import Summary, collocations, frequent_phrases
from tests.llm.conftest import edge_rows, words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, threshold, longest=4, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            found = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(found)
            for n in range(1, longest + 1):
                counts[lang].update(tuple(found[i : i + n]) for i in range(len(found) - n + 1))
    every, out = [], []
    for lang, own in counts.items():
        frequent = {p: f for p, f in own.items() if f >= threshold}
        every += [(lang, " ".join(p), len(p), f) for p, f in frequent.items()] + ([(lang, "", 0, totals[lang])] if totals[lang] else [])
        longer = defaultdict(int)
        for p, f in frequent.items():
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    longer[p[i : i + n]] = max(longer[p[i : i + n]], f)
        kept = []
        for p, a in frequent.items():
            if len(p) > 1 and not 100 * longer[p] >= 80 * a:
                score, _, l, r = min((2_000_000 * a // (own[p[:k]] + own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, totals[lang], -score))
    return sorted(every), sorted(out)


def collected(df):
    return sorted(tuple(r) for r in df.collect())


def prose(rng, documents):
    vocabulary = words(rng, 60).split()
    lines = [" ".join(rng.choices(vocabulary, k=rng.randint(2, 6))) for _ in range(12)]
    texts = []
    for _ in range(documents):
        parts = [rng.choice(lines) if rng.random() < 0.5 else " ".join(rng.choices(vocabulary, k=4)) for _ in range(rng.randint(1, 9))]
        texts.append("".join(p + rng.choice([". ", "  ", "\t", "\n", ", ", " ", " ", "\x0b"]) for p in parts))
    return texts


@pytest.fixture
def small(monkeypatch):
    """Many hash partitions, summaries that must drop counters, many hand-overs, ranking in several steps."""
    for name, value in {"SLICE": 400, "HELD": 64, "MERGED": 8, "PHRASES": 40, "RANKED": 30, "BUCKETS": 5}.items():
        monkeypatch.setattr(phrases, name, value)


@pytest.mark.parametrize("threshold, top", [(2, 2000), (5, 20)])
def test_edges_and_prose(spark, edge, small, threshold, top):
    rng = random.Random(6)
    more = [(5000 + i, t, rng.choice(["en", "en", None, "und", "日"])) for i, t in enumerate(prose(rng, 150) + ["the the the the the the", "Ünal Ünal ünal", "a" * 70_000 + " x " + "a" * 70_000 + " x"] * 3)]
    docs = edge.unionByName(spark.createDataFrame(more, "doc_id long, text string, lang string"), allowMissingColumns=True)
    rows = [(r[2], r[1]) for r in edge_rows()] + [(lang, t) for _, t, lang in more]
    every, best = brute(rows, threshold, top=top)
    assert collected(frequent_phrases(docs, threshold)) == every
    assert collected(collocations(docs, threshold, top=top)) == best


def test_shorter_phrases(spark):
    rows = [("en", t) for t in prose(random.Random(2), 60)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    for longest in (2, 3):
        assert collected(collocations(docs, 3, longest)) == brute(rows, 3, longest)[1]


def test_a_hot_language_and_a_hot_phrase(spark):
    rows = [("en", "of the same thing")] * 3000 + [("de", t) for t in prose(random.Random(9), 50)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(7)
    assert collected(collocations(docs)) == brute(rows, 30)[1]


def test_every_frequent_key_survives_a_summary(monkeypatch):
    monkeypatch.setattr(phrases, "MERGED", 16)
    rng = np.random.default_rng(3)
    for threshold in (3, 10, 30):
        for _ in range(20):
            keys = np.concatenate([rng.zipf(1.3, 4000).astype(np.uint64) % 3000, np.repeat(np.arange(5000, 5010, dtype=np.uint64), threshold)])
            rng.shuffle(keys)
            summary = Summary(len(keys) // threshold + 1)
            for part in np.array_split(keys, 40):
                summary.add(*np.unique(part, return_counts=True))
            left = set(summary.survivors(threshold).tolist())
            names, counts = np.unique(keys, return_counts=True)
            assert set(names[counts >= threshold].tolist()) <= left
            assert len(summary.keys) <= summary.capacity and summary.error < threshold
            known = dict(zip(names.tolist(), counts.tolist()))
            assert all(known[k] - summary.error <= c <= known[k] for k, c in zip(summary.keys.tolist(), summary.counts.tolist()))


def test_empty(empty):
    assert frequent_phrases(empty).count() == 0 and collocations(empty).count() == 0
    with pytest.raises(ValueError):
        frequent_phrases(empty, longest=5)
