"""Kneser-Ney models in memory, against which the tests hold the library's, which are tables."""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from llm.language import ORDER
from llm.ngrams import Sorted, hashes, rolling


@dataclass
class Model:
    """A model in memory: per order, sorted hash arrays of n-grams with log-probabilities, and of contexts with log back-off weights, a column per language."""

    languages: list[str]
    grams: list[tuple[Sorted, np.ndarray]]
    contexts: list[tuple[Sorted, np.ndarray]]

    def entropies(self, points: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Cross-entropy per character of every text under every language, in nats; nan without characters."""
        texts, places = len(starts) - 1, np.arange(len(points)) - np.repeat(starts[:-1], np.diff(starts))
        total = np.zeros((len(points), len(self.languages)), np.float32)
        open_ = np.flatnonzero(places > 0)  # the opening space is context only
        for order in range(ORDER, 0, -1):
            if not len(open_):
                break
            # A place whose n-gram no language has seen backs off to a shorter one, as one near the start does.
            deep = places[open_] >= order - 1
            ends = open_[deep]
            sorted_, logs = self.grams[order - 1]
            found = sorted_.find(rolling(points, order)[ends - order + 1])
            total[ends[found >= 0]] += logs[found[found >= 0]]
            missed = ends[found < 0]
            if order > 1:
                sorted_, logs = self.contexts[order - 1]
                back = sorted_.find(rolling(points, order - 1)[missed - order + 1])
                total[missed[back >= 0]] += logs[back[back >= 0]]
            elif len(missed):
                total[missed] += logs[-1]
            open_ = np.concatenate([open_[~deep], missed])
        sums = np.zeros((texts, len(self.languages)))
        some = np.diff(starts) > 0
        if some.any():
            sums[some] = np.add.reduceat(total, starts[:-1][some], axis=0, dtype=np.float64)
        with np.errstate(invalid="ignore", divide="ignore"):
            return -sums / (np.diff(starts) - 1)[:, None]


def fit(counts: dict[str, dict[str, int]]) -> Model:
    """Interpolated Kneser-Ney models from the counts of the longest n-grams of each language, where these fit in memory.

    Lower orders count the different characters that precede an n-gram. Each order takes its discount
    n1 / (n1 + 2 n2) and hands what it takes to the next lower one, the lowest to a uniform one.
    """
    languages = sorted(counts)
    tables = {}  # per order and language: n-grams, counts
    for lang in languages:
        grams = np.array(list(counts[lang]), f"<U{ORDER}")
        number = np.fromiter(counts[lang].values(), np.int64, len(grams))
        for order in range(ORDER, 0, -1):
            tables[order, lang] = grams, number
            if order > 1:
                grams, number = np.unique(_part(grams, 1, order), return_counts=True)
    model = Model(languages, [], [])
    below: tuple[Sorted, np.ndarray] | None = None
    for order in range(1, ORDER + 1):
        names = np.unique(np.concatenate([tables[order, lang][0] for lang in languages]))
        keys = hashes(names)
        names, keys = names[np.argsort(keys)], np.sort(keys)
        sorted_ = Sorted(keys)
        heads = _part(names, 0, order - 1) if order > 1 else None
        head_names = np.unique(heads) if order > 1 else np.zeros(1, "<U1")
        head_keys = np.sort(hashes(head_names)) if order > 1 else np.zeros(1, np.uint64)
        contexts = Sorted(head_keys)
        of = contexts.find(hashes(heads)) if order > 1 else np.zeros(len(names), np.int32)
        lower = below[1][below[0].find(hashes(_part(names, 1, order)))] if order > 1 else None
        probs, backs = np.zeros((len(names) + (order == 1), len(languages))), np.ones((len(head_keys), len(languages)))
        for column, lang in enumerate(languages):
            grams, number = tables[order, lang]
            at = sorted_.find(hashes(grams))
            ones, twos = (number == 1).sum(), (number == 2).sum()
            discount = ones / (ones + 2 * twos) if ones else 0.5
            taken = np.minimum(number, discount)
            sums = np.bincount(of[at], number, len(head_keys))
            share = np.bincount(of[at], taken, len(head_keys))
            seen = sums > 0
            backs[seen, column] = share[seen] / sums[seen]
            probs[at, column] = (number - taken) / sums[of[at]]
            base = 1.0 / (len(names) + 1) if order == 1 else lower[:, column]
            probs[: len(names), column] += backs[of, column] * base
            if order == 1:
                probs[-1, column] = backs[0, column] * base  # a character that none has seen
        below = (sorted_, probs)
        model.grams.append((sorted_, np.log(probs).astype(np.float32)))
        model.contexts.append((contexts, np.log(np.maximum(backs, 1e-12)).astype(np.float32)))
    return model


def _part(grams: np.ndarray, start: int, end: int) -> np.ndarray:
    points = np.ascontiguousarray(grams).view("<U1").reshape(len(grams), -1)
    return np.ascontiguousarray(points[:, start:end]).view(f"<U{end - start}").ravel()
