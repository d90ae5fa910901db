"""Character n-grams: hashes over code points, counts per task, sorted hash arrays."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from llm.common import mix

STEP = np.uint64(0x9E3779B97F4A7C15)


def rolling(points: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of the n code points that end at each place, from place n - 1 on."""
    if len(points) < n:
        return np.zeros(0, np.uint64)
    wide = points.astype(np.uint64) + np.uint64(1)
    h = wide[: len(points) - n + 1].copy()
    for k in range(1, n):
        h *= STEP
        h ^= wide[k : len(points) - n + 1 + k]
    return mix(h)


def hashes(grams: np.ndarray) -> np.ndarray:
    """The same hash of n-grams given as an array of strings of one length."""
    n = grams.dtype.itemsize // 4
    points = np.ascontiguousarray(grams).view(np.uint32).reshape(len(grams), n).astype(np.uint64) + np.uint64(1)
    h = points[:, 0].copy()
    for k in range(1, n):
        h *= STEP
        h ^= points[:, k]
    return mix(h)


def count(points: np.ndarray, ends: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams that end at the given places: hashes, strings, counts."""
    keys, at, counts = np.unique(rolling(points, n)[ends - n + 1], return_index=True, return_counts=True)
    windows = np.lib.stride_tricks.sliding_window_view(points, n)[ends[at] - n + 1]
    return keys, np.ascontiguousarray(windows).view(f"<U{n}").ravel(), counts


class Tally:
    """Counts that add up over a task; ``full`` says when to hand them on. With twice ``limit`` n-grams of 36 bytes it takes some 20 MB."""

    def __init__(self, limit: int = 1 << 18) -> None:
        self.limit, self.parts, self.size = limit, [], 0

    def add(self, keys: np.ndarray, grams: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((keys, grams, counts))
        self.size += len(keys)
        if self.size > 2 * self.limit:
            self.parts = [self._merged()]
            self.size = len(self.parts[0][0])

    @property
    def full(self) -> bool:
        return self.size > self.limit

    def _merged(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys, grams, counts = (np.concatenate(x) for x in zip(*self.parts))
        keys, at, inverse = np.unique(keys, return_index=True, return_inverse=True)
        return keys, grams[at], np.bincount(inverse, counts, len(keys)).astype(np.int64)

    def take(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The n-grams and counts so far, after which it is empty."""
        if self.parts:
            _, grams, counts = self._merged()
            self.parts, self.size = [], 0
            yield grams, counts


class Sorted:
    """A sorted array of distinct hashes, with an index on their leading bits so that a lookup touches few places."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = keys
        bits = max(1, min(24, int(len(keys)).bit_length()))
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(keys >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """The place of each hash, or -1."""
        if not len(self.keys):
            return np.full(len(wanted), -1, np.int32)
        top = (wanted >> self.shift).astype(np.int32)
        at, end = self.first[top], self.first[top + 1]
        found = np.full(len(wanted), -1, np.int32)
        left = np.flatnonzero(at < end)
        while len(left):
            place = at[left]
            hit = self.keys[place] == wanted[left]
            found[left[hit]] = place[hit]
            left = left[~hit]
            at[left] += 1
            left = left[at[left] < end[left]]
        return found
