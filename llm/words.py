"""Pre-tokens by numpy, and a bounded cache of what each distinct one encodes to."""
from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import numpy as np
import regex

from llm.common import mix, ranges

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3


@lru_cache(1)
def classes() -> np.ndarray:
    """Letter, number, white space or other, by code point."""
    kind = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for pattern, value in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", SPACE)):
        kind[[ord(c) for c in regex.findall(pattern, every)]] = value
    return kind


def byte_bpe_starts(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where pre-tokens start, by the pattern of the byte-level vocabularies:

    ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``
    """
    n = len(points)
    kind = classes()[points]
    begins = np.zeros(n + 1, bool)  # of a text
    begins[starts] = True
    cut = begins.copy()
    cut[1:n] |= kind[1:] != kind[:-1]
    # The last white-space character before a word stands by itself; a blank joins the word.
    after = np.flatnonzero(cut[1:n] & ~begins[1:n] & (kind[:-1] == SPACE)) + 1
    cut[after - 1] = True
    cut[after[points[after - 1] == 32]] = False
    # Contractions: an apostrophe that starts a pre-token takes the letters of its ending.
    quote = np.flatnonzero((points == 39) & cut[:n])
    quote = quote[quote + 1 < n]
    quote = quote[(kind[quote + 1] == LETTER) & ~begins[quote + 1]]
    one, two = points[quote + 1], points[np.minimum(quote + 2, n - 1)]
    two = np.where((quote + 2 < n) & ~begins[np.minimum(quote + 2, n)], two, 0)
    is_one = np.isin(one, [ord(c) for c in "stmd"])
    pairs = [(ord(a), ord(b)) for a, b in ("re", "ve", "ll")]
    is_two = ~is_one & np.logical_or.reduce([(one == a) & (two == b) for a, b in pairs])
    for some, size in ((quote[is_one], 1), (quote[is_two], 2)):
        cut[some + 1] = False
        cut[some + 1 + size] = True
    cut[n] = False
    return np.flatnonzero(cut)


def segment_hashes(points: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each stretch [first, last), its length included; the stretches come in order and do not overlap.

    Every pair of a character and its place in the stretch has a value of its own, and a hash is the sum of these. A
    polynomial modulo 2^64 would give equal hashes to certain strings whatever its base.
    """
    some = first[first < len(points)]
    origin = np.zeros(len(points), np.int64)
    origin[some] = some
    place = (np.arange(len(points)) - np.maximum.accumulate(origin)).astype(np.uint64)
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(mix(((place << np.uint64(21)) + points + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)), out=sums[1:])
    return mix(sums[last] - sums[first] + (last - first).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


class WordCache:
    """Ids of distinct words. Beyond ``limit`` words or ``most`` ids it starts anew, and a word of more than ``long``
    characters is not kept, so memory stays bounded whatever the text."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], limit: int = 500_000, most: int = 1 << 22, long: int = 256) -> None:
        self.encode, self.limit, self.most, self.long = encode, limit, most, long
        self._clear()

    def _clear(self) -> None:
        self.keys, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # sorted by key; a slot is a word's place below
        self.count, self.start, self.flat = 0, np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int32)

    def _append(self, words: list[str]) -> np.ndarray:
        """Put the ids of more words behind the others; returns the words' slots."""
        found = self.encode(words)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        base, end = self.count, self.count + len(words)
        begin = int(self.start[base])
        self.start, self.flat = _room(self.start, end + 1), _room(self.flat, begin + int(lengths.sum()))
        self.start[base + 1 : end + 1] = begin + np.cumsum(lengths)
        self.flat[begin : self.start[end]] = np.fromiter(chain.from_iterable(found), np.int32, int(lengths.sum()))
        self.count = end
        return np.arange(base, end)

    def ids(self, text: str, points: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words [first, last) of ``text`` end to end, and how many each word has."""
        keys, at, inverse = np.unique(segment_hashes(points, first, last), return_index=True, return_inverse=True)
        if self.count + len(keys) > self.limit or self.start[self.count] > self.most:
            self._clear()
        place = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == keys[inside]
        slot = np.empty(len(keys), np.int64)
        slot[known] = self.slots[place[known]]
        short = (last - first)[at] <= self.long
        kept = self.count
        for new in (np.flatnonzero(~known & short), np.flatnonzero(~known & ~short)):  # long words last, as they are forgotten again
            if len(new):
                slot[new] = self._append([text[a:b] for a, b in zip(first[at[new]].tolist(), last[at[new]].tolist())])
                if short[new[0]]:
                    self.keys, self.slots = np.insert(self.keys, place[new], keys[new]), np.insert(self.slots, place[new], slot[new])
                    kept = self.count
        self.count = kept
        slot = slot[inverse]
        sizes = self.start[slot + 1] - self.start[slot]
        return self.flat[ranges(self.start[slot], sizes)], sizes


def _room(values: np.ndarray, size: int) -> np.ndarray:
    """The array, or a copy with at least twice the room if it is too small."""
    if size <= len(values):
        return values
    larger = np.zeros(max(size, 2 * len(values)), values.dtype)
    larger[: len(values)] = values
    return larger
