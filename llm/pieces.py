"""SentencePiece encoding by a prefix table of last tokens, and decoding."""
from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from llm.common import codepoints, given, query, ranges, slices
from llm.packing import SLICE, tokenizer_file
from llm.words import WordCache

BLANK = "▁"  # stands for a space
NORMAL, BYTE = 1, 6  # fixed values: types of pieces in a model file


def _read(path: str):
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    return model


class Pieces:
    """A merge-type vocabulary with byte fallback, as read from its model file.

    Rank says when a piece merges: the higher its score the sooner. A piece whose own text does not
    merge into it can never come out and is left out.
    """

    def __init__(self, path: str) -> None:
        model = _read(path)
        spec = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or spec.precompiled_charsmap or spec.remove_extra_whitespaces or not (
            spec.add_dummy_prefix and spec.escape_whitespaces and model.trainer_spec.byte_fallback
        ):
            raise ValueError(f"{path}: only merge-type models with byte fallback and without text normalisation are read")
        plain = [(p.piece, i, p.score) for i, p in enumerate(model.pieces) if p.type == NORMAL]
        order = {score: rank for rank, score in enumerate(sorted({-s for _, _, s in plain}))}
        self.ids = {text: i for text, i, _ in plain}
        self.text = {i: text for text, i, _ in plain}
        self.sizes = {i: len(text) for text, i, _ in plain}
        self.rank = {i: -1 if len(text) == 1 else order[-score] for text, i, score in plain}
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.parts: dict[int, tuple[int, int]] = {}  # of its last merge
        self.automaton = ahocorasick.Automaton()
        for text, i, _ in plain:
            if len(text) > 1:
                found, last = self.merge(text)
                if len(found) > 1:
                    continue
                self.parts[i] = last
            self.automaton.add_word(text, (i, len(text)))
        self.automaton.make_automaton()
        # The pair test reads ranks as times, which holds where no piece merges sooner than its parts.
        self.odd = {i for i, parts in self.parts.items() if any(self.rank[p] >= self.rank[i] for p in parts)}
        for i in sorted(self.parts, key=lambda i: len(self.text[i])):
            if any(p in self.odd for p in self.parts[i]):
                self.odd.add(i)
        self.known = np.zeros(0x110000, bool)
        self.known[[ord(text) for text, _, _ in plain if len(text) == 1]] = True
        self.fits: dict[int, bool] = {}

    def merge(self, text: str) -> tuple[list[int], tuple[int, int] | None]:
        """Merge the best neighbours, leftmost first, until none merge; also the parts of the last merge."""
        symbols: list[int | None] = [self.ids.get(c, -1) for c in text]
        spelt = list(text)
        before, after = list(range(-1, len(text) - 1)), [*range(1, len(text)), -1]
        heap: list[tuple[int, int, str]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] >= 0 and (made := self.ids.get(both := spelt[i] + spelt[after[i]])) is not None:
                heapq.heappush(heap, (self.rank[made], i, both))

        for i in range(len(text) - 1):
            offer(i)
        parts = None
        while heap:
            _, i, both = heapq.heappop(heap)
            if symbols[i] is None or after[i] < 0 or spelt[i] + spelt[after[i]] != both:
                continue
            j = after[i]
            parts = (symbols[i], symbols[j])
            symbols[i], spelt[i], symbols[j] = self.ids[both], both, None
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [s for s in symbols if s is not None], parts

    def pair(self, left: int, right: int) -> bool:
        """Whether the two stay apart when their texts are merged together.

        Undo the merges of both, the latest first. The symbols that touch at any one time must not form
        a piece that merges before either of them goes into a larger one.
        """
        key = left << 32 | right
        known = self.fits.get(key)
        if known is not None:
            return known
        if len(self.fits) > 500_000:
            self.fits.clear()
        if left in self.odd or right in self.odd:
            fits = self.merge(self.text[left] + self.text[right])[0] == [left, right]
        else:
            x, y, x_ends, y_ends, fits = left, right, 1 << 60, 1 << 60, True
            while True:
                made = self.ids.get(self.text[x] + self.text[y])
                if made is not None and self.rank[made] < x_ends and self.rank[made] <= y_ends:
                    fits = False
                    break
                if self.rank[x] < 0 and self.rank[y] < 0:
                    break
                if self.rank[y] >= self.rank[x]:
                    y_ends, y = self.rank[y], self.parts[y][0]
                else:
                    x_ends, x = self.rank[x], self.parts[x][1]
        self.fits[key] = fits
        return fits

    def encode(self, segment: str) -> list[int]:
        """Ids of a segment: the last token of every prefix, found from shorter prefixes, then read backwards."""
        if segment not in self.ids and len(segment) == 1:
            return [self.byte_ids[b] for b in segment.encode("utf-8", "replace")]
        if segment.startswith(BLANK * 2):
            return self.merge(segment)[0]  # pieces of blanks share one score, so ranks do not order them
        last = [-1] * (len(segment) + 1)
        fits, pair = self.fits, self.pair
        for end, (token, size) in self.automaton.iter(segment):
            end += 1
            if last[end] < 0:
                if end == size:
                    last[end] = token
                    continue
                before = last[end - size]
                known = fits.get(before << 32 | token)
                if pair(before, token) if known is None else known:
                    last[end] = token
        ids, at, sizes = [], len(segment), self.sizes
        while at:
            token = last[at]
            ids.append(token)
            at -= sizes[token]
        ids.reverse()
        return ids

    def segment_starts(self, points: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Where segments start that no piece crosses: at blanks after other characters, around unknown characters."""
        blank, strange = points == ord(BLANK), ~self.known[points]
        cut = np.zeros(len(points) + 1, bool)
        cut[starts] = True
        cut[1:-1] |= (blank[1:] & ~blank[:-1]) | strange[1:] | strange[:-1]
        return np.flatnonzero(cut[: len(points)])


@lru_cache(2)
def _model(path: str) -> tuple[Pieces, WordCache]:
    pieces = Pieces(path)
    return pieces, WordCache(lambda words: [pieces.encode(w) for w in words])


@lru_cache(2)
def spellings(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of every piece end to end, where each begins and how many it has."""
    spelt = {NORMAL: lambda p: p.piece.replace(BLANK, " ").encode(), BYTE: lambda p: bytes([int(p.piece[3:5], 16)])}
    spellings = [spelt.get(p.type, lambda _: b"")(p) for p in _read(path).pieces]
    sizes = np.fromiter(map(len, spellings), np.int64, len(spellings))
    return np.frombuffer(b"".join(spellings), np.uint8), np.cumsum(sizes) - sizes, sizes


def piece_ids(texts: list[str | None], model: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the texts end to end, and the n + 1 places where each text's begin."""
    pieces, cache = _model(model)
    texts = [BLANK + t.replace(" ", BLANK) if t else "" for t in texts]
    points, starts = codepoints(texts)
    if not len(points):
        return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    first = pieces.segment_starts(points, starts)
    ids, sizes = cache.ids("".join(texts), points, first, np.append(first[1:], len(points)))
    return ids, np.concatenate([[0], np.cumsum(sizes)])[np.searchsorted(first, starts)]


def encode(docs: DataFrame, model: str) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of every whole text, without begin or end ids.

    An empty or null text has no ids. Repeated rows come out again, a null id is kept, other columns are
    ignored. Nothing is shuffled; distinct segments are encoded once per worker in a bounded
    cache, and a segment takes time in proportion to its length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SLICE):
            ids, ends = piece_ids(batch.column("text").to_pylist(), model)
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids, pa.int32()))
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "ids": lists})

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """Adds ``text`` to ``ids``: the pieces' texts without the first one's leading space; null ids give an empty text.

    Bytes that form no character become U+FFFD; ids that ``encode`` made never hold such bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, begin, sizes = spellings(model)
        for whole in batches:
            for at in range(0, len(whole), 500):
                batch = whole.slice(at, 500)
                lists = batch.column("ids").fill_null([])
                starts = lists.offsets.to_numpy().astype(np.int64)
                ids = lists.values.to_numpy()[starts[0] : starts[-1]]
                starts = starts - starts[0]
                data = flat[ranges(begin[ids], sizes[ids])].tobytes()
                ends = np.concatenate([[0], np.cumsum(sizes[ids])])[starts]
                texts = [data[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                texts = [t[1:] if t.startswith(" ") else t for t in texts]
                yield pa.record_batch([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "text"])

    return encoded.mapInArrow(run, f"{', '.join(f'`{n}` {t}' for n, t in encoded.dtypes)}, text string")


@query()
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = tokenizer_file("piece_bpe_32k.model")
    done = decode(encode(given(spark, sf_dir, "documents"), model), model)
    return done.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
