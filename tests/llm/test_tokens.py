"""Packing and SentencePiece against the libraries."""
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.packing import binary_pieces, decompose, tokenizer_file, write_buckets
from llm.pieces import Pieces, decode, encode
from llm.words import WordCache
from tests.llm.conftest import edge_rows

BPE, PIECES = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def given(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    return rows.withColumn("doc_id", F.col("doc_id") + 1000)


def tokenized(texts, plain=False):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BPE)
    if plain:
        tokenizer.encode_special_tokens = True
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


def pieces_of(ids):
    out, start = [], 0
    while start < len(ids):
        size = 2048 if len(ids) - start >= 2048 else 1 << ((len(ids) - start).bit_length() - 1)
        out.append((start, size, zlib.crc32(np.array(ids[start : start + size], "<u4").tobytes()), len(ids)))
        start += size
    return out


def test_packing_equals_the_tokenizer_cut_by_binary_digits(edge, given):
    want, have = Counter(), Counter()
    every = [*[(r[0], r[1]) for r in edge_rows()], *[tuple(r) for r in given.collect()]]
    for (i, _), ids in zip(every, tokenized([t for _, t in every])):
        want.update((i, *p) for p in pieces_of(ids))
    sequences = []
    for df in (edge, given):
        for r in decompose(df, BPE).withColumn("crc", F.crc32("ids")).collect():
            have[r["doc_id"], r["start"], r["length"], r["crc"], r["doc_tokens"]] += 1
            assert r["offset"] == 0 and 1 << r["bucket"] == r["length"] == len(r["ids"]) // 4
            sequences.append((df is edge, r["sequence_id"]))
    assert have == want
    assert len(set(sequences)) == len(sequences)


#: Thue-Morse words and their complements, on which every polynomial hash modulo 2^64 with an odd base fails.
def thue_morse(bits):
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(1 << bits))
    return one, one.translate(str.maketrans("ab", "ba"))


SPECIAL = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>  ", "  <|endoftext|>'s", "<|endoftext|", "a\n \n<|endoftext|>\n", "<<|endoftext|>>"]
HARD = [w for bits in (10, 11, 12) for w in thue_morse(bits)]


@pytest.mark.parametrize("plain", [False, True])
def test_packing_of_added_tokens_and_words_that_hashes_confuse(spark, plain):
    texts = SPECIAL + HARD + [f"{a} {b}" for a, b in zip(HARD[::2], HARD[1::2])]
    want = tokenized(texts, plain)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    have = {}
    for r in decompose(df, BPE, plain=plain).collect():
        have.setdefault(r["doc_id"], {})[r["start"]] = np.frombuffer(r["ids"], "<u4").tolist()
    assert [[x for _, part in sorted(have[i].items()) for x in part] for i in range(len(texts))] == want


def test_sentencepiece_of_words_that_hashes_confuse(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    df = spark.createDataFrame(list(enumerate(HARD)), "doc_id long, text string").coalesce(1)
    assert {r["doc_id"]: r["ids"] for r in encode(df, PIECES).collect()} == {i: library.encode(t) for i, t in enumerate(HARD)}


def test_the_cache_starts_anew_and_forgets_long_words():
    rng = __import__("random").Random(3)
    cache = WordCache(lambda words: [[ord(c) for c in w] for w in words], limit=40, most=300, long=12)
    for _ in range(60):
        words = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 16))) for _ in range(30)]
        text = "".join(words)
        ends = np.cumsum([len(w) for w in words])
        ids, sizes = cache.ids(text, np.array([ord(c) for c in text], np.uint32), ends - [len(w) for w in words], ends)
        assert ids.tolist() == [ord(c) for c in text] and sizes.tolist() == [len(w) for w in words]
        assert len(cache.keys) == cache.count <= 40 and cache.start[cache.count] <= 300 + 30 * 12


def test_buckets_are_written_apart(edge, tmp_path):
    write_buckets(decompose(edge, BPE, longest=64).drop("ids"), str(tmp_path / "b"))
    found = edge.sparkSession.read.parquet(str(tmp_path / "b"))
    assert found.filter("length <> 1 << bucket").count() == 0 and found.agg(F.max("length")).first()[0] == 64


def test_binary_pieces():
    counts, lengths = binary_pieces(np.array([0, 1, 7, 8, 29]), 8)
    assert counts.tolist() == [0, 1, 3, 1, 5] and lengths.tolist() == [1, 4, 2, 1, 8, 8, 8, 8, 4, 1]
    with pytest.raises(ValueError):
        decompose(None, BPE, longest=48)


def test_sentencepiece_equals_the_library_and_comes_back(edge, given):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = defaultdict(set)
    for i, t in [*[(r[0], r[1]) for r in edge_rows()], *[tuple(r) for r in given.collect()]]:
        texts[i].add(t or "")
    for df in (edge, given):
        for r in decode(encode(df, PIECES), PIECES).collect():
            matching = [t for t in texts[r["doc_id"]] if library.encode(t) == r["ids"]]
            assert matching and r["text"] == library.decode(r["ids"])


def test_the_pair_test_equals_merging():
    import random

    model, rng = Pieces(PIECES), random.Random(2)
    tokens = [t for t in model.parts if "▁▁" not in model.text[t]]
    for _ in range(4000):
        a, b = rng.choice(tokens), rng.choice(tokens)
        assert model.pair(a, b) == (model.merge(model.text[a] + model.text[b])[0] == [a, b]), (model.text[a], model.text[b])


def test_long_segments_without_a_blank():
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    model = Pieces(PIECES)
    for text in ("abc" * 4000, "the" * 3000 + "ing", " " * 999, "a" * 5000):
        segments = "▁" + text.replace(" ", "▁")
        assert model.encode(segments) == library.encode(text)


def test_empty(empty):
    assert decompose(empty, BPE).count() == 0
    assert decode(encode(empty, PIECES), PIECES).count() == 0
