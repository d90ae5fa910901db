"""Alignment of tokenizers against brute force with the libraries."""
import hashlib
from collections import Counter
from itertools import accumulate

import pytest

import llm.align as alignment
from llm.align import align
from llm.packing import tokenizer_file
from llm.queries import QUERIES
from tests.llm.conftest import edge_rows

BPE, PIECES = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
MORE = ["<|endoftext|> <s> </s> <unk> <0x41>", "a\u2581b", "\u2581", " ", "naïve 🙂🙂 日本", "\u0000", "ab" * 3000, "İstanbul\r\n\t x", "▁▁ x", "e\u0301" * 40]


def brute(rows):
    """Overlaps of all pairs of tokens, of every row."""
    import sentencepiece
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BPE)
    tokenizer.encode_special_tokens = True
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    spellings = {}

    def bytes_a(i):
        if i not in spellings:
            entry = tokenizer.id_to_token(i)
            table = {}
            n = 0
            for b in range(256):
                if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174:
                    table[chr(b)] = b
                else:
                    table[chr(256 + n)] = b
                    n += 1
            spellings[i] = bytes(table[c] for c in entry)
        return spellings[i]

    def bytes_b(i):
        piece = library.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if library.is_byte(i) else piece.replace("\u2581", " ").encode()

    found, counts = [], Counter()
    for i, text in rows:
        a = tokenizer.encode(" " + text, add_special_tokens=False).ids if text else []
        b = library.encode(text) if text else []
        parts_a, parts_b = [bytes_a(x) for x in a], [bytes_b(x) for x in b]
        if not text or b"".join(parts_a) != (" " + text).encode() or b"".join(parts_b) != (" " + text).encode():
            found.append((i, [], [], [], []))
            continue
        at_a, at_b = list(accumulate(map(len, parts_a), initial=0)), list(accumulate(map(len, parts_b), initial=0))
        pairs, first = [], 0
        for j in range(len(a)):
            while at_b[first + 1] <= at_a[j]:
                first += 1
            k = first
            while k < len(b) and at_b[k] < at_a[j + 1]:
                pairs.append((a[j], b[k]))
                k += 1
        both = sorted(set(at_a) & set(at_b))
        place_a, place_b = {x: k for k, x in enumerate(at_a)}, {x: k for k, x in enumerate(at_b)}
        groups = [(a[place_a[x] : place_a[y]], b[place_b[x] : place_b[y]]) for x, y in zip(both, both[1:])]
        counts.update(pairs)
        found.append((i, a, b, groups, pairs))
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    out = Counter()
    for i, a, b, groups, pairs in found:
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if a else ""
        out[i, len(a), len(b), len(groups), len(pairs), sum(counts[p] == most[p[1]] for p in pairs), sum(counts[p] for p in pairs), digest] += 1
    return out


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def rows_of(df):
    return Counter(tuple(r) for r in df.select(*COLUMNS).collect())


@pytest.mark.parametrize("hot", [1 << 20, 40, 0])
def test_edges(spark, edge, monkeypatch, hot):
    monkeypatch.setattr(alignment, "HOT", hot)
    more = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(MORE)], "doc_id long, text string")
    rows = [(r[0], r[1]) for r in edge_rows()] + [(1000 + i, t) for i, t in enumerate(MORE)]
    docs = edge.select("doc_id", "text", "kept", "row", "n").unionByName(more, allowMissingColumns=True)
    assert rows_of(align(docs, BPE, PIECES)) == brute(rows)


def test_small_slices(spark, monkeypatch):
    """Texts, links and counts that are handed on many times."""
    for name in ("SLICE", "LINKS", "HELD"):
        monkeypatch.setattr(alignment, name, 300)
    monkeypatch.setattr(alignment, "HOT", 200)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40)
    assert rows_of(align(docs, BPE, PIECES)) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_the_query_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert rows_of(QUERIES["op13_alignment"](spark, "/root/testdata/sf0.001")) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_empty(empty):
    assert align(empty, BPE, PIECES).count() == 0
