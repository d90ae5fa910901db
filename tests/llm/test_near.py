"""N-gram Jaccard join, repeated strings and components against brute force."""
import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from llm.components import components
from llm.jaccard import near_duplicates
from llm.repeats import Rolling, remove_repeats
from tests.llm.conftest import edge_rows, words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(found[k : k + 5]) for k in range(max(1, len(found) - 4))) if found else frozenset()


def brute_components(rows):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    least = defaultdict(list)
    for j, (i, _) in enumerate(rows):
        least[find(j)].append(i)
    smallest = {r: min((i for i in ids if i is not None), default=None) for r, ids in least.items()}
    return Counter((i, len(sets[j]), smallest[find(j)]) for j, (i, _) in enumerate(rows))


def components_of(df):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_duplicates(df).collect())


def test_jaccard_edges(edge):
    assert components_of(edge) == brute_components([r[:2] for r in edge_rows()])


def test_words_that_polynomial_hashes_confuse(spark):
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(4096))
    two = one.translate(str.maketrans("ab", "ba"))
    rows = [(i, t) for i, t in enumerate((one[:1024], two[:1024], one[:2048], two[:2048], one, two))]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert components_of(df) == brute_components(rows)
    data = np.frombuffer((one + two).encode(), np.uint8)
    rolling = Rolling(data)
    for n in (64, 256, 1024, 4096):
        both = rolling.of(np.array([0, 4096]), np.array([n, 4096 + n]))
        assert both[0] != both[1]
        at = np.arange(len(data) - n + 1)
        hashes = rolling.of(at, at + n)
        assert len(set(hashes.tolist())) == len({data[i : i + n].tobytes() for i in at.tolist()})


def test_jaccard_families_of_every_similarity(spark):
    rng = random.Random(11)
    rows = []
    line = words(rng, 30)  # a passage that very many documents share
    for family in range(12):
        base = words(rng, rng.randint(12, 160)).split()
        for copy in range(25):
            own = list(base)
            for _ in range(rng.randint(0, len(base) // 18 + 1)):
                own[rng.randrange(len(own))] = words(rng, 1)
            rows.append((len(rows), (" ".join(own) + (" " + line if family % 2 else ""))))
    rows += [(len(rows) + i, words(rng, 8) + " " + line) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert components_of(df) == brute_components(rows)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 40)] + [(300, 299), (299, 300)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 140)}, 299: 299, 300: 299}


def brute_repeats(texts, length):
    data = [(t or "").encode() for t in texts]
    times = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        edges = np.zeros(len(b) + 1, np.int64)
        for i in range(len(b) - length + 1):
            if times[b[i : i + length]] > 1:
                edges[i] += 1
                edges[i + length] -= 1
        inside = np.cumsum(edges[:-1]) > 0
        turns = np.flatnonzero(np.diff(np.r_[False, inside, False])).tolist()
        out.append((len(b), tuple(zip(turns[::2], turns[1::2])), hashlib.sha256(np.frombuffer(b, np.uint8)[~inside].tobytes()).hexdigest()))
    return out


def repeats_of(df, *args):
    return Counter(
        (r["doc_id"], r["n_bytes"], tuple((s["start"], s["end"]) for s in r["removed"]), hashlib.sha256(bytes(r["kept"])).hexdigest())
        for r in remove_repeats(df, *args).collect()
    )


def test_repeats_edges(edge):
    rows = edge_rows()
    assert repeats_of(edge, 50) == Counter((r[0], *b) for r, b in zip(rows, brute_repeats([r[1] for r in rows], 50)))


@pytest.mark.parametrize("group", [8192, 3, 40])
def test_repeats_of_shared_lines_runs_and_overlaps(spark, group):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(700)) for _ in range(6)]
    line = "This very common line of text occurs in a large part of all the documents there are, with other text around it. "
    texts = [
        "x" * 199, "y" * 200, "z" * 1000, "é" * 300, base[0], base[0], base[1][:300] + "!" + base[1][300:], base[1],
        base[2][100:400] + base[3][50:249] + base[4][:220], base[2], base[3], base[4], base[5] + base[5][200:420], "ab" * 500, "ba" * 300, "日本語" * 120,
    ]
    texts += [words(rng, 25) + line * rng.choice([1, 1, 2, 3]) + words(rng, 25) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    assert repeats_of(df, 200, group) == Counter((i, *b) for i, b in enumerate(brute_repeats(texts, 200)))


def test_kept_text_has_whole_characters(spark):
    shared = "é" * 150
    df = spark.createDataFrame([(1, "aé" + shared), (2, shared + "b"), (3, None)], "doc_id long, text string")
    found = {r["doc_id"]: r["kept"] for r in remove_repeats(df, as_text=True).collect()}
    assert found == {1: "a", 2: "b", 3: ""}


def test_empty(empty):
    assert near_duplicates(empty).count() == 0 and remove_repeats(empty).count() == 0
