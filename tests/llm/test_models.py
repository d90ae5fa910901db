"""Language, quality and toxicity: held-out results, calculations by hand, edge cases."""
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import language, quality, toxicity
from llm.ngrams import Sorted, hashes, rolling
from tests.llm import kneser_ney
from tests.llm.conftest import DOCS

FOLDER = "/root/testdata/sf0.01"


def test_sorted_hashes_find_what_they_hold():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 2**64, 5000, dtype=np.uint64))
    wanted = np.concatenate([keys[::3], rng.integers(0, 2**64, 500, dtype=np.uint64)])
    found = Sorted(keys).find(wanted)
    assert (keys[found[: len(keys[::3])]] == keys[::3]).all() and (found[len(keys[::3]) :] == -1).all()
    points = np.array([ord(c) for c in "abcd日本"], np.uint32)
    assert rolling(points, 3).tolist() == hashes(np.array(["abc", "bcd", "cd日", "d日本"])).tolist()


def test_language_probabilities_add_up_and_order_languages(spark):
    counts = defaultdict(Counter)
    for lang, text in (("aa", " abra cadabra abba "), ("bb", " xylo zyx oxo ")):
        for i in range(len(text) - 3):
            counts[lang][text[i : i + 4]] += 1
    model = kneser_ney.fit(counts)
    letters = sorted({c for c in " abracdxyloz"})
    for context in ("abr", "xyl", "zzz"):
        points, starts = language.codepoints([context + c for c in [*letters, "ü"]])
        entropies = [model.entropies(np.array([ord(x) for x in context + c], np.uint32), np.array([0, 4])) * 3 for c in [*letters, "ü"]]
        prefix = model.entropies(np.array([ord(x) for x in context], np.uint32), np.array([0, 3])) * 2
        for column in (0, 1):
            assert sum(math.exp(-(e[0, column] - prefix[0, column])) for e in entropies) == pytest.approx(1.0, abs=1e-4)


def test_language_is_right_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = language.op4_language(spark, FOLDER).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    right, every = found.filter("lang = lang_pred").count(), found.count()
    assert every > 250 and right / every >= 0.98
    assert found.filter("score < 0 or score > 1").count() == 0


def test_language_edges(spark, edge, empty):
    found = [(r["doc_id"], r["lang_pred"], r["score"]) for r in language.identify(edge, language.learn(edge)).collect()]
    assert len(found) == edge.count()
    by_id = dict((i, (p, s)) for i, p, s in found if i is not None)
    assert all(by_id[i] == ("und", 0.0) for i in (0, 1, 2, 19, 20)) and by_id[3][0] != "und"
    nothing = language.learn(empty)
    assert {r["lang_pred"] for r in language.identify(edge, nothing).collect()} == {"und"}
    assert language.identify(empty, nothing).count() == 0


def _brute_entropies(trained, texts, n=quality.ORDER):
    """The model by its definition, over dictionaries."""
    pad = lambda t: quality.PAD * (n - 1) + t
    grams = Counter(pad(t)[i : i + n] for t in trained for i in range(len(t)))
    orders = {n: dict(grams)}
    for k in range(n - 1, 0, -1):
        orders[k] = Counter(g[1:] for g in orders[k + 1])
    wanted = {pad(t)[i : i + n] for t in texts for i in range(len(t))}

    def discount(k, c):
        m = [sum(1 for v in orders[k].values() if v == x) for x in (1, 2, 3, 4)]
        y = m[0] / (m[0] + 2 * m[1]) if m[0] else 0.5
        j = min(c, 3)
        return min(j, max(0.1, j - (j + 1) * y * m[j] / m[j - 1])) if m[j - 1] else 0.5

    taken = {k: {g: discount(k, c) for g, c in orders[k].items()} for k in orders}

    def p(g):
        k = len(g)
        if k == 0:
            return 1 / (len(orders[1]) + 1)
        heads = [h for h in orders[k] if h[:-1] == g[:-1]]
        lower = p(g[1:])
        if not heads:
            return lower
        total = sum(orders[k][h] for h in heads)
        own = (orders[k][g] - taken[k][g]) / total if g in orders[k] else 0.0
        return own + sum(taken[k][h] for h in heads) / total * lower

    logs = {g: math.log(p(g)) for g in wanted}
    return [-sum(logs[pad(t)[i : i + n]] for i in range(len(t))) / len(t) if t else None for t in texts]


@pytest.mark.parametrize("hot", [quality.HOT, 7])
def test_perplexities_equal_the_definition(spark, monkeypatch, hot):
    monkeypatch.setattr(quality, "HOT", hot)
    rng = random.Random(4)
    syllables = ["ka", "to", "mi", "ra", "ne", "su"]
    texts = ["".join(rng.choice(syllables) + rng.choice(["", " "]) for _ in range(rng.randint(1, 20))) for _ in range(30)] + ["", "Zß!", "ka"]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS).repartition(3)
    trusted = docs.filter("doc_id < 20").select("doc_id")
    found = {r["doc_id"]: r for r in quality.perplexities(docs, trusted).collect()}
    trained = [t for i, t in enumerate(texts) if i < 20 and not found[i]["held"]]
    assert 10 <= len(trained) < 20
    for i, want in enumerate(_brute_entropies(trained, texts)):
        assert found[i]["entropy"] == (None if want is None else pytest.approx(want, rel=1e-9))


def test_quality_drops_junk_and_keeps_clean_text(spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    found = quality.op10_quality(spark, FOLDER).join(labels, "doc_id")
    kept = {(r["quality"], r["kept"]): r["count"] for r in found.groupBy("quality", "kept").count().collect()}
    assert kept[1, True] / (kept[1, True] + kept.get((1, False), 0)) >= 0.98
    assert kept[0, False] / (kept[0, False] + kept.get((0, True), 0)) >= 0.9


def test_quality_edges(spark, edge, empty):
    ids = edge.filter("doc_id in (3, 7, 8)").select("doc_id")
    found = quality.classify(edge, ids.union(ids)).collect()
    assert len(found) == edge.count()
    by_id = {r["doc_id"]: r for r in found}
    assert not by_id[0]["kept"] and not by_id[1]["kept"] and by_id[0]["perplexity"] is None
    none = quality.classify(edge, ids.limit(0)).collect()
    assert {r["kept"] for r in none if r["perplexity"] is not None} == {True}
    assert quality.classify(empty, ids).count() == 0


def test_quality_keeps_clean_text_of_languages_with_few_labels(spark):
    """A language without trusted documents, one with a few, one whose few held-out ones are its most regular."""
    rng = random.Random(6)
    text = lambda signs, n: " ".join("".join(rng.choice(signs) for _ in range(4)) for _ in range(n))
    scripts = {"en": "abcdef", "ja": [chr(0x4E00 + i) for i in range(900)], "el": "αβγδεζηθικλμν", "ru": "абвгдежзик", None: "ابتثجح"}
    rows = [(lang, text(signs, 30)) for lang, signs in scripts.items() for _ in range(80)]
    docs = spark.createDataFrame([(i, t, lang, "s", 0) for i, (lang, t) in enumerate(rows)], DOCS)
    # Of ru, those which the hash of the id holds out repeat two letters; of el, five documents are trusted; of ja and null none.
    held = F.pmod(F.xxhash64("doc_id"), F.lit(10)) == 0
    docs = docs.withColumn("text", F.when((F.col("lang") == "ru") & held, F.translate("text", "вгдежзик", "абабабаб")).otherwise(F.col("text")))
    junk = spark.createDataFrame([(1000, text("qwzx@#$%&", 60), "ru", "s", 0)], DOCS)
    trusted = docs.filter("lang in ('en', 'ru') or doc_id between 160 and 164").select("doc_id")
    found = {r["doc_id"]: r for r in quality.classify(docs.union(junk).repartition(3), trusted).collect()}
    assert {i for i, r in found.items() if not r["kept"]} == {1000}
    assert {r["lang"] for r in found.values() if r["limit"] is None} == {"ja", "el", None}


def test_noisy_or():
    assert toxicity.noisy_or(np.array([])) == 0.0
    assert toxicity.noisy_or(np.array([0.0, 0.0])) == pytest.approx(0.75)


def test_toxicity_finds_the_sentence(spark):
    rng = random.Random(9)
    plain = lambda: " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(6)) + "."
    rows, marks, bad = [], [], {}
    for i in range(400):
        sentences = [plain() for _ in range(6)]
        if i % 4 == 0:
            bad[i] = rng.randrange(6)
            sentences[bad[i]] = f"You are a vile {rng.choice(['rotter', 'rotten', 'rottish'])} thing."
        rows.append((i, " ".join(sentences), None, None, None))
        marks.append((i, 1, int(i in bad)))
    docs, labels = spark.createDataFrame(rows, DOCS), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    model = toxicity.learn(docs.filter("doc_id < 300"), labels)
    for r in toxicity.score(docs.filter("doc_id >= 300"), model).collect():
        assert r["predicted"] == int(r["doc_id"] in bad)
        text = rows[r["doc_id"]][1]
        assert [text[s["from"] : s["to"]].strip().startswith("You are") for s in r["offending"]] == [True] * (r["doc_id"] in bad)


def test_toxicity_score_by_hand():
    """Every sentence on its own, without the arrays."""
    import math
    import re

    model = toxicity.Model(-3.0, {"vile": 4.0, "^vile": 0.5, "^kind": -2.0, "fool": 1.5}, cut=0.3)
    for text in ("", "Vile! fool. Kind and VILE", "a fool\nvilest vilely", "kind " * 50 + "vile fool vile.", "no. words. here.", "İ VILE."):
        none = 1.0
        for part in re.findall(r"[^.!?\n]+[.!?]*", "".join(c.lower() if len(c.lower()) == 1 else c for c in text)):
            odds = -3.0
            for word in set(re.findall(r"\w+", part)):
                odds += model.weights.get(word, 0.0) + model.weights.get("^" + word[:4], 0.0) + model.weights.get("^" + word[:5], 0.0)
            none *= 1 - 1 / (1 + math.exp(-odds))
        p = 1 - none
        want = p * 0.7 / (p * 0.7 + (1 - p) * 0.3)
        assert model.document(np.array([z for *_, z in model.sentences(text)])) == pytest.approx(want)


def test_a_letter_that_grows_in_lower_case_changes_no_other():
    assert [(a, b, w) for a, b, w in toxicity.split("İ YOU ARE VILE. And İ")] == [(0, 15, {"İ", "you", "are", "vile"}), (15, 21, {"and", "İ"})]


def test_toxicity_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").filter("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    docs = spark.read.parquet(f"{folder}/documents.parquet").join(labels, "doc_id")
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    model = toxicity.learn(docs.filter(fold != 0).drop("toxic"), labels)
    rows = toxicity.score(docs.filter(fold == 0), model).join(labels, "doc_id").select("toxic", "predicted").collect()
    toxic, clean = [r["predicted"] for r in rows if r["toxic"]], [r["predicted"] for r in rows if not r["toxic"]]
    assert len(toxic) > 80 and sum(toxic) >= 0.88 * len(toxic) and sum(clean) <= 0.01 * len(clean)


def test_toxicity_edges(spark, edge, empty):
    labels = spark.createDataFrame([(3, 1, 1), (3, 0, 0), (8, 1, 0), (None, 1, 1), (9, None, None)], "doc_id long, quality int, toxic int")
    found = toxicity.score(edge, toxicity.learn(edge, labels)).collect()
    assert len(found) == edge.count() and all(0 <= r["score"] <= 1 for r in found)
    none = toxicity.learn(edge, labels.limit(0))
    assert {r["predicted"] for r in toxicity.score(edge, none).collect()} == {0}
    assert toxicity.score(empty, none).count() == 0


def test_language_learns_every_gram_of_every_language(spark, monkeypatch):
    """More than 100,000 distinct 4-grams in a language and more than 200 languages, against the model in memory."""
    monkeypatch.setattr(language, "HOT", 5)
    rng = np.random.default_rng(8)
    signs = lambda n: "".join(map(chr, rng.integers(0x4E00, 0x8000, n)))
    rows = [("zh", signs(40_000)) for _ in range(3)] + [(f"x{i:03}", " ".join([signs(3)] * 3)) for i in range(205)]
    rows += [(lang, " ".join(text[:7] for _ in range(2))) for lang, text in rows[:20]]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    counted = language.gram_counts(docs)
    counts = defaultdict(dict)
    for r in counted.collect():
        counts[r["lang"]][r["gram"]] = r["n"]
    assert len(counts) == 206 and len(counts["zh"]) > 100_000
    wanted, model = kneser_ney.fit(counts), language.tables(counted)
    assert model.languages == wanted.languages
    texts = [rows[0][1][:300], rows[2][1][-200:], rows[-30][1], rows[50][1], "a", "新しい x", None, "?"]
    scored = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    found = {r["doc_id"]: r["entropies"] for r in language._entropies(scored, model, ["doc_id"]).collect()}
    assert found[6] is None and found[7] is None
    for i, want in enumerate(wanted.entropies(*language.normalise(texts))[:6]):
        assert found[i] == pytest.approx(want.tolist(), rel=1e-4)
    known = language.learn(docs, calibrate=1 << 40)
    assert known.languages == wanted.languages
    found = {r["doc_id"]: r["lang_pred"] for r in language.identify(scored, known).collect()}
    assert [found[i] for i in range(4)] == ["zh", "zh", rows[-30][0], rows[50][0]]


def test_few_ngrams_are_not_dealt_over_many_tasks(spark):
    """A few rows in each of many shuffle partitions fill the disk with short files."""
    settings = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        cores = spark.sparkContext.defaultParallelism
        texts = [(f"some words {i * i}", "aa" if i % 2 else "bb") for i in range(40)]
        docs = spark.createDataFrame(texts, "text string, lang string")
        grams = language.checkpoint(quality.corpus_grams(docs.withColumn("train", F.lit(True))))
        assert quality.gram_probabilities(grams).rdd.getNumPartitions() <= cores
        model = language.tables(language.checkpoint(language.gram_counts(docs)))
        tables = [model.grams, model.contexts, language.gram_probabilities(model, language.checkpoint(language.corpus_grams(docs)))]
        assert max(t.rdd.getNumPartitions() for t in tables) <= cores
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
