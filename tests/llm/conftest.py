import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use within; tables may have columns of these names.
CLASHES = ["keep_id", "kept", "text_hash", "class", "n", "gram", "row", "spans", "hit", "norm", "score", "trust", "train", "held", "ids", "norm", "length"]
CLASHES = list(dict.fromkeys(CLASHES))


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


def edge_rows():
    """Nulls, empty, blank and very long texts, ties, repeated rows, copies and near copies, several scripts."""
    rng = random.Random(5)
    base = words(rng, 120)
    near = base.split()
    near[60] = "changed"
    long_ = words(rng, 40_000)
    texts = [
        None, "", " \t\n", base, base, base.replace(" ", "  "), base.upper(), " ".join(near), long_, "x" * 150_000, "one two", "one  two", "One Two", "trois mots ici",
        "日本語のテキスト 123", "Été à l'école — ça va?", "Straße über Öl. Nächste.", "don't we'll 'tis\n\n a  \t b'", "▁ a ▁▁ b", "    ", "?!", "\x00 nul \x1c",
    ]
    rows = [(i, t, "en" if i % 3 else "fr", f"s{i % 2}", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, base, None, None, None), (None, None, None, None, None), (200, words(rng, 5), None, None, 1), (-7, words(rng, 300), "de", "s", None)]
    return rows


@pytest.fixture(scope="module")
def edge(spark):
    """The table of edge cases, with extra columns of clashing names."""
    df = spark.createDataFrame(edge_rows(), DOCS)
    for name in CLASHES:
        df = df.selectExpr("*", f"'clash' as `{name}`")
    return df.repartition(4).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)
