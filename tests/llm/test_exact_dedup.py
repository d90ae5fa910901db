import hashlib
from collections import Counter, defaultdict

import pytest

from llm import exact_dedup
from llm.exact_dedup import exact_groups
from tests.llm.conftest import edge_rows


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups["".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")].append((-len(t or ""), i is None, i or 0, i))
    out = Counter()
    for norm, members in groups.items():
        members.sort(key=lambda m: m[:3])
        for place, m in enumerate(members):
            out[m[3], members[0][3], len(members), place == 0, hashlib.sha256(norm.encode()).hexdigest()] += 1
    return out


def result(df):
    return Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in df.collect())


def test_edges(edge):
    assert result(exact_groups(edge)) == brute([r[:2] for r in edge_rows()])


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_a_text_that_most_rows_share_spreads_over_ranges(spark, monkeypatch, most):
    monkeypatch.setattr(exact_dedup, "BROADCAST_ROWS", most)
    rows = [(i, "same text" + " " * (i % 3)) for i in range(3000)] + [(9000 + i, f"own {i}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert result(exact_groups(df)) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_empty(empty):
    assert exact_groups(empty).count() == 0
