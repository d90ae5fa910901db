"""URL filters against brute force."""
import random

import pytest
from pyspark.sql import functions as F

import llm.url_filter as url_filter
from llm.queries import QUERIES
from llm.url_filter import RULES, bloom_filter, filter_urls

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def cut(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    host, path = rest[:end], rest[end:]
    return host.translate(UPPER), path[: min((path.index(c) for c in "?#" if c in path), default=len(path))]


def brute(url, rules, listed=(), default="allow"):
    host, path = cut(url)
    fits = [
        (-len(h + p), -len(h), h + p, v) for h, p, v in rules
        if h and p is not None and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    if fits:
        return host, path, min(fits)[2], min(fits)[3]
    return host, path, None, "block" if (host, path) in listed else default


URLS = [
    None, "", "no scheme", "://", "http://", "http:///es/", "HTTP://Example.ORG/es/1", "http://example.org", "http://example.org?x=/es/", "http://example.org/es",
    "http://a.b.example.org/es/x?y#z", "http://badexample.org/es/x", "http://org/", "http://.org/", "http://org./x", "http://x.com/de/#/fr/", "http://x.com/fr/://y.org/",
    "http://x.com#/de/", "http://u@x.com:80/de/", "http://İ.ORG/İ", "x://y://example.org/es/", "http://example.org/en/1", "http://example.org/en/2", "http://a\nb.org/\n?",
    "http://" + "a." * 20_000 + "org/", "http://x.com/de/" + "p" * 100_000, "http://example.org/en/10", "http://example.org/en/10",
]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def pages(spark):
    rows = [*enumerate(URLS), (None, URLS[9]), (3, URLS[9])]
    df = spark.createDataFrame(rows, "page_id long, url string")
    for name in ("host", "path", "rule", "verdict", "key", "block", "best", "w0"):
        df = df.selectExpr("*", f"'clash' as {name}")
    return df.repartition(3), rows


def test_edges(spark, pages):
    df, rows = pages
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string").withColumn("key", F.lit("clash"))
    assert rows_of(filter_urls(df, rules)) == sorted(((i, *brute(u, RULES)) for i, u in rows), key=repr)


def test_ties_nulls_and_an_empty_list(spark, pages):
    df, rows = pages
    odd = [("b.org", "/", "block"), ("org", "/es/", "allow"), ("org", "/es/", "block"), ("COM", "/de/", "block"), (None, "/", "block"), ("", "/", "block"), ("com", None, "allow"), ("x.com", "/", None), ("x.com", "de", "block")]
    said = [(h.translate(UPPER), p or "", v) for h, p, v in odd if h and v]
    rules = spark.createDataFrame(odd, "host string, path string, verdict string")
    assert rows_of(filter_urls(df, rules, default="block")) == sorted(((i, *brute(u, said, default="block")) for i, u in rows), key=repr)
    assert {r["verdict"] for r in filter_urls(df, rules.limit(0)).collect()} == {"allow"}
    assert filter_urls(df.limit(0), rules).count() == 0


@pytest.mark.parametrize("most, broadcast", [(1 << 18, 100_000), (2, 0)])
def test_long_lists_and_full_filters(spark, monkeypatch, most, broadcast):
    """Thousands of rules and listed URLs, also with a filter so small that nearly all pass, and with shuffled joins."""
    monkeypatch.setattr(url_filter, "MOST_BLOCKS", most)
    monkeypatch.setattr(url_filter, "BROADCAST_ROWS", broadcast)
    rng = random.Random(4)
    host = lambda: ".".join(rng.choice("abc") * rng.randint(1, 2) for _ in range(rng.randint(1, 4)))
    path = lambda: "/" + "".join(rng.choice("xy/") for _ in range(rng.randint(0, 5)))
    rules = [(host() + ".net", path(), rng.choice(["allow", "block"])) for _ in range(1500)]
    listed = {(host() + ".com", path()) for _ in range(2000)}
    urls = [f"http://{host()}.{rng.choice(['net', 'com'])}{path()}{rng.choice(['', '?q', '#f'])}" for _ in range(4000)] + ["http://a.b.net/x/y"] * 2000
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = filter_urls(df, spark.createDataFrame(rules, "host string, path string, verdict string"), spark.createDataFrame(list(listed), "host string, path string"))
    assert rows_of(found) == sorted(((i, *brute(u, rules, listed)) for i, u in enumerate(urls)), key=repr)


def test_the_filter_stops_most_other_keys(spark):
    keys = spark.range(24_000).select(F.concat(F.lit("listed"), "id").alias("key"))
    bloom = bloom_filter(keys, 1000)
    masks = url_filter._all_set(url_filter._bits(F.col("key")))

    def passing(some):
        return some.withColumn("at", url_filter._block(F.col("key"), 1000)).join(bloom, F.col("at") == F.col("block")).filter(masks).count()

    assert bloom.count() == 1000 and passing(keys) == 24_000
    assert passing(spark.range(24_000).select(F.concat(F.lit("other"), "id").alias("key"))) < 24_000 * 0.05


def test_the_query_stays_in_the_jvm(spark):
    plan = QUERIES["op12_url_filter"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    for operator in ("Python", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan
