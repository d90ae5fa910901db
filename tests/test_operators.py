import datetime
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pavilion.operators import (
    best_per_group, density, distinct_values, drop_empty_rows, group_mean, histogram, joined_mean, keep_one,
    lookup_codes, lookup_left, mean_of_group_sums, non_finite_counts, ranked, require_keys, rows_where_zero, running_total,
    totals_by_column, value_counts,
)


def rows(df):
    return [tuple(r) for r in df.collect()]


def brute_running(data):
    """{(a, b, order): total} over rows (a, b, order, value), nulls first."""
    groups = defaultdict(list)
    for a, b, order, value in data:
        groups[a, b].append((order, value))
    out = {}
    for key, items in groups.items():
        for order, _ in items:
            upto = [v for o, v in items if (o is None or (order is not None and o <= order)) and v is not None]
            out[(*key, order)] = sum(upto) if upto else None
    return out


@pytest.mark.parametrize("block", [1, 3, 65_536])
def test_running_total_against_brute_force(spark, block):
    draw = random.Random(7)
    data = [
        (draw.choice([1, 2, None]), draw.choice(["x", None]), draw.choice([None, *range(-9, 30)]), draw.choice([None, 1, 2, 5]))
        for _ in range(600)
    ]
    df = spark.createDataFrame(data, "a int, b string, o int, v int")
    got = {(r.a, r.b, r.o): r.t for r in running_total(df, ["a", "b"], "o", "v", "t", block=block).collect()}
    assert got == brute_running(data)


def test_running_total_with_one_hot_group(spark):
    df = spark.range(60_000).selectExpr("if(id % 3 = 0, 0, id) as k", "cast(id % 1000 as int) as o", "1 as v")
    hot = running_total(df, ["k"], "o", "v", "t", block=64).filter("k = 0")
    assert hot.agg(F.max("t"), F.count("*")).first() == (20_000, 1000)


def test_running_total_orders_by_dates_and_refuses_lists(spark):
    df = spark.createDataFrame(
        [(1, datetime.date(2020, 1, 1), 2), (1, datetime.date(2021, 1, 1), 3), (1, datetime.date(2021, 1, 1), 4)],
        "k int, d date, v int")
    assert sorted(r.t for r in running_total(df, ["k"], "d", "v", "t", block=30).collect()) == [2, 9]
    with pytest.raises(TypeError):
        running_total(df.withColumn("d", F.array("d")), ["k"], "d", "v", "t")


#: An order value of the type for a whole number; several numbers share one.
ORDERED = {
    "timestamp": "timestamp_micros(cast(o * 7777777777 as bigint))", "timestamp_ntz": "cast(timestamp_micros(cast(o * 7777777777 as bigint)) as timestamp_ntz)",
    "boolean": "o > 0", "decimal(12,3)": "cast(o * 7.125 as decimal(12,3))", "decimal(38,9)": "cast(o as decimal(38,9)) * 1000000000000000000000",
    "double": "case o when 29 then double('NaN') when 28 then double('inf') when -9 then double('-inf') when 0 then -0.0D else o / 3D end",
    "float": "cast(o as float)", "string": "concat(case when o < 0 then 'a' else 'b' end, lpad(cast(o + 20 as string), 3, 'ü'))", "binary": "cast(cast(o + 50 as string) as binary)",
    "bigint": "cast(o as bigint) * 300000000000000000",
}


@pytest.mark.parametrize("kind", list(ORDERED))
@pytest.mark.parametrize("ranges", [4, 64])
def test_running_total_over_any_order(spark, kind, ranges):
    """Against one window per group, the whole of it in one task."""
    draw = random.Random(8)
    data = [(draw.choice([1, 1, 1, 2, None]), draw.choice([None, *range(-9, 30)]), draw.choice([None, 1, 2, 5])) for _ in range(900)]
    df = spark.createDataFrame(data, "a int, n int, v int").selectExpr("a", f"transform(array(n), o -> {ORDERED[kind]})[0] as o", "v")
    assert dict(df.dtypes)["o"].split("(")[0] == kind.split("(")[0]
    whole = df.selectExpr("a", "o", "sum(v) over (partition by a order by o) as t").distinct()
    if dict(df.dtypes)["o"] in ("double", "float"):
        whole = whole.withColumn("o", F.col("o") + 0.0)
    found = running_total(df, ["a"], "o", "v", "t", block=1 << 14, ranges=ranges)
    if dict(df.dtypes)["o"] in ("double", "float"):
        found = found.withColumn("o", F.col("o") + 0.0)
    text = F.col("o").cast("string")
    assert sorted(map(repr, rows(found.select("a", text, "t")))) == sorted(map(repr, rows(whole.select("a", text, "t"))))


def test_no_range_holds_more_than_its_share(spark):
    """One group has a third of all rows and every value is its own."""
    from pavilion.operators.running import _AT, _blocks_of_ranges

    df = spark.range(60_000).selectExpr("if(id % 3 = 0, 0, id) as k", "cast(xxhash64(id) as double) as o", "1 as v")
    steps = df.selectExpr("k", f"o as {_AT}")
    (block,) = _blocks_of_ranges(steps, df.schema["o"].dataType, ["k"], 64)
    sizes = [r["count"] for r in steps.groupBy(block.alias("b")).count().collect()]
    assert len(sizes) == 64 and max(sizes) < 2 * 60_000 / 64
    totals = running_total(df, ["k"], "o", "v", "t", ranges=64).filter("k = 0")
    assert totals.agg(F.max("t"), F.count_distinct("t")).first() == (20_000, 20_000)


def test_keep_one_does_not_depend_on_partitions(spark):
    df = spark.range(5000).selectExpr("id % 7 as k", "id % 11 as a", "cast(id % 13 as string) as b")
    first = sorted(rows(keep_one(df, ["k"])))
    assert first == sorted(rows(keep_one(df.repartition(13), ["k"])))
    assert first == [(k, 0, "0") for k in range(7)]
    assert sorted(rows(keep_one(df, ["k"], [F.desc("a")])))[0][1] == 10


def test_keep_one_of_many_rows_sorts_only_hot_keys_before_the_shuffle(spark, monkeypatch):
    for name, value in (("_SMALL", 1000), ("_HEAVY", 500), ("_PER_TASK", 400)):
        monkeypatch.setattr(f"pavilion.operators.dedup.{name}", value)
    draw = random.Random(3)
    ks = [0.0, -0.0, float("nan"), None, *[float(i) for i in range(1, 900)]]
    data = [(draw.choice(ks), draw.choice(["x", None]), draw.randrange(50), draw.choice([None, "p", "q"])) for _ in range(8000)]
    hot = [(7.0, "hot", 3 + i % 40, "r") for i in range(3000)]

    def want(some):
        key = lambda r: ("nan" if r[0] is not None and r[0] != r[0] else r[0], r[1])
        best = {}
        for r in sorted(some, key=lambda r: (-r[2], r[3] is not None, r[3] or "")):
            best.setdefault(key(r), (*key(r), *r[2:]))
        return sorted(best.values(), key=repr)

    for some, cuts in ((data, 0), (data + hot, 1)):
        df = spark.createDataFrame(some, "k double, s string, a int, b string").repartition(6)
        kept = keep_one(df, ["k", "s"], [F.desc("a")])
        text = kept._jdf.queryExecution().executedPlan().toString()
        assert text.count("row_number(), 1, Partial") == cuts and "Exchange hashpartitioning(k" in text
        got = [("nan" if r[0] is not None and r[0] != r[0] else r[0], *r[1:]) for r in rows(kept)]
        norm = lambda some: sorted(((r[0] + 0.0 if isinstance(r[0], float) else r[0], *r[1:]) for r in some), key=repr)
        assert norm(got) == norm(want(some))


def test_keep_one_treats_null_keys_as_equal(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), (1, None)], "k int, v int")
    assert sorted(rows(keep_one(df, ["k"])), key=repr) == [(1, None), (None, 1)]


def test_filters(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (None, 0), (None, None)], "a int, b int")
    assert rows(rows_where_zero(df, ["a", "b"])) == [(0, 0)]
    assert rows(require_keys(df, ["a"])) == [(0, 0), (0, 1)]
    assert drop_empty_rows(df).count() == 3


def test_value_counts(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("c",), ("Blank",), ("Blank",), ("Blank",)], "v string")
    assert rows(value_counts(df, "v")) == [("Blank", 3), ("b", 2), ("a", 1), ("c", 1)]
    assert rows(value_counts(df, "v", 2, exclude=["Blank"])) == [("b", 2), ("a", 1)]
    assert rows(value_counts(df, "v", by_value=True)) == [("Blank", 3), ("a", 1), ("b", 2), ("c", 1)]
    assert [r.v for r in distinct_values(df, "v").collect()] == ["Blank", "a", "b", "c"]


def test_null_order(spark):
    df = spark.createDataFrame([(2,), (None,), (1,)], "v int")
    assert rows(ranked(df, ["v"], [])) == [(None,), (1,), (2,)]
    assert rows(ranked(df, [F.desc("v")], [], 2)) == [(2,), (1,)]


def test_totals_of_empty_columns_are_zero(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a int, b int")
    assert sorted(rows(totals_by_column(df, ["a", "b"]))) == [("a", 3), ("b", 0)]
    assert sorted(rows(totals_by_column(df.limit(0), ["a", "b"]))) == [("a", 0), ("b", 0)]


def test_lookups_keep_unmatched_rows(spark):
    facts = spark.createDataFrame([(1, 10), (1, 20), (2, 5), (None, 1), (9, 7)], "k int, v int")
    names = spark.createDataFrame([(1, "one"), (2, None)], "id int, name string")
    got = rows(lookup_left(facts, names, "k", "id", ["name"]))
    assert sorted(got, key=repr) == sorted([(1, 10, "one"), (1, 20, "one"), (2, 5, None), (None, 1, None), (9, 7, None)], key=repr)
    coded = rows(lookup_codes(facts.select("k"), "k", names, "id", "name"))
    assert sorted(coded, key=repr) == sorted([("one",), ("one",), ("2",), (None,), ("9",)], key=repr)
    assert rows(joined_mean(facts, names, "k", "id", "name", "v", "m")) == [("one", 15.0)]
    assert sorted(rows(mean_of_group_sums(facts, names, "k", "id", "name", "v", "m")), key=repr) == [
        ("one", 30.0), (None, 13 / 3)]


def test_group_mean_drops_null_keys(spark):
    df = spark.createDataFrame([(1, 2), (1, 4), (None, 9), (2, None)], "k int, v int")
    assert sorted(rows(group_mean(df, ["k"], "v", "m"))) == [(1, 3.0), (2, None)]


def test_best_per_group_keeps_ties(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", 5), (1, "c", 4), (2, "d", 1), (2, "e", None)], "s int, n string, v int")
    assert sorted(r.n for r in best_per_group(df, ["s"], "v").collect()) == ["a", "b", "d"]
    unknown = spark.createDataFrame([(None, "x", 3), (None, "y", 2)], df.schema)
    assert sorted(r.n for r in best_per_group(df.union(unknown), ["s"], "v").collect()) == ["a", "b", "d", "x"]


def test_histogram_matches_numpy(spark):
    values = [int(v) for v in np.random.default_rng(3).normal(50, 20, 500)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v int")
    got = histogram(df, "v", 30).orderBy("bin").collect()
    counts, edges = np.histogram(values, 30)
    # Values that lie on an edge may fall on either side of it in floating point.
    assert sum(r["count"] for r in got) == 500 and len(got) == 30
    assert np.abs(np.cumsum([r["count"] for r in got]) - np.cumsum(counts)).max() <= 15
    assert np.allclose([r.lo for r in got] + [got[-1].hi], edges)


def test_histogram_of_equal_values_and_of_none(spark):
    same = spark.createDataFrame([(4,), (4,)], "v int")
    got = histogram(same, "v", 4).orderBy("bin").collect()
    assert [r["count"] for r in got] == [0, 0, 2, 0] and (got[0].lo, got[-1].hi) == (3.5, 4.5)
    assert [r["count"] for r in histogram(same.limit(0), "v", 4).collect()] == [0, 0, 0, 0]


def test_nan_and_infinities_are_counted_apart(spark):
    nan, inf = float("nan"), float("inf")
    values = [1.0, 2.0, 2.5, 5.0, nan, nan, inf, -inf, -inf, -inf, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = histogram(df, "v", 4).orderBy("bin").collect()
    assert [(r["bin"], r["count"]) for r in got] == [(0, 3), (1, 1), (2, 2), (3, 0), (4, 1), (5, 1), (6, 2)]
    assert [r["lo"] for r in got[:-1]] == [-inf, 1.0, 2.0, 3.0, 4.0, inf] and got[-1]["lo"] != got[-1]["lo"]
    finite = df.filter("v between 1 and 5")
    assert rows(density(df, "v", 10).orderBy("i")) == rows(density(finite, "v", 10).orderBy("i"))
    assert rows(non_finite_counts(df, "v")) == [(2, 1, 3)]
    none = df.filter("v is null or isnan(v) or v = double('inf')")
    assert [(r["bin"], r["count"]) for r in histogram(none, "v", 2).orderBy("bin").collect()] == [(1, 0), (2, 0), (3, 1), (4, 2)]
    assert density(none, "v", 10).count() == 0


@pytest.mark.parametrize("size", [40, 20_000])
def test_density_matches_numpy(spark, size):
    values = np.round(np.random.default_rng(5).normal(50, 20, size), 2)
    values[0] = 5000.0  # far out, so that most kernels reach few grid points
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = density(df, "v", 100).orderBy("i").collect()
    grid = np.linspace(values.min(), values.max(), 100)
    h = values.std(ddof=1) * size ** -0.2
    want = [np.exp(-0.5 * ((g - values) / h) ** 2).sum() / (size * h * np.sqrt(2 * np.pi)) for g in grid]
    assert np.allclose([r.x for r in got], grid) and np.allclose([r.density for r in got], want, rtol=1e-9, atol=1e-300)
    scaled = density(df, "v", 100, count_scale_bins=30).orderBy("i").first().density
    assert scaled == pytest.approx(want[0] * size * (values.max() - values.min()) / 30)


def test_density_without_spread_is_empty(spark):
    assert density(spark.createDataFrame([(4,), (4,)], "v int"), "v").count() == 0


def test_running_total_over_sparse_longs_has_small_windows(spark):
    """A third of all rows in one group, whose order values leave nearly every block of values to itself."""
    step = 1_000_003 * 7_000_001
    df = spark.range(60_000).selectExpr("if(id % 3 = 0, 0, id) as k", f"(id - 30000) * {step} as o", "1 as v")
    got = running_total(df, ["k"], "o", "v", "t", block=256)
    hot = got.filter("k = 0")
    assert hot.agg(F.max("t"), F.count("*")).first() == (20_000, 20_000)
    assert hot.filter(f"t <> (o div {step} + 30000) div 3 + 1").count() == 0
    # No window partition over more than its group's block: each Window of the plan but the top one has the block as a key.
    windows = re.findall(r"Window \[.*?\], \[([^\]]*)\], \[", got._jdf.queryExecution().optimizedPlan().toString())
    assert len(windows) > 3 and sum("__above" not in keys for keys in windows) == 1


def test_running_total_at_the_ends_of_long(spark):
    ends = [-(2**63), -(2**63) + 1, -1, 0, 1, 2**63 - 2, 2**63 - 1]
    df = spark.createDataFrame([(o, 1) for o in ends], "o long, v int")
    got = sorted((r.o, r.t) for r in running_total(df, [], "o", "v", "t").collect())
    assert got == [(o, i + 1) for i, o in enumerate(ends)]


def test_density_shuffles_grid_sums_only(spark):
    plan = density(spark.range(1000).selectExpr("cast(id as double) as v"), "v", 20)._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"Exchange hashpartitioning\((.*?)#", plan) == ["i"]
