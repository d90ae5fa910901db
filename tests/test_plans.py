"""What the optimizer makes of the queries."""
import pytest

from pyspark.sql import functions as F

import __spark_entry__ as contract
from testbed.registry import QUERIES
from pavilion.operators import keep_one, lookup_left, ranked, require_keys, rows_where_zero

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


#: Queries of the density, whose tasks add up kernels in numpy.
IN_NUMPY = {"density200", "density_of_prices", "win_margin_density"}


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_query_leaves_the_jvm_or_crosses_tables(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for operator in ("Python", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin", "ExistingRDD"):
        assert operator not in text or (operator == "InArrow" and name in IN_NUMPY)


def test_filters_and_columns_reach_the_scan(spark):
    rows = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    text = plan(rows_where_zero(rows, ["l_linenumber", "l_suppkey"]).select("l_orderkey"))
    assert "EqualTo(l_linenumber,0)" in text and "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_linenumber:int>" in text
    assert "PushedFilters: [IsNotNull(l_orderkey), IsNotNull(l_partkey)]" in plan(require_keys(rows, ["l_orderkey", "l_partkey"]))


def test_duplicates_are_cut_before_the_shuffle(spark):
    text = plan(keep_one(spark.read.parquet(f"{SF_DIR}/lineitem.parquet"), ["l_orderkey"]))
    assert text.index("row_number(), 1, Final") < text.index("Exchange hashpartitioning") < text.index("row_number(), 1, Partial")


def test_top_k_needs_no_shuffle(spark):
    text = plan(ranked(spark.read.parquet(f"{SF_DIR}/orders.parquet"), ["o_totalprice"], ["o_orderkey"], 5))
    assert "TakeOrderedAndProject(limit=5" in text and "Exchange" not in text


@pytest.mark.parametrize("name, shuffles", [
    ("career_scorers", 1), ("top_strikers", 1), ("runs_per_ball", 2), ("extras_totals", 1), ("audit_ball_by_ball", 2),
])
def test_shuffles(spark, name, shuffles):
    text = plan(contract.queries()[name](spark, SF_DIR))
    assert text.count("+- Exchange") <= shuffles


def test_names_are_looked_up_for_the_rows_kept(spark):
    text = plan(contract.queries()["career_scorers"](spark, SF_DIR))
    assert text.count("TakeOrderedAndProject") == 2


def test_a_running_total_scans_once(spark):
    totals = contract.queries()["running_totals_by_date"](spark, SF_DIR)
    totals.collect()
    final = plan(totals).split("Initial Plan")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


@pytest.fixture
def small_partitions(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "40",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("grouped", [True, False])
def test_a_hot_lookup_key_is_split(spark, small_partitions, grouped):
    rows = spark.range(0, 300_000, 1, 8).selectExpr("if(id % 3 = 0, 0, id) as k", "xxhash64(id) as v")
    names = rows.groupBy("k").agg(F.max("v").alias("name")) if grouped else rows.dropDuplicates(["k"]).repartition(4).withColumnRenamed("v", "name")
    found = lookup_left(rows, names, "k", "k", ["name"], split_keys=grouped)
    total = found.agg(F.count("*"), F.count("name"), F.max(F.xxhash64("v", "name")))
    assert total.collect()[0][:2] == (300_000, 300_000)
    assert "SortMergeJoin(skew=true)" in plan(total)
