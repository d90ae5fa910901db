"""Every registered query against its SQL in DuckDB."""
import pytest

import __spark_entry__ as contract
from testbed.registry import ORACLES, QUERIES
from tests.oracle import connect, mismatch

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    assert mismatch(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) is None


def test_sparse_totals_beyond_a_long(spark, tmp_path):
    keys = [1, 2, -3, 3_037_000, 3_037_001, 36_000_000, 36_000_000]
    orders = [(k, k % 2, 10.5 + i) for i, k in enumerate(keys)]

    def totals(some, name):
        spark.createDataFrame(some, "o_orderkey long, o_custkey long, o_totalprice double").write.parquet(f"{tmp_path}/{name}/orders.parquet")
        got = QUERIES["running_totals_sparse"](spark, f"{tmp_path}/{name}")
        want = {(c, k * k * 1000003): sum(int(p) for k2, c2, p in some if c2 == c and k2 * k2 <= k * k) for k, c, _ in some}
        assert {(c, int(place)): total for c, place, total in got.collect()} == want and got.count() == len(want)
        return dict(got.dtypes)["place"]

    assert totals(orders, "wide") == "decimal(38,0)"
    assert totals(orders[:3], "narrow") == "bigint"
