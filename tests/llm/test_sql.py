"""Every llm query that has SQL against DuckDB."""
import pytest

from llm.queries import ORACLES, QUERIES
from tests.oracle import connect, mismatch

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    assert mismatch(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name]) is None


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
