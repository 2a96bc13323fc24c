"""Every registered query against its SQL twin, on the small tables."""
import pytest

import __spark_entry__ as entry
from shardloom.suite import ORACLE, QUERIES
from tests.oracle import connect, differences


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_each_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, con, name):
    assert differences(QUERIES[name](spark, small), con, ORACLE[name]) == []


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["doc_id", "doc_json", "shard", "segment"] and df.count() > 0
