"""Every registered query against its SQL (or, without one, for rows), on the smallest tables."""

import os

import pytest

import oracle
from workload.registry import QUERIES, SQL

import __spark_entry__ as entry  # noqa: F401  (fills the registry)


@pytest.fixture(scope="module")
def con(sf):
    return oracle.connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf, name):
    assert oracle.compare(spark, con, QUERIES[name], SQL.get(name), sf) is None


def test_entry(spark):
    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("no test tables")
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
