"""The queries that SQL can express, at two sizes, and that each query reads its whole table."""

import pytest

import __spark_entry__ as entry_points
from oracle import compare, connect

NAMES = sorted(n for n in entry_points.oracle_sql() if n.startswith(("op", "pipeline")) and n[2:3].isdigit())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_its_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    problems = compare(spark, connect(sf), entry_points.queries()[name], entry_points.oracle_sql()[name], sf)
    assert problems == []
