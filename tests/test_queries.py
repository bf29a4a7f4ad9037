"""Every registered query with its SQL, on the smallest stored tables, and rules for all of them."""

import pytest

import __spark_entry__ as entry_points
from oracle import compare, connect

CHECKED = sorted(entry_points.oracle_sql())


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_its_sql(spark, con, sf, name):
    df = entry_points.queries()[name](spark, sf)
    if name[0] in "FPIJAWLUX":
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "EvalPython" not in plan and "InArrow" not in plan and "InPandas" not in plan
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    problems = compare(spark, con, lambda *_: df, entry_points.oracle_sql()[name], sf)
    spark.catalog.clearCache()
    # A threshold meant for larger tables may leave nothing here; both sides then agree on nothing.
    assert [p for p in problems if p != "no rows"] == []


def test_every_check_belongs_to_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_flagship_gives_rows(spark):
    out = entry_points.entry(spark)
    assert out.columns == ["variable", "rango", "n_vuelos", "tasa_retraso", "puntos_vs_base"]
    assert out.count() > 0
