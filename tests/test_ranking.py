"""Cell-wise ranks and quantiles against plain Python, with cells forced to be tiny."""

import random

import pytest
from pyspark.sql import functions as F

from slotwise.operators import filters, ranking


def linear_quantile(values, p):
    values = sorted(values)
    at = p * (len(values) - 1)
    low = int(at)
    high = min(low + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * (at - low)


@pytest.fixture(scope="module")
def skewed(spark):
    """One key with a third of the rows, one value repeated for a third of that key, long tails."""
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else f"k{i % 17}"
        value = 7.5 if key == "hot" and i % 9 == 0 else round(rng.lognormvariate(0, 3), 3)
        rows.append((key, value))
    rows += [("hot", None), (None, 1.0), ("empty", None)]
    return rows, spark.createDataFrame(rows, "k string, v double")


# Every group its own bracket; narrow brackets in large groups; both again in cells.
WAYS = [{}, {"accuracy": 100}, {"accuracy": 100, "rows_per_cell": 400}]


@pytest.mark.parametrize("way", WAYS)
def test_quantiles_per_key(skewed, way):
    rows, df = skewed
    probs = [0.0, 0.05, 0.25, 0.5, 0.9, 1.0]
    names = [f"q{i}" for i in range(len(probs))]
    got = ranking.exact_quantiles(df, "v", probs, names, keys=["k"], **way).collect()
    groups = {}
    for k, v in rows:
        if k is not None and v is not None:
            groups.setdefault(k, []).append(v)
    assert {r.k for r in got} == set(groups)
    for r in got:
        for p, n in zip(probs, names):
            assert r[n] == pytest.approx(linear_quantile(groups[r.k], p), rel=1e-12)


@pytest.mark.parametrize("way", WAYS)
def test_quantiles_of_everything(skewed, way):
    rows, df = skewed
    values = [v for _, v in rows if v is not None]
    row = ranking.exact_quantiles(df, "v", [0.1, 0.5], ["a", "b"], **way).first()
    assert row.a == pytest.approx(linear_quantile(values, 0.1))
    assert row.b == pytest.approx(linear_quantile(values, 0.5))


def test_brackets_keep_few_rows_of_a_large_group(spark):
    """Random normal values, all distinct: the exact answer, from a small part of the rows."""
    df = spark.range(60_000).select(F.randn(7).alias("v")).persist()
    values = [r.v for r in df.collect()]
    probs = [0.001, 0.25, 0.5, 0.999]
    row = ranking.exact_quantiles(df, "v", probs, ["a", "b", "c", "d"], accuracy=1000).first()
    for p, got in zip(probs, row):
        assert got == pytest.approx(linear_quantile(values, p), rel=1e-12)


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_in_cells(skewed, descending):
    rows, df = skewed
    counts = df.na.drop().groupBy("k", "v").agg(F.count("*").alias("n"))
    got = ranking.running_totals(counts, "v", {"cum": F.col("n")}, keys=["k"], descending=descending, rows_per_cell=25)
    per_key = {}
    for k, v in rows:
        if k is not None and v is not None:
            per_key.setdefault(k, []).append(v)
    found = got.collect()
    assert len(found) == counts.count()
    for r in found:
        same = per_key[r.k]
        assert r.cum == sum(1 for x in same if (x >= r.v if descending else x <= r.v))


def test_ranks_number_every_row_once(spark):
    df = spark.range(1000).withColumn("h", ranking.stable_order("id"))
    got = ranking.with_rank(df, "h", rows_per_cell=30).orderBy("h").collect()
    assert [r["rank"] for r in got] == list(range(1, 1001))


def test_more_cells_than_a_cell_has_rows(spark):
    df = spark.range(200).select(F.col("id").alias("v"), (F.col("id") % 7).alias("n"))
    got = ranking.running_totals(df, "v", {"cum": F.col("n")}, rows_per_cell=4).orderBy("v").collect()
    total = 0
    for r in got:
        total += r.n
        assert r.cum == total


def test_several_columns_in_one_go(spark):
    df = spark.createDataFrame([(float(i), float(i * i) if i % 2 else None) for i in range(11)], "a double, b double")
    got = {r.variable: r.m for r in ranking.column_quantiles(df, ["a", "b"], [0.5], ["m"]).collect()}
    assert got == {"a": 5.0, "b": 25.0}


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None, "x")], "v double, k string")
    assert [r for r in ranking.exact_quantiles(df, "v", [0.5], ["m"]).collect() if r.m is not None] == []
    assert ranking.exact_quantiles(df, "v", [0.5], ["m"], keys=["k"]).count() == 0


@pytest.mark.parametrize("accuracy", [10_000, 50])
def test_limits_split_at_exact_ranks(spark, accuracy):
    df = spark.range(3000).select(ranking.stable_order("id").alias("h"), (F.col("id") % 3 == 0).alias("k"))
    found = {r.k: r for r in ranking.rank_limits(df, "h", [0.25, 0.9], ["k"], accuracy=accuracy).collect()}
    for k in (True, False):
        part = sorted(r.h for r in df.filter(F.col("k") == k).collect())
        for i, share in enumerate((0.25, 0.9)):
            assert sum(h <= found[k][f"_limit{i}"] for h in part) == round(share * len(part)) == found[k][f"_upto{i}"]


def test_missing_strata_are_kept(spark):
    df = spark.range(100).withColumn("y", F.when(F.col("id") % 10 > 0, F.col("id") % 2))
    parts = filters.stratified_parts(df, "id", "y", [0.8, 0.2])
    assert parts.count() == 100 and parts.filter("y is null and part = 0").count() == 8


def test_no_exchange_carries_the_rows(spark):
    df = spark.range(1000).withColumn("wide", F.repeat(F.lit("x"), 100)).withColumn("y", F.col("id") % 2)
    plan = filters.stratified_parts(df, "id", "y", [0.8, 0.2])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_large_path_never_orders_a_whole_group(spark):
    df = spark.range(1000).withColumn("h", ranking.stable_order("id"))
    plan = ranking.with_rank(df, "h", rows_per_cell=30)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line and "_before" not in line]
    assert windows and all("_cell" in line for line in windows)


def test_sample_is_exact_stable_and_whole(spark, sf, monkeypatch):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    a = filters.sample_exactly(li, "l_orderkey", 1000)
    assert a.count() == 1000
    monkeypatch.setattr(ranking, "ROWS_PER_CELL", 100)
    b = filters.sample_exactly(li.repartition(5), "l_orderkey", 1000)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert filters.sample_exactly(li, "l_orderkey", 10**7).count() == li.count()


def test_sample_splits_copies_of_one_row(spark):
    df = spark.range(10).select((F.col("id") * 0).alias("k"), F.lit("x").alias("v"))
    assert filters.sample_exactly(df, "k", 4).count() == 4


def test_strata_keep_their_shares(spark, monkeypatch):
    df = spark.range(1000).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    for cell in (10**6, 50):
        monkeypatch.setattr(ranking, "ROWS_PER_CELL", cell)
        parts = filters.stratified_parts(df, "id", "y", [0.8, 0.2]).persist()
        got = {(r.y, r.part): r.n for r in parts.groupBy("y", "part").agg(F.count("*").alias("n")).collect()}
        assert got == {(0, 0): 720, (0, 1): 180, (1, 0): 80, (1, 1): 20}
        folds = filters.stratified_parts(df, "id", "y", [0.2] * 5, name="f")
        sizes = {(r.y, r.f): r.n for r in folds.groupBy("y", "f").agg(F.count("*").alias("n")).collect()}
        assert set(sizes.values()) == {180, 20} and len(sizes) == 10
