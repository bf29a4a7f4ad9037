"""Metrics against brute force; clustering and models by their invariants."""

import random

import pytest
from pyspark.sql import functions as F

from slotwise.operators import clusters as K
from slotwise.operators import metrics as X
from slotwise.operators import models as M
from slotwise.operators import profiles as Pr
from slotwise.operators import ranking
from slotwise.operators import search as S


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(11)
    rows = [(int(rng.random() < 0.3), round(rng.random(), 2)) for _ in range(600)]
    return rows, spark.createDataFrame(rows, "y int, p double")


@pytest.mark.parametrize("cell", [10**6, 7])
def test_area_and_average_precision(scored, cell, monkeypatch):
    monkeypatch.setattr(ranking, "ROWS_PER_CELL", cell)
    rows, df = scored
    pos, neg = [p for y, p in rows if y], [p for y, p in rows if not y]
    area = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert X.auc_value(df, "y", "p") == pytest.approx(area)
    ap, before = 0.0, 0.0
    for t in sorted({p for _, p in rows}, reverse=True):
        tp, n = sum(p >= t for p in pos), sum(p >= t for _, p in rows)
        ap += (tp / len(pos) - before) * tp / n
        before = tp / len(pos)
    assert X.average_precision(df, "y", "p").first()[0] == pytest.approx(ap)


def test_metric_row_agrees_with_its_parts(scored):
    rows, df = scored
    row = X.metric_row(df, "y", "p", "m", "f").first()
    part = X.threshold_metrics(df, "y", "p").first()
    assert row.brier == pytest.approx(sum((p - y) ** 2 for y, p in rows) / len(rows), abs=1e-4)
    assert row.precision_u050 == pytest.approx(part["precision"], abs=1e-4)
    assert row.recall_u050 == pytest.approx(part["recall"], abs=1e-4)
    assert row.f1_u050 == pytest.approx(part["f1"], abs=1e-4)


def test_no_positive_prediction_scores_zero(spark):
    df = spark.createDataFrame([(1, 0.1), (0, 0.2)], "y int, p double")
    row = X.threshold_metrics(df, "y", "p").first()
    assert (row["precision"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0)
    cells = {(r.real, r.predicho): r.n for r in X.confusion_matrix(df, "y", "p").collect()}
    assert cells == {(0, 0): 1, (0, 1): 0, (1, 0): 1, (1, 1): 0}


def blobs(spark, centres, size, spread, extra=(), seed=0):
    rng = random.Random(seed)
    rows = [(rng.gauss(x, spread), rng.gauss(y, spread)) for x, y in centres for _ in range(size)] + list(extra)
    return K.assemble(spark.createDataFrame(rows, "a double, b double"), ["a", "b"])


def test_tiny_clusters_are_rejected(spark):
    points = blobs(spark, [(0, 0), (8, 0), (0, 8)], 40, 0.25, [(14.0, 14.0), (15.0, 15.0)])
    diagnosis = K.choose_k(K.scan_k(points, range(2, 7), starts=5).table, 0.05).persist()
    assert K.chosen_k(diagnosis) == 3
    rejected = diagnosis.filter("NOT admisible").collect()
    assert rejected and all(r.cluster_mas_chico_pct < 0.05 for r in rejected)
    assert max(r.silhouette for r in rejected) > 0


def test_exactly_one_k_is_chosen(spark):
    points = blobs(spark, [(0, 0), (6, 6)], 30, 0.3, seed=1)
    diagnosis = K.choose_k(K.scan_k(points, range(2, 6), starts=3).table, 0.1).persist()
    assert diagnosis.filter("elegido").count() == 1 and K.chosen_k(diagnosis) == 2


def test_choice_without_any_admissible_k(spark):
    table = spark.createDataFrame([(2, 1.0, 0.5, 0.001), (3, 1.0, 0.7, 0.001)],
                                  "k int, inercia double, silhouette double, cluster_mas_chico_pct double")
    assert K.chosen_k(K.choose_k(table, 0.02)) == 3


def test_names_follow_the_profile(spark):
    rows = [(0, 0.9, 50.0, 100), (1, 0.1, 80.0, 50), (2, 0.05, 2.0, 900), (3, 0.01, 3.0, 10), (4, 0.02, 4.0, 20)]
    df = spark.createDataFrame(rows, "cluster int, pct_intl double, pmd_mediana double, total_vuelos long")
    got = {r.cluster: r.nombre for r in K.name_clusters(df).collect()}
    assert [got[i] for i in range(5)] == [*K.CLUSTER_NAMES, K.CLUSTER_NAMES[3]]


def test_projection_explains_variance(spark):
    points = K.standardise(blobs(spark, [(0, 0), (6, 6)], 30, 0.3).drop("features"), ["a", "b"])
    flat, variance = K.project_2d(K.assemble(points, ["z_a", "z_b"]))
    assert sum(variance) == pytest.approx(1.0) and variance[0] > 0.9
    assert abs(flat.agg(F.avg("pca_1")).first()[0]) < 1e-9


def test_critical_segment_is_the_latest(spark):
    rows = [(0, 10, 8.0, 0.1, 5.0, 0.0), (0, 30, 9.0, 0.2, 5.0, 0.0), (1, 60, 20.0, 0.4, 9.0, 0.1)]
    df = spark.createDataFrame(rows, "segmento int, n_operaciones long, hora_programada double, tasa_retraso double,"
                                     " variabilidad_min double, pct_severo double")
    got = {r.segmento: r for r in Pr.segment_summary(df).collect()}
    assert (got[1].es_segmento_critico, got[0].es_segmento_critico) == (1, 0)
    assert got[1].pct_vuelos == pytest.approx(0.6) and got[1].pct_slots == pytest.approx(1 / 3)


@pytest.fixture(scope="module")
def learnable(spark):
    rng = random.Random(2)
    rows = []
    for i in range(900):
        a, b, c = rng.random(), rng.random(), rng.random()
        year = 2022 + i % 4
        rows.append((i, year, a, b if i % 20 else None, c, int(a + 0.1 * rng.random() > 0.6)))
    return M.temporal_split(spark.createDataFrame(rows, "id int, anio int, a double, b double, c double, y int"), "anio")


def test_temporal_split(learnable):
    got = {r.tramo: r for r in learnable.groupBy("tramo").agg(F.min("anio").alias("lo"), F.max("anio").alias("hi")).collect()}
    assert (got["train"].hi, got["val"].lo, got["val"].hi, got["test"].lo) == (2023, 2024, 2024, 2025)


def test_search_finds_the_informative_set(learnable):
    sets = {"solo operacion": ["a"], "solo clima": ["b", "c"], "clima + operacion": ["a", "b", "c"]}
    grid = {"GradientBoosting": [{"max_iter": 3, "learning_rate": 0.3, "max_depth": 2, "min_samples_leaf": 5}],
            "RegresionLogistica": [{"C": 1.0}]}
    found = S.search_models(learnable, "y", "tramo", "id", sets, grid, repeats=1)
    metrics = {(r.features, r.modelo): r for r in found.metrics.collect()}
    assert len(metrics) == 6 and sum(r.seleccionado for r in metrics.values()) == 1
    assert metrics["solo operacion", "RegresionLogistica"].roc_auc > 0.95
    assert metrics["solo clima", "RegresionLogistica"].roc_auc < 0.65
    assert found.search.count() == 6
    importance = found.importance.collect()
    assert importance[0].feature == "a" and importance[0].importancia > 0.2
    assert abs(importance[-1].importancia) < 0.1


def test_forest_report(learnable):
    filled = learnable.fillna(0.5)
    out = M.train_forest(filled, ["a", "b", "c"], "y", "id", sample=800, trees=5, depth=4)
    row = out.report.first()
    assert (row.n_train, row.n_test) == (640, 160) and row.roc_auc > 0.95
    assert out.importance.first().feature == "a"
    assert out.confusion.agg(F.sum("n")).first()[0] == 160


def test_cross_validation_report(learnable):
    row = M.cross_validate_forest(learnable.fillna(0.5), ["a", "c"], "y", "id", folds=3, trees=3, depth=3).first()
    assert row.metodo == "StratifiedKFold-3" and 0.9 < row.roc_auc_mean <= 1 and 0 <= row.roc_auc_std < 0.1


def test_actual_time_is_not_a_feature():
    assert "min_dia" not in M.WEATHER_FEATURES + M.OPERATION_FEATURES
    assert "desvio_min" not in M.WEATHER_FEATURES + M.OPERATION_FEATURES


def test_registered_queries_take_the_published_settings(spark, sf, monkeypatch):
    """What each query passes on, filled up with the operator's defaults."""
    import inspect

    from slotwise.plans.registry import QUERIES
    from slotwise.plans import q_learning  # noqa: F401

    class Seen(Exception):
        pass

    def settings(query, module, name):
        real = getattr(module, name)

        def see(*args, **kwargs):
            bound = inspect.signature(real).bind(*args, **kwargs)
            bound.apply_defaults()
            raise Seen(bound.arguments)

        with monkeypatch.context() as patched:
            patched.setattr(module, name, see)
            with pytest.raises(Seen) as seen:
                QUERIES[query](spark, sf)
        return seen.value.args[0]

    assert settings("M2_M3_airport_clusters", K, "cluster_airports")["starts"] == 20
    got = settings("M5_k_scan", K, "scan_airports")
    assert (got["starts"], list(got["ks"])) == (20, list(range(2, 9)))
    for query, name in (("M7_flight_segments", "segment_flights"), ("M8_day_segments", "segment_days"),
                        ("M9_outcome_spread_by_k", "segment_days")):
        got = settings(query, K, name)
        assert (got["k_min"], got["k_max"], got["starts"]) == (2, 8, 20)
    for query in ("M10_M20_forest_report", "M13_gini_importance", "M10_M13_forest_checks"):
        got = settings(query, M, "train_forest")
        assert (got["trees"], got["depth"]) == (200, 12)
    got = settings("M12_cross_validation", M, "cross_validate_forest")
    assert (got["folds"], got["trees"], got["depth"]) == (5, 150, 12)
    for query in ("M15_M16_M17_grid_search", "M17_grid_rows", "M18_feature_set_metrics", "M18_test_area_pivot",
                  "M19_permutation_importance", "M15_M19_search_checks"):
        got = settings(query, S, "search_models")
        assert (got["grid"], got["repeats"]) == (M.GRID, 5)


SETS = {"solo operacion": ["a"], "solo clima": ["b", "c"], "clima + operacion": ["a", "b", "c"]}
TINY = {"GradientBoosting": [{"max_iter": 2, "learning_rate": 0.3, "max_depth": 1, "min_samples_leaf": 5}],
        "RegresionLogistica": [{"C": 1.0}, {"C": 0.1}]}


def test_a_search_goes_on_where_it_was_left(learnable, monkeypatch, tmp_path):
    """A driver that is lost after four fits loses no fit: the next one makes the other five and reads the rest."""
    real, fits = S.fit_candidate, []

    def counted(*args):
        if len(fits) == 4:
            raise RuntimeError("driver lost")
        fits.append(args[1])
        return real(*args)

    monkeypatch.setattr(S, "fit_candidate", counted)
    monkeypatch.setattr(S, "at_once", lambda spark, tasks: [task() for task in tasks])
    with pytest.raises(RuntimeError):
        S.search_models(learnable, "y", "tramo", "id", SETS, TINY, repeats=2, store=str(tmp_path))
    monkeypatch.setattr(S, "fit_candidate", lambda *args: fits.append(args[1]) or real(*args))
    first = S.search_models(learnable, "y", "tramo", "id", SETS, TINY, repeats=2, store=str(tmp_path))
    assert len(fits) == 9
    monkeypatch.setattr(S, "fit_candidate", None)
    again = S.search_models(learnable, "y", "tramo", "id", SETS, TINY, repeats=2, store=str(tmp_path))
    for a, b in zip((first.search, first.metrics, first.importance), (again.search, again.metrics, again.importance)):
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    left = {r.id: r.proba for r in first.scored.collect()}
    assert left == {r.id: r.proba for r in again.scored.collect()} and len(left) == 225


def test_a_search_works_out_what_is_asked_for(learnable, tmp_path):
    """The table of candidates needs neither report nor importances, and the report needs no importances."""
    one = {"RegresionLogistica": [{"C": 1.0}]}
    found = S.search_models(learnable, "y", "tramo", "id", {"clima + operacion": ["a", "b"]}, one, repeats=1, store=str(tmp_path))
    there = lambda: {p.name for p in tmp_path.iterdir()} & {"areas", "report", "importance-1"}
    assert found.search.count() == 1 and there() == {"areas"}
    assert found.metrics.count() == 1 and there() == {"areas", "report"}
    assert found.importance.count() == 2 and there() == {"areas", "report", "importance-1"}


def test_trees_on_counted_bins_are_those_of_the_rows(spark):
    """Spark's boosting over single rows, and the candidate's over counted sets of bins: equal probabilities."""
    from pyspark.ml.classification import GBTClassifier

    rng = random.Random(5)
    rows = [(a, b, int(rng.random() < 0.2 + 0.06 * a + 0.1 * (b > 3)))
            for a, b in ((rng.randrange(9), rng.randrange(7)) for _ in range(4000))]
    df = spark.createDataFrame([(float(a), float(b), y) for a, b, y in rows], "a double, b double, y int")
    binned = M.learnt_bins(df, ["a", "b"]).transform(df)
    few = S.counted(binned, ["b_a", "b_b"], ["y"])
    assert few.count() <= 9 * 7 * 2 and few.agg(F.sum("peso")).first()[0] == 4000
    config = {"max_iter": 6, "learning_rate": 0.3, "max_depth": 3, "min_samples_leaf": 150}
    plain = GBTClassifier(labelCol="y", featuresCol="features", seed=42, maxIter=6, stepSize=0.3, maxDepth=3,
                          minInstancesPerNode=150).fit(K.assemble(binned, ["b_a", "b_b"]))
    ours = M.fit_candidate("GradientBoosting", config, K.assemble(few, ["b_a", "b_b"]), "y", 4000)
    got, want = ({(r.a, r.b): r.proba for r in M.score(m, K.assemble(binned, ["b_a", "b_b"])).collect()} for m in (ours, plain))
    assert len(got) == 63 and got == pytest.approx(want) and len(set(got.values())) > 5


def test_a_fit_of_trees_goes_through_sets_of_bins(learnable, monkeypatch):
    real, seen = S.fit_candidate, []

    def see(algorithm, config, train, *args):
        seen.append((algorithm, train.count()))
        return real(algorithm, config, train, *args)

    monkeypatch.setattr(S, "fit_candidate", see)
    few = learnable.withColumns({c: F.round(c, 1) for c in "abc"})
    found = S.search_models(few, "y", "tramo", "id", SETS, TINY, repeats=1)
    rows = few.filter("tramo = 'train'").count()
    assert {n for a, n in seen if a == "RegresionLogistica"} == {rows}
    assert max(n for a, n in seen if a == "GradientBoosting") < rows
    assert min(n for a, n in seen if a == "GradientBoosting") <= 11 * 2
    assert found.importance.count() == 3


def test_bins_keep_few_values_apart_and_cut_many_at_quantiles(spark):
    df = spark.createDataFrame([(float(i % 3), float(i), 7.0) for i in range(6400)], "a double, b double, c double")
    bins = M.learnt_bins(df, ["a", "b", "c"])
    rows = bins.transform(df).groupBy("b_b").count().collect()
    assert len(rows) == 32 and all(abs(r["count"] - 200) <= 20 for r in rows)
    got = bins.transform(df).select("a", "b_a", "b_c").distinct().collect()
    assert sorted((r.a, r.b_a) for r in got) == [(0.0, 0.0), (1.0, 1.0), (2.0, 2.0)] and len({r.b_c for r in got}) == 1


def test_areas_of_all_candidates_are_those_of_each(learnable, spark):
    found = S.search_models(learnable, "y", "tramo", "id", SETS, TINY, repeats=0)
    row = found.metrics.filter("seleccionado").first()
    alone = X.metric_row(found.scored, "y", "proba", row.modelo, row.features).first()
    assert all(row[c] == alone[c] for c in alone.asDict())


def test_equal_rows_in_any_order_lead_to_one_store(spark):
    rows = [(i, i % 3, float(i)) for i in range(50)]
    make = lambda r: spark.createDataFrame(r, "id int, y int, a double")
    one = S.store_for(make(rows), "x")
    assert one == S.store_for(make(rows[::-1]).repartition(3), "x")
    assert one not in (S.store_for(make(rows), "y"), S.store_for(make(rows[1:]), "x"),
                       S.store_for(make(rows[:-1] + [(49, 1, 48.5)]), "x"))


def test_fits_run_together_and_a_failure_ends_them(spark):
    import threading

    from slotwise.operators.fits import at_once

    meet = threading.Barrier(3, timeout=60)
    assert at_once(spark, [lambda i=i: (meet.wait(), spark.range(i).count())[1] for i in range(3)]) == [0, 1, 2]

    def fails():
        raise ValueError("no")

    with pytest.raises(ValueError):
        at_once(spark, [fails, lambda: spark.range(10).count()])


def test_a_file_of_one_partition_is_dealt_over_the_cores(spark):
    from slotwise.operators.fits import dealt

    one, cores = spark.range(1000).coalesce(1), spark.sparkContext.defaultParallelism
    assert dealt(one, 1000, 1000 // cores // 2).rdd.getNumPartitions() == cores
    assert dealt(one, 1000, 500).rdd.getNumPartitions() == 2


def test_a_profile_is_worked_out_once(spark):
    """Moments, starts and results read the stored profile, not the log behind it."""
    profile = spark.range(50).groupBy((F.col("id") % 10).alias("k")).agg(F.sum("id").cast("double").alias("a"))
    plan = K._points(profile, ["a"], [])._jdf.queryExecution().toString()
    assert "ExistingRDD" in plan and "Aggregate" not in plan


def test_a_forest_scans_its_table_for_the_sample_only(learnable):
    """The stored sample: what is drawn from it reads no more of the table behind it."""
    ready = M.sampled(learnable.fillna(0.5), ["a", "c"], "y", "id", 100, 42)
    assert ready.count() == 100 and ready.columns == ["id", "y", "features"]
    assert "ExistingRDD" in ready._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [1, 2, 3, 7, 97, 1000, 4099])
def test_places_are_permuted(spark, n):
    keys = [(1, 0), (1, 1), (2, 0)]
    rows = spark.range(n).select("id", *[ranking.permuted_place(F.col("id"), n, *k).alias(f"p{i}") for i, k in enumerate(keys)]).collect()
    got = [[r[f"p{i}"] for r in sorted(rows)] for i in range(3)]
    assert all(sorted(p) == list(range(n)) for p in got)
    if n >= 97:
        assert got[0] != got[1] != got[2]
        assert sum(a == b for a, b in zip(got[0], range(n))) < 10
        assert len({(b - a) % n for a, b in zip(got[0], got[0][1:])}) > n // 4  # not a rotation


def test_large_numbers_of_places(spark):
    for n in (10**9 + 7, 10**13 + 37):
        a, b = ranking._sides(n)
        assert 0 <= a * b - n < 100
        p = spark.range(3).select(ranking.permuted_place(F.col("id") + n - 3, n, 5).alias("p"))
        assert all(0 <= r.p < n for r in p.collect())
