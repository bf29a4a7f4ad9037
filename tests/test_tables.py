"""Weather, joins, quality tables, sources and sinks."""

import gzip
import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from slotwise.operators import enrich, filters, metrics, prepare, profiles, quality, ranking, timetable, weather
from slotwise.session import scratch_path
from slotwise.sources import files, readers, sinks


@pytest.fixture(scope="module")
def daily(spark):
    rows = [
        (date(2024, 3, 1), 10.0, 5.0, 15.0, 0.0, None, 170.0, 20.0, None, 1010.0, None),
        (date(2024, 3, 5), 12.0, 7.0, 18.0, float("nan"), None, 260.0, 20.0, None, 1015.0, None),
        (date(2024, 3, 6), 11.0, 6.0, 16.0, 20.0, None, 350.0, 20.0, None, 1020.0, None),
    ]
    return spark.createDataFrame(rows, readers.WEATHER_SCHEMA)


def test_weather_features(daily):
    got = weather.prepare_weather(daily).orderBy("fecha_cruce").collect()
    assert list(got[0].asDict()) == weather.WEATHER_COLUMNS
    assert [r.prcp for r in got] == [0.0, 0.0, 20.0]
    assert [r.dia_lluvioso for r in got] == [0, 0, 1]
    assert [round(r.viento_cruzado, 6) for r in got] == [0.0, 20.0, 0.0]
    assert [r.amplitud_termica for r in got] == [10.0, 11.0, 10.0]


def test_only_empty_columns_are_dropped(daily):
    assert prepare.drop_empty_columns(daily, ["snow", "wpgt", "tsun", "prcp"]).columns == [
        "fecha", "tavg", "tmin", "tmax", "prcp", "wdir", "wspd", "pres"]


def test_weather_join_keeps_every_flight(spark, daily):
    rows = [(datetime(2024, 3, d, 11, m), "LAN", "61", "A", False) for d, m in ((1, 0), (8, 5), (15, 10))]
    f = spark.createDataFrame(
        rows, "dt_operacion timestamp, aerolinea_dgac string, numero_vuelo string, tipo_operacion string, es_internacional boolean")
    out = weather.join_weather(timetable.delay_target(f), weather.prepare_weather(daily))
    assert out.count() == 3 and out.filter("tavg IS NOT NULL").count() == 1
    cover = weather.weather_coverage(out).first()
    assert cover.aviso and cover.sin_clima == pytest.approx(2 / 3)


def test_monthly_join_matches_missing_keys(spark):
    left = spark.createDataFrame([("A", 202401, "I"), ("A", 202401, None), ("B", 202401, "D")],
                                 "aeropuerto_oaci string, mes_id long, internacional_domestico string")
    right = spark.createDataFrame([("A", 202401, "I", 5.0), ("A", 202401, None, 7.0)],
                                  "aeropuerto_oaci string, mes_id long, internacional_domestico string, cnt_operaciones double")
    got = {tuple(r)[:3]: r.cnt_operaciones for r in enrich.join_monthly_operations(left, right).collect()}
    assert got == {("A", 202401, "I"): 5.0, ("A", 202401, None): 7.0, ("B", 202401, "D"): None}
    assert enrich.repeated_keys(right, enrich.OPS_KEYS).count() == 0


def test_as_of_join_against_a_loop(spark):
    import random

    rng = random.Random(5)
    at = lambda h, m: datetime(2024, 1, 1 + h // 24, h % 24, m)
    left = [(i, rng.choice("XYZ"), at(rng.randrange(96), rng.randrange(60))) for i in range(300)]
    right = [(s, at(h, 0), float(h)) for s in "XY" for h in range(0, 96) if rng.random() < 0.3]
    l = spark.createDataFrame(left, "id int, s string, t timestamp")
    r = spark.createDataFrame(right, "s string, rt timestamp, v double")
    got = {x.id: x.v for x in enrich.as_of_join(l, r, "s", "t", "rt", ["v"]).collect()}
    assert len(got) == 300
    for i, s, t in left:
        before = [(rt, v) for rs, rt, v in right if rs == s and rt <= t]
        assert got[i] == (max(before)[1] if before else None)


def test_imputation_falls_back_to_the_global_median(spark):
    rows = [("a", 1.0), ("a", 3.0), ("a", None), ("b", None), (None, None), ("c", 10.0)]
    df = spark.createDataFrame(rows, "m string, w double")
    got = sorted((r.m or "", r.w, r.w_fue_imputado) for r in prepare.impute_group_median(df, "w", "m").collect())
    assert got == [("", 3.0, 1), ("a", 1.0, 0), ("a", 2.0, 1), ("a", 3.0, 0), ("b", 3.0, 1), ("c", 10.0, 0)]


def test_codes_are_alphabetical(spark, monkeypatch):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("a",)], "c string")
    for limit in (10, 2):  # one cell, then two
        monkeypatch.setattr(ranking, "ROWS_PER_CELL", limit)
        got = {r.c: r.x for r in prepare.category_code(df, "c", "x").collect()}
        assert got == {"a": 0, "b": 1, "c": 2, None: -1}
        named = {r.c: r.x for r in prepare.label_code(df, "c", "x").collect()}
        assert named == {"a": 0, "b": 1, "c": 2, None: 3}


def test_scope_cut_reaches_the_scan(spark):
    path = scratch_path(spark, "log")
    rows = [("SCTE", datetime(2021, 5, 1, 10), "U", 1), ("SCTE", datetime(2019, 5, 1), "U", 2), ("SCEL", datetime(2021, 5, 1), "U", 3),
            ("SCTE", datetime(2026, 1, 1), "U", 4), ("SCTE", datetime(2021, 5, 1), "N", 5), ("SCTE", datetime(2020, 1, 1), "U", 6)]
    spark.createDataFrame(rows, "aeropuerto_oaci string, dt_operacion timestamp, actividad_cod string, id int").write.parquet(path)
    cut = filters.scope_cut(spark.read.parquet(path))
    assert sorted(r.id for r in cut.collect()) == [1, 6]
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = cut.select("id")._jdf.queryExecution().executedPlan().toString()
    for part in ("EqualTo(aeropuerto_oaci,SCTE)", "GreaterThanOrEqual(dt_operacion", "LessThan(dt_operacion"):
        assert part in plan


def test_scope_and_clock_of_another_zone(spark):
    """Midnight in Santiago is 03:00 UTC in summer; the session runs on UTC."""
    rows = [("SCTE", datetime(2020, 1, 1, 2, 59), "U"), ("SCTE", datetime(2020, 1, 1, 3, 0), "U")]
    df = spark.createDataFrame(rows, "aeropuerto_oaci string, dt_operacion timestamp, actividad_cod string")
    cut = filters.scope_cut(df, zone="America/Santiago")
    assert cut.count() == 1
    assert prepare.localise(cut, "America/Santiago").first().dt_operacion == datetime(2020, 1, 1)
    assert prepare.with_calendar(prepare.localise(cut, "America/Santiago")).first().min_dia == 0


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="actividad_cod"):
        filters.scope_cut(spark.range(1))


def test_outliers_and_box(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 6, 7, 8, 100]] + [(None,)], "x double")
    row = quality.outlier_summary(df, "x").first()
    assert (row.q1, row.q3, row.iqr, row.outliers_superiores, row.outliers_inferiores) == (3.0, 7.0, 4.0, 1, 0)
    assert row.pct_outliers == pytest.approx(11.11)
    box = quality.box_statistics(df, "x").first()
    assert (box.bigote_inferior, box.bigote_superior, box.atipicos) == (1.0, 8.0, 1)


def test_duplicates_count_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "x"), (2, "y")], "a int, b string")
    got = {r.tipo: (r.cantidad, r.pct_total) for r in quality.duplicate_summary(df, ["a"]).collect()}
    assert got == {"filas_identicas": (1, 25.0), "llave_de_negocio": (2, 50.0)}


def test_rows_of_one_hash_are_not_copies_until_compared(spark, monkeypatch):
    rows = [(n % 7, float(n % 5), None if n % 3 else "x") for n in range(60)] + [(8, 0.0, "z"), (8, -0.0, "z"), (9, 1.0, None)]
    df = spark.createDataFrame(rows, "a int, b double, `c.d` string")
    want = len(rows) - len(set(rows))
    got = {r.tipo: r.cantidad for r in quality.duplicate_summary(df, ["a"]).collect()}
    assert got == {"filas_identicas": want, "llave_de_negocio": len(rows) - 9}
    monkeypatch.setattr(F, "xxhash64", lambda *c: F.lit(1).cast("long"))
    assert {r.tipo: r.cantidad for r in quality.duplicate_summary(df, ["a"]).collect()} == got


def test_a_table_without_copies_shuffles_hashes_only(spark):
    df = spark.range(1000).selectExpr("id", "repeat(cast(id as string), 50) as wide")
    plan = quality.duplicate_summary(df, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_sketches_of_years_merge(spark, tmp_path):
    df = spark.range(60_000).selectExpr(
        "id % 6 + 2019 as anio", "cast(id % 20011 as string) as matricula", "id % 3 as clase", "cast(null as date) as vacia")
    columns = ["matricula", "clase", "vacia"]
    path = str(tmp_path / "bocetos")
    first = quality.distinct_sketches(df.filter("anio < 2024"), ["anio"], columns)
    first.write.parquet(path)
    quality.distinct_sketches(df.filter("anio = 2024"), ["anio"], columns).write.mode("append").parquet(path)
    stored = spark.read.parquet(path)
    assert stored.count() == 18 and max(len(r.boceto) for r in stored.collect()) <= 2 ** 14 + 100
    got = {r.columna: r for r in quality.merged_cardinality(stored).collect()}
    assert got["matricula"].valores_distintos == pytest.approx(20011, rel=4 * 1.04 / 128)
    assert (got["clase"].valores_distintos, got["vacia"].valores_distintos, got["vacia"].nulos) == (3, 0, 60_000)
    whole = quality.merged_cardinality(quality.distinct_sketches(df, [], columns))
    for r in whole.collect():
        assert r.n == got[r.columna].n == 60_000
        assert r.valores_distintos == pytest.approx(got[r.columna].valores_distintos, rel=4 * 1.04 / 128)


def test_file_inventory(spark, tmp_path):
    for name in ("a.csv", "sub/b.JSON", "sub/c.xlsx", "README", ".gitkeep", ".hidden"):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_text("x" * 100)
    got = {r.ruta_relativa: r.formato for r in files.file_index(spark, str(tmp_path)).collect()}
    assert got["a.csv"] == "csv" and got["sub/b.JSON"] == "json" and got["sub/c.xlsx"] == "xlsx"
    assert got["README"] == "desconocido" and ".gitkeep" not in got
    plan = files.file_index(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]


def test_csv_profile_facts(spark, tmp_path):
    (tmp_path / "clima.csv").write_text("fecha,prcp\n2024-01-01,1\n2024-01-02,\n")
    (tmp_path / "ops.csv").write_text("mes_id,aeropuerto_oaci\n202401,A\n202402,A\n")
    facts = {(r.categoria, r.clave): r.valor for r in files.profile_csv_sample(spark, str(tmp_path)).collect()}
    assert facts["muestra", "archivos_inspeccionados"] == "2"
    assert facts["archivo: clima.csv", "prcp (% nulos)"] == "50.0"
    assert facts["archivo: clima.csv", "rango de fecha"] == "2024-01-01 a 2024-01-02"
    assert facts["archivo: ops.csv", "columnas con nulos"] == "ninguna"
    assert facts["archivo: ops.csv", "rango de mes_id (YYYYMM)"] == "202401 a 202402"
    assert facts["archivo: ops.csv", "aeropuerto_oaci (valores distintos)"] == "1"
    summary = {(r.categoria, r.clave): r.valor for r in quality.inventory_summary(
        files.file_index(spark, str(tmp_path)), files.profile_csv_sample(spark, str(tmp_path))).collect()}
    assert summary["archivos", "total_archivos"] == "2" and summary["archivos_por_formato", "csv"] == "2"


def test_empty_folder_profile(spark, tmp_path):
    (tmp_path / "x.json").write_text("{}")
    facts = {r.clave: r.valor for r in files.profile_csv_sample(spark, str(tmp_path)).collect()}
    assert facts == {"archivos_inspeccionados": "0", "advertencia": "sin archivos csv para perfilar"}


def test_headerless_feed_is_clipped(spark, tmp_path):
    path = os.path.join(tmp_path, "85799.csv.gz")
    with gzip.open(path, "wt") as f:
        f.write("2019-12-31,1,1,1,,,10,5,,1000,\n2020-01-01,2,1,3,0.5,,20,5,,1001,\n2026-01-01,3,1,1,,,10,5,,1000,\n")
    got = readers.read_weather_feed(spark, path, "2020-01-01", "2026-01-01").collect()
    assert len(got) == 1 and got[0].tavg == 2.0 and got[0].snow is None


def test_partitioned_sink_prunes(spark):
    df = spark.range(100).withColumn("anio", (F.col("id") % 3 + 2020).cast("int"))
    back = sinks.save_table(df, scratch_path(spark, "t"), ["anio"])
    kept = back.filter("anio = 2021")
    assert kept.count() == 33
    assert "PartitionFilters: [isnotnull(anio" in kept._jdf.queryExecution().executedPlan().toString()


def test_cluster_session_without_shared_folder_is_refused(spark):
    from slotwise import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Fake:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Fake())


def test_tables_without_values(spark):
    """Empty tables and columns without values or spread give nulls, not errors."""
    empty = spark.createDataFrame([], "a double, b string")
    nulls = spark.createDataFrame([(None, "x"), (None, "y")], "a double, b string")
    same = spark.createDataFrame([(2.0, "x"), (2.0, "y")], "a double, b string")
    assert quality.null_rates(empty).count() == 0
    assert {r.columna: r.pct_nulos for r in quality.column_profile(empty).collect()} == {"a": None, "b": None}
    assert quality.outlier_summary(nulls, "a").first().pct_outliers is None
    assert quality.outlier_summary(empty, "a").first().q1 is None
    bins = quality.histogram(same, F.col("a"), 4).collect()
    assert [(r.n, r.densidad) for r in bins] == [(2, None)]
    assert quality.duplicate_summary(empty, ["b"]).filter("pct_total is not null").count() == 0
    assert quality.describe(nulls, ["a"]).first().p50 is None


def test_scores_of_one_class_or_none(spark):
    one = spark.createDataFrame([(1, 0.3), (1, 0.6)], "y int, p double")
    assert metrics.roc_auc(one, "y", "p").first()[0] is None
    assert metrics.roc_curve(one, "y", "p").filter("fpr is null").count() == 2
    assert metrics.metric_row(one, "y", "p", "m", "f").first().roc_auc is None
    none = spark.createDataFrame([], "y int, p double")
    for table in (metrics.roc_auc, metrics.average_precision, metrics.lift, metrics.precision_recall_curve):
        table(none, "y", "p").collect()


def test_rows_without_a_score_count_nowhere(spark):
    df = spark.createDataFrame([(0, float("nan")), (1, None), (1, 0.9)], "y int, p double")
    assert metrics.threshold_metrics(df, "y", "p").first().accuracy == 1.0
    assert metrics.confusion_matrix(df, "y", "p").agg(F.sum("n")).first()[0] == 1
    assert metrics.brier(df, "y", "p").first()[0] == pytest.approx(0.01)


def test_pivots_find_their_columns(spark):
    df = spark.createDataFrame([(2001, "a"), (2001, "z"), (2002, None)], "y int, c string")
    out = {r.y: r.asDict() for r in profiles.count_pivot(df, F.col("y"), "c").collect()}
    assert out == {2001: {"y": 2001, "a": 1, "z": 1}, 2002: {"y": 2002, "a": 0, "z": 0}}


def test_readings_of_one_instant_stay_whole(spark):
    at = datetime(2024, 1, 1, 10)
    readings = spark.createDataFrame([("s", at, 1.0, 9.0), ("s", at, 2.0, 3.0)], "s string, t timestamp, a double, b double")
    left = spark.createDataFrame([("s", datetime(2026, 5, 1))], "s string, at timestamp")
    row = enrich.as_of_join(left, readings, "s", "at", "t", ["a", "b"]).first()
    assert (row.a, row.b) == (2.0, 3.0)


def test_every_file_is_listed(spark, tmp_path):
    from slotwise.sources import files

    for name in ("a.csv", "_b.csv", ".c.csv", "d.JSON", "noext", ".gitkeep"):
        (tmp_path / name).write_text("x")
    got = {r.ruta_relativa: r.formato for r in files.file_index(spark, str(tmp_path)).collect()}
    assert got == {"a.csv": "csv", "_b.csv": "csv", ".c.csv": "csv", "d.JSON": "json", "noext": "desconocido"}
