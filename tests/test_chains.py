"""Both chains end to end on a log of several years drawn from the stored events."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from slotwise.operators import filters
from slotwise.operators.prepare import preprocess_log
from slotwise.plans import chains, tables
from slotwise.session import scratch_path
from slotwise.sources import sinks

QUICK = chains.Settings(
    aeropuerto_oaci="A1", fecha_desde="2021-01-01", fecha_hasta="2027-01-01", min_ops_slot=5, min_ops_dia=1,
    k_max=3, starts=2, trees=3, cv_trees=2, depth=3, sample=2000, cv_sample=1000, repeats=0,
    grid={"GradientBoosting": [{"max_iter": 2, "learning_rate": 0.1, "max_depth": 2, "min_samples_leaf": 5}],
          "RegresionLogistica": [{"C": 0.1}]},
)


@pytest.fixture(scope="module")
def store(spark):
    return chains.Store(scratch_path(spark, "store"))


@pytest.fixture(scope="module")
def log(spark, sf, store):
    """Events of one month moved to the Januaries of 2022 to 2025, all at airport A1 or A2."""
    f = tables.flights(spark, sf)
    years = F.make_ym_interval(F.lit(-2) + (F.col("event_id") % 4).cast("int"), F.lit(0))
    moved = f.withColumns({
        "dt_operacion": F.col("dt_operacion") + years,
        "aeropuerto_oaci": F.when(F.col("event_id") % 10 == 0, "A2").otherwise("A1"),
        "numero_vuelo": F.lit("1"),
    })
    return store.table("raw", moved)


@pytest.fixture(scope="module")
def daily(spark, sf):
    d = tables.daily_weather(spark, sf)
    years = spark.range(-2, 2).select(F.make_ym_interval(F.col("id").cast("int"), F.lit(0)).alias("y"))
    moved = d.select(F.lit(1).alias("j"), *d.columns).join(years.withColumn("j", F.lit(1)), on="j")
    return moved.withColumn("fecha", (F.col("fecha") + F.col("y")).cast("date")).select(*d.columns)


def test_baseline_chain(spark, log, store):
    month = F.year("dt_operacion") * 100 + F.month("dt_operacion")
    monthly = preprocess_log(log).groupBy(
        "aeropuerto_oaci", month.cast("long").alias("mes_id"), "internacional_domestico"
    ).agg(F.count("*").cast("double").alias("cnt_operaciones"))
    integrated = chains.integrate(log, monthly, store)
    assert integrated.count() == log.count()
    assert integrated.filter("cnt_operaciones IS NULL OR pmd IS NULL").count() == 0
    pruned = filters.scope_cut(integrated, "A1", "2023-01-01", "2024-01-01")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(anio_operacion" in plan and "anio_operacion" in plan
    assert pruned.count() == filters.scope_cut(integrated.drop("anio_operacion"), "A1", "2023-01-01", "2024-01-01").count() > 0
    assert len(pruned.inputFiles()) <= len(integrated.inputFiles())
    # More airports than clusters are needed to place four centres.
    wide = integrated.withColumn("aeropuerto_oaci", F.concat("aeropuerto_oaci", "modelo_avion"))
    out = chains.baseline(wide, "event_id", store, QUICK)
    assert out["cluster_labels"].select("cluster").distinct().count() == 4
    assert out["cluster_labels"].filter("nombre = 'Hub internacional'").count() > 0
    assert out["cluster_metricas"].count() == 7
    row = out["metricas_supervisado"].first()
    assert row.n_train + row.n_test == log.count() and 0 <= row.roc_auc <= 1
    forest = sinks.load_pipeline(f"{store.root}/modelo_rf").transform(wide)
    assert forest.count() == log.count() and forest.filter("probability IS NULL").count() == 0
    assert out["metricas_cv_supervisado"].first().metodo == "StratifiedKFold-5"
    volumes = chains.volume_tables(integrated, [2022, 2023, 2024, 2025])
    assert volumes["vuelos_por_anio"].count() == 4
    assert volumes["correlaciones"].count() == 10
    assert volumes["top_aeropuertos"].first().aeropuerto_oaci == "A1"


def test_delay_risk_chain(spark, log, daily, store):
    out = chains.delay_risk(log, daily, "event_id", store, QUICK)
    assert out["vuelos_clima"].filter("tavg IS NULL").count() == 0
    assert out["metricas_retrasos"].count() == 6
    assert out["metricas_retrasos"].filter("seleccionado").count() == 1
    assert out["busqueda_hiperparametros"].count() == 6
    assert out["proba_test"].filter("proba BETWEEN 0 AND 1").count() == out["proba_test"].count() > 0
    # The stored model takes flights as they come, in a session of its own.
    known = out["vuelos_clima"].filter("anio >= 2025")
    again = sinks.load_pipeline(f"{store.root}/modelo_retrasos").transform(known)
    both = again.select("event_id", vector_to_array("probability")[1].alias("otra")).join(out["proba_test"], "event_id")
    assert both.count() == out["proba_test"].count()
    assert both.filter("abs(otra - proba) > 1e-9").count() == 0
    assert out["segmentos_vuelos"].filter("es_segmento_critico = 1").count() > 0
    assert out["segmentos_diagnostico"].filter("elegido").count() == 1
    assert out["dias_diagnostico"].count() == 2
    both = out["vuelos_clima"].agg(F.count("*")).first()[0]
    bands = out["efecto_clima_retraso"].groupBy("variable").agg(F.sum("n_vuelos").alias("n")).collect()
    assert {r.n for r in bands} == {both}
    report = chains.exploration(
        log, preprocess_log(log).withColumn("cnt_operaciones", F.lit(1.0)),
        out["clima_scte_features"], out["vuelos_clima"], "A1")
    for name, table in report.items():
        assert table.count() >= (0 if name in ("fuselaje_ancho", "unidad_imposible") else 1), name


def test_inventory_chain(spark, sf, store):
    out = chains.inventory(spark, sf, store)
    facts = {(r.categoria, r.clave): r.valor for r in out.collect()}
    assert facts["archivos_por_formato", "parquet"] == facts["archivos", "total_archivos"]
