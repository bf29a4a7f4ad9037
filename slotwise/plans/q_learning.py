"""Clustering and supervised models."""

from __future__ import annotations

from pyspark.sql import functions as F

from slotwise.operators import clusters as K
from slotwise.operators import metrics as X
from slotwise.operators import models as M
from slotwise.operators import profiles as Pr
from slotwise.operators import search as S
from slotwise.operators.filters import stratified_parts
from slotwise.plans import tables
from slotwise.plans.q_tables import nation_log
from slotwise.plans.registry import query, tidy
from slotwise.plans.sql import DAY_PROFILE, JOINED, NATION_PROFILE, SLOT_PROFILE


def _profile(spark, d):
    return Pr.airport_profile(nation_log(spark, d))


# Nations by key modulo 4 stand for the cluster number where only the table work is checked.
_CLUSTER = "CAST(substr(aeropuerto_oaci, 2) AS BIGINT) % 4"


def _clustered(spark, d):
    return _profile(spark, d).withColumn("cluster", F.substring("aeropuerto_oaci", 2, 9).cast("long") % 4)


_MEASURES = ["total_vuelos", "pct_intl", "pmd_mediana", "n_modelos", "cnt_ops_media"]


def _z(c: str) -> str:
    x = "ln(1 + total_vuelos)" if c == "total_vuelos" else c
    return f"round(({x} - avg({x}) OVER ()) / stddev_pop({x}) OVER (), 6) AS z_{c}"


@query("M1_standardise", f"""WITH {NATION_PROFILE}
SELECT aeropuerto_oaci, {", ".join(map(_z, _MEASURES))} FROM profile""")
def standardise(spark, d):
    z = K.standardise(_profile(spark, d), _MEASURES, ["total_vuelos"])
    return tidy(z.select("aeropuerto_oaci", *[f"z_{c}" for c in _MEASURES]))


@query("M2_M3_airport_clusters")
def airport_clusters(spark, d):
    return K.cluster_airports(_profile(spark, d)).rows


@query("M4_cluster_names", f"""WITH {NATION_PROFILE},
c AS (SELECT {_CLUSTER} AS cluster, avg(pct_intl) AS a, avg(pmd_mediana) AS b, avg(total_vuelos) AS v FROM profile GROUP BY 1),
h AS (SELECT cluster FROM c ORDER BY a DESC, cluster LIMIT 1),
p AS (SELECT cluster FROM c WHERE cluster NOT IN (SELECT cluster FROM h) ORDER BY b DESC, cluster LIMIT 1),
g AS (SELECT cluster FROM c WHERE cluster NOT IN (SELECT cluster FROM h UNION ALL SELECT cluster FROM p) ORDER BY v DESC, cluster LIMIT 1)
SELECT cluster, CASE WHEN cluster IN (SELECT cluster FROM h) THEN 'Hub internacional' WHEN cluster IN (SELECT cluster FROM p) THEN 'Pesados / carga'
       WHEN cluster IN (SELECT cluster FROM g) THEN 'Alta aviacion general' ELSE 'Pequeños / regionales' END AS nombre FROM c""")
def cluster_names(spark, d):
    return K.name_clusters(_clustered(spark, d)).select("cluster", "nombre")


@query("A4_cluster_summary", f"""WITH {NATION_PROFILE}
SELECT {_CLUSTER} AS cluster, count(*) AS n_aeropuertos, sum(total_vuelos)::BIGINT AS total_vuelos_sum,
       round(avg(pct_intl), 6) AS pct_intl_media, round(avg(pmd_mediana), 6) AS pmd_mediana_media FROM profile GROUP BY 1""")
def cluster_summary(spark, d):
    return tidy(Pr.cluster_summary(_clustered(spark, d)))


@query("M5_k_scan")
def k_scan(spark, d):
    return K.scan_airports(_profile(spark, d))


# A diagnosis table drawn from order years: one row per k.
_DIAG = """diag AS (
  SELECT year(o_orderdate)::BIGINT - 1993 AS k, round(sum(o_totalprice), 2) AS inercia, round(avg(o_totalprice) / 1000000, 4) AS silhouette,
         round(min(o_custkey % 97 + year(o_orderdate) % 3) / 100 + 0.01 * (year(o_orderdate) % 3), 4) AS cluster_mas_chico_pct
  FROM orders GROUP BY year(o_orderdate))"""


@query("M6_k_choice", f"""WITH {_DIAG}
SELECT k, silhouette, cluster_mas_chico_pct, cluster_mas_chico_pct >= 0.02 AS admisible,
       row_number() OVER (ORDER BY CASE WHEN cluster_mas_chico_pct >= 0.02 OR (SELECT max(cluster_mas_chico_pct) FROM diag) < 0.02 THEN 0 ELSE 1 END,
                          silhouette DESC, k) = 1 AS elegido FROM diag""")
def k_choice(spark, d):
    year = F.year("o_orderdate")
    diag = tables.table(spark, d, "orders").groupBy(year.alias("y")).agg(
        F.round(F.avg("o_totalprice") / 1000000, 4).alias("silhouette"), F.min(F.col("o_custkey") % 97 + year % 3).alias("m"))
    diag = diag.select(
        (F.col("y") - 1993).cast("long").alias("k"), "silhouette",
        F.round(F.col("m") / 100 + F.lit(0.01) * (F.col("y") % 3), 4).alias("cluster_mas_chico_pct"))
    return K.choose_k(diag, 0.02)


@query("M7_flight_segments")
def flight_segments(spark, d):
    slots = Pr.slot_profile(tables.joined(spark, d), 30)
    return K.segment_flights(slots).rows


@query("M8_day_segments")
def day_segments(spark, d):
    return K.segment_days(Pr.day_profile(tables.joined(spark, d), 10)).rows


@query("M9_outcome_spread_by_k")
def outcome_spread(spark, d):
    return K.segment_days(Pr.day_profile(tables.joined(spark, d), 10)).diagnosis


_SEGMENT = "ascii(substr(aerolinea_dgac, 1, 1)) % 3"


@query("A5_segment_summary", f"""WITH {SLOT_PROFILE},
s AS (SELECT ({_SEGMENT})::BIGINT AS segmento, count(*) AS n_slots, sum(n_operaciones)::BIGINT AS vuelos_cubiertos, avg(hora_programada) AS hora_media,
             avg(tasa_retraso) AS tasa_retraso, avg(variabilidad_min) AS variabilidad_min, avg(pct_severo) AS pct_severo FROM slot_profile GROUP BY 1)
SELECT segmento, n_slots, vuelos_cubiertos, round(hora_media, 6) AS hora_media, round(tasa_retraso, 6) AS tasa_retraso,
       round(variabilidad_min, 6) AS variabilidad_min, round(pct_severo, 6) AS pct_severo, round(n_slots / sum(n_slots) OVER (), 6) AS pct_slots,
       round(vuelos_cubiertos / sum(vuelos_cubiertos) OVER (), 6) AS pct_vuelos,
       CASE WHEN row_number() OVER (ORDER BY s.tasa_retraso DESC, segmento) = 1 THEN 1 ELSE 0 END::BIGINT AS es_segmento_critico FROM s""")
def segment_summary(spark, d):
    slots = Pr.slot_profile(tables.joined(spark, d), 30)
    return tidy(Pr.segment_summary(slots.withColumn("segmento", (F.ascii("aerolinea_dgac") % 3).cast("long"))))


@query("A6_day_type_summary", f"""WITH {DAY_PROFILE},
t AS (SELECT day(fecha_cruce)::BIGINT % 3 AS tipo_dia, count(*) AS n_dias, avg(n_operaciones) AS operaciones, avg(prcp) AS lluvia_mm,
             avg(viento_cruzado) AS viento_cruzado, avg(tavg) AS temperatura, avg(tasa_retraso) AS tasa_retraso FROM day_profile GROUP BY 1)
SELECT tipo_dia, n_dias, round(operaciones, 6) AS operaciones, round(lluvia_mm, 6) AS lluvia_mm, round(t.viento_cruzado, 6) AS viento_cruzado,
       round(temperatura, 6) AS temperatura, round(t.tasa_retraso, 6) AS tasa_retraso,
       round(max(t.tasa_retraso) OVER () - min(t.tasa_retraso) OVER (), 6) AS dispersion FROM t""")
def day_type_summary(spark, d):
    days = Pr.day_profile(tables.joined(spark, d), 10)
    return tidy(Pr.day_type_summary(days.withColumn("tipo_dia", (F.day("fecha_cruce") % 3).cast("long"))))


# --- supervised: returned line items from their measures

LINE_KEY = "line_id"
LINE_SETS = {
    "solo operacion": ["l_quantity", "l_linenumber", "l_extendedprice"],
    "solo clima": ["l_discount", "l_tax"],
    "clima + operacion": ["l_quantity", "l_linenumber", "l_extendedprice", "l_discount", "l_tax"],
}


def line_items(spark, d):
    li = tables.table(spark, d, "lineitem")
    return li.withColumns({
        LINE_KEY: F.xxhash64(*li.columns),
        "y": (F.col("l_returnflag") == "R").cast("int"),
        "anio": F.year("l_shipdate"),
        "l_linenumber": F.col("l_linenumber").cast("double"),
    })


_WEATHER = M.WEATHER_FEATURES


@query("P24_feature_matrix", f"""WITH {JOINED},
known AS (SELECT * FROM joined WHERE tavg IS NOT NULL),
carriers AS (SELECT aerolinea_dgac, row_number() OVER (ORDER BY aerolinea_dgac) - 1 AS c FROM (SELECT DISTINCT aerolinea_dgac FROM known)),
models AS (SELECT modelo_avion, row_number() OVER (ORDER BY modelo_avion) - 1 AS m FROM (SELECT DISTINCT modelo_avion FROM known))
SELECT retraso, anio AS _year, """ + ", ".join(f"round({c}::DOUBLE, 6) + 0.0::DOUBLE AS {c}" for c in _WEATHER) + """,
       round(hora_programada, 6) AS hora_programada, dia_semana::DOUBLE AS dia_semana, mes::DOUBLE AS mes, anio::DOUBLE AS anio,
       c::DOUBLE AS aerolinea_cod, (CASE WHEN tipo_operacion = 'D' THEN 1 ELSE 0 END)::DOUBLE AS tipo_operacion_cod,
       m::DOUBLE AS modelo_cod, (CASE WHEN es_internacional THEN 1 ELSE 0 END)::DOUBLE AS es_internacional
FROM known JOIN carriers USING (aerolinea_dgac) JOIN models USING (modelo_avion)""")
def feature_matrix(spark, d):
    return tidy(M.feature_matrix(tables.joined(spark, d)))


@query("M11_stratified_split", """
WITH h AS (SELECT o_orderkey, o_orderpriority AS y, ('0x' || substr(md5(o_orderkey || '|42'), 1, 15))::BIGINT AS h FROM orders)
SELECT o_orderkey, y, CASE WHEN row_number() OVER (PARTITION BY y ORDER BY h) <= round(count(*) OVER (PARTITION BY y) * 0.8) THEN 0 ELSE 1 END::BIGINT AS part
FROM h""")
def stratified_split(spark, d):
    o = tables.table(spark, d, "orders").select("o_orderkey", F.col("o_orderpriority").alias("y"))
    return tidy(stratified_parts(o, "o_orderkey", "y", [0.8, 0.2]))


def _forest(spark, d):
    return M.train_forest(
        line_items(spark, d), LINE_SETS["clima + operacion"], "y", LINE_KEY, target="l_returnflag = R")


@query("M10_M20_forest_report")
def forest_report(spark, d):
    return _forest(spark, d).report


@query("M13_gini_importance")
def gini(spark, d):
    return _forest(spark, d).importance


@query("M10_M13_forest_checks", """
WITH c AS (SELECT l_returnflag = 'R' AS y, count(*) AS n FROM lineitem GROUP BY 1), t AS (SELECT sum(round(n * 0.8))::BIGINT AS train, sum(n)::BIGINT AS n FROM c)
SELECT train AS n_train, n - train AS n_test, n - train AS n_matriz, 5::BIGINT AS n_features, 1.0::DOUBLE AS importancia_total,
       0::BIGINT AS fuera_de_rango FROM t""")
def forest_checks(spark, d):
    """What must hold of any forest: split sizes, a matrix over all test rows, importances that sum to one."""
    found = _forest(spark, d)
    totals = found.importance.agg(F.count("*").alias("n_features"), F.sum("importancia").alias("importancia_total"))
    matrix = found.confusion.agg(F.sum("n").alias("n_matriz"))
    outside = found.scored.agg(F.count_if(~F.col("proba").between(0, 1)).alias("fuera_de_rango"))
    sizes = found.report.select(F.col("n_train").cast("long"), F.col("n_test").cast("long"))
    one = sizes
    for part in (matrix, totals, outside):  # one row each
        row = part.first()
        one = one.withColumns({c: F.lit(row[c]) for c in part.columns})
    return tidy(one)


@query("M12_cross_validation")
def cross_validation(spark, d):
    return M.cross_validate_forest(
        line_items(spark, d), LINE_SETS["clima + operacion"], "y", LINE_KEY)


def _search(spark, d):
    """One search for all of the following: what one of them has fitted, the next ones read."""
    tagged = M.temporal_split(line_items(spark, d), "anio", 1999, 2000).select(
        LINE_KEY, "y", "tramo", *LINE_SETS["clima + operacion"])
    return S.search_models(
        tagged, "y", "tramo", LINE_KEY, LINE_SETS, store=S.store_for(tagged, LINE_SETS, M.GRID, 42, "v2"))


@query("M15_M16_M17_grid_search")
def grid_search(spark, d):
    return _search(spark, d).search


@query("M17_grid_rows", """
SELECT features, algoritmo, n, filas FROM (VALUES ('GradientBoosting', 6::BIGINT), ('RegresionLogistica', 4::BIGINT)) a(algoritmo, n),
  (VALUES ('solo operacion'), ('solo clima'), ('clima + operacion')) f(features),
  (SELECT count(*) AS filas FROM lineitem WHERE year(l_shipdate) < 1999)""")
def grid_rows(spark, d):
    """Configurations of each algorithm on each feature set, and the rows they were fitted on."""
    rows = line_items(spark, d).filter("anio < 1999").count()
    return _search(spark, d).search.groupBy("features", "algoritmo").agg(
        F.count("*").alias("n"), F.lit(rows).cast("long").alias("filas"))


@query("M18_feature_set_metrics")
def feature_set_metrics(spark, d):
    return _search(spark, d).metrics


@query("M18_test_area_pivot")
def test_area_pivot(spark, d):
    return X.test_area_pivot(_search(spark, d).metrics, list(M.GRID))


@query("M19_permutation_importance")
def permutation(spark, d):
    return _search(spark, d).importance


@query("M15_M19_search_checks", """
SELECT 30::BIGINT AS candidatos, 0::BIGINT AS areas_fuera, 0::BIGINT AS brechas_distintas, 6::BIGINT AS finalistas, 1::BIGINT AS seleccionados,
  0::BIGINT AS finalistas_peores, 0::BIGINT AS seleccion_peor, 0::BIGINT AS sin_candidato, round(avg((l_returnflag = 'R')::INT), 4) AS tasa_base_test,
  count(*) AS filas_test, 5::BIGINT AS importancias, 0::BIGINT AS probas_fuera
FROM lineitem WHERE year(l_shipdate) >= 2000""")
def search_checks(spark, d):
    """What must hold of any search: sizes, gaps, finalists that are the best of their kind, and a winner that is the best."""
    found = _search(spark, d)
    search, metrics = found.search, found.metrics
    top = search.groupBy("features", F.col("algoritmo").alias("modelo")).agg(F.max("roc_auc_val").alias("mejor"))
    inside = lambda c: F.col(c).between(0, 1)
    parts = [
        search.agg(
            F.count("*").alias("candidatos"),
            F.count_if(~(inside("roc_auc_train") & inside("roc_auc_val"))).alias("areas_fuera"),
            F.count_if(F.abs(F.col("roc_auc_train") - F.col("roc_auc_val") - F.col("brecha_sobreajuste")) > 0.00005).alias(
                "brechas_distintas")),
        metrics.join(top, ["features", "modelo"]).agg(
            F.count("*").alias("finalistas"), F.count_if("seleccionado").alias("seleccionados"),
            F.count_if(F.col("roc_auc_val") < F.col("mejor")).alias("finalistas_peores"),
            (F.max("mejor") > F.max(F.when(F.col("seleccionado"), F.col("roc_auc_val")))).cast("long").alias("seleccion_peor"),
            F.max("tasa_base_test").alias("tasa_base_test")),
        metrics.join(search, ["features", "config", "roc_auc_val"], "left_anti").agg(F.count("*").alias("sin_candidato")),
        found.scored.agg(F.count("*").alias("filas_test"), F.count_if(~inside("proba")).alias("probas_fuera")),
        found.importance.agg(F.count_if(F.col("importancia").isNotNull() & F.col("std").isNotNull()).alias("importancias")),
    ]
    one = parts[0]
    for part in parts[1:]:  # one row each
        one = one.join(part)
    return tidy(one)
