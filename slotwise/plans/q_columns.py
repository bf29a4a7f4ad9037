"""Filters, projections, imputation and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from slotwise.functions import binning as B
from slotwise.functions import cleaning as C
from slotwise.functions import clock, wind
from slotwise.operators import enrich, filters, prepare
from slotwise.operators import weather as We
from slotwise.operators.ranking import exact_quantiles
from slotwise.operators.timetable import FLIGHT
from slotwise.plans import tables
from slotwise.plans.registry import query, tidy
from slotwise.plans.sql import CLEAN, DAILY, DATED, FLIGHTS, JOINED, TARGET, WEATHER

# --- filters and row selection


@query("F1_scope_cut", f"""WITH {FLIGHTS}
SELECT event_id, dt_operacion, aeropuerto_oaci, actividad_cod FROM flights
WHERE aeropuerto_oaci = 'A1' AND dt_operacion >= TIMESTAMP '2024-01-05' AND dt_operacion < TIMESTAMP '2024-01-25'
  AND actividad_cod IN ('U')
""")
def scope_cut(spark, d):
    cut = filters.scope_cut(tables.flights(spark, d), "A1", "2024-01-05", "2024-01-25", ["U"])
    return cut.select("event_id", "dt_operacion", "aeropuerto_oaci", "actividad_cod")


@query("F2_group_support", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, n_obs_grupo FROM (
  SELECT *, count(*) OVER (PARTITION BY l_suppkey, l_returnflag) AS n_obs_grupo FROM lineitem)
WHERE n_obs_grupo >= 190
""")
def group_support(spark, d):
    li = tables.table(spark, d, "lineitem")
    kept = filters.with_support(li, ["l_suppkey", "l_returnflag"], 190)
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "n_obs_grupo")


@query("F3_support_on_aggregates", """
SELECT l_suppkey, l_returnflag, count(*) AS n, round(avg(l_quantity), 6) AS media FROM lineitem
GROUP BY ALL HAVING count(*) >= 190
""")
def aggregate_support(spark, d):
    li = tables.table(spark, d, "lineitem")
    groups = li.groupBy("l_suppkey", "l_returnflag").agg(
        F.count("*").alias("n"), F.avg("l_quantity").alias("media"))
    return tidy(groups.filter(F.col("n") >= 190))


@query("F4_drop_missing", f"""WITH {FLIGHTS}
SELECT event_id, numero_vuelo, pmd FROM flights WHERE numero_vuelo IS NOT NULL AND pmd IS NOT NULL
""")
def drop_missing(spark, d):
    return tables.flights(spark, d).na.drop(subset=["numero_vuelo", "pmd"]).select("event_id", "numero_vuelo", "pmd")


@query("F5_range_filters", f"""WITH {FLIGHTS}
SELECT event_id, modelo_avion, pmd, CASE WHEN pmd > 20 THEN 'imposible' ELSE 'ancho' END AS grupo
FROM flights WHERE (pmd > 5 AND pmd <= 20) OR (pmd > 20 AND aeropuerto_oaci = 'A1')
""")
def range_filters(spark, d):
    f, w = tables.flights(spark, d), F.col("pmd")
    kept = f.filter(((w > 5) & (w <= 20)) | ((w > 20) & (F.col("aeropuerto_oaci") == "A1")))
    return kept.select("event_id", "modelo_avion", "pmd", F.when(w > 20, "imposible").otherwise("ancho").alias("grupo"))


@query("F6_J5_top_n_membership", """
WITH top AS (SELECT o_custkey FROM orders GROUP BY o_custkey ORDER BY count(*) DESC, o_custkey LIMIT 12)
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey IN (SELECT o_custkey FROM top)
""")
def top_membership(spark, d):
    best = filters.among_top(tables.table(spark, d, "orders"), "o_custkey", 12)
    return best.select("o_orderkey", "o_custkey", "o_totalprice")


@query("F7_imputed_original_split", f"""WITH {CLEAN}
SELECT pmd_fue_imputado, count(*) AS n, round(avg(pmd), 6) AS media FROM clean GROUP BY pmd_fue_imputado
""")
def imputed_split(spark, d):
    log = prepare.preprocess_log(tables.flights(spark, d))
    return tidy(log.groupBy("pmd_fue_imputado").agg(F.count("*").alias("n"), F.avg("pmd").alias("media")))


@query("F8_cross_wind_alert", f"""WITH {JOINED}
SELECT event_id, fecha_cruce, round(viento_cruzado, 6) AS viento_cruzado, retraso FROM joined WHERE viento_cruzado > 30
""")
def cross_wind_alert(spark, d):
    alert = We.wind_alert(tables.joined(spark, d), 30)
    return tidy(alert.select("event_id", "fecha_cruce", "viento_cruzado", "retraso"))


@query("F9_exact_sample", """
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
ORDER BY ('0x' || substr(md5(l_orderkey || '|' || l_linenumber || '|42'), 1, 15))::BIGINT, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity
LIMIT 5000""")
def exact_sample(spark, d):
    li = tables.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return tidy(filters.sample_exactly(li, ["l_orderkey", "l_linenumber"], 5000, seed=42))


# --- projections


@query("P1_fill_text", f"""WITH {FLIGHTS}
SELECT event_id, coalesce(numero_vuelo, 'DESCONOCIDO') AS numero_vuelo FROM flights""")
def fill_text(spark, d):
    return tables.flights(spark, d).select("event_id", C.fill_text("numero_vuelo").alias("numero_vuelo"))


@query("P2_coerce_number", """
SELECT doc_id, TRY_CAST(source AS DOUBLE) AS de_texto, TRY_CAST(CAST(n_chars AS VARCHAR) AS DOUBLE) AS de_numero FROM documents""")
def coerce_number(spark, d):
    docs = tables.table(spark, d, "documents")
    return docs.select(
        "doc_id", C.to_number("source").alias("de_texto"),
        C.to_number(F.col("n_chars").cast("string")).alias("de_numero"))


@query("P3_zero_to_null", f"""WITH {FLIGHTS} SELECT event_id, nullif(pmd, 0) AS pmd FROM flights""")
def zero_to_null(spark, d):
    return tables.flights(spark, d).select("event_id", C.zero_to_null("pmd").alias("pmd"))


@query("P4_month_key", """
SELECT event_id, (year(ts) * 100 + month(ts))::BIGINT AS mes_id,
       strftime(timezone('America/Santiago', timezone('UTC', ts)), '%Y-%m-%d %H:%M') AS local_santiago
FROM events""")
def month_key(spark, d):
    e = tables.table(spark, d, "events")
    local = F.convert_timezone(F.lit("UTC"), F.lit("America/Santiago"), F.col("ts"))
    return e.select(
        "event_id", clock.month_key("ts").alias("mes_id"),
        F.date_format(local, "yyyy-MM-dd HH:mm").alias("local_santiago"))


@query("P5_border_code", f"""WITH {FLIGHTS}
SELECT event_id, CASE WHEN es_internacional THEN 'I' WHEN NOT es_internacional THEN 'D' END AS internacional_domestico
FROM flights""")
def border_code(spark, d):
    return tables.flights(spark, d).select(
        "event_id", C.border_code("es_internacional").alias("internacional_domestico"))


@query("P6_calendar_parts", f"""WITH {DATED}
SELECT event_id, min_dia, anio, mes, dia_semana, mes_ym FROM dated""")
def calendar_parts(spark, d):
    dated = prepare.with_calendar(tables.flights(spark, d))
    return tidy(dated.select("event_id", "min_dia", "anio", "mes", "dia_semana", "mes_ym"))


@query("P7_join_date", f"""WITH {FLIGHTS} SELECT event_id, CAST(dt_operacion AS DATE) AS fecha_cruce FROM flights""")
def join_date(spark, d):
    return tables.flights(spark, d).select("event_id", clock.local_date("dt_operacion").alias("fecha_cruce"))


@query("P8_circular_wrap", """
SELECT event_id, ((((d + 720) % 1440) + 1440) % 1440) - 720 AS desvio
FROM (SELECT event_id, (event_id * 7919) % 1440 - (user_id * 613) % 1440 AS d FROM events)""")
def circular_wrap(spark, d):
    e = tables.table(spark, d, "events")
    gap = (F.col("event_id") * 7919) % 1440 - (F.col("user_id") * 613) % 1440
    return e.select("event_id", clock.wrap_minutes(gap).alias("desvio"))


@query("P9_fractional_hour", f"""WITH {TARGET}
SELECT event_id, round(hora_programada, 6) AS hora_programada FROM target""")
def fractional_hour(spark, d):
    return tidy(tables.target(spark, d).select(
        "event_id", clock.fractional_hour("hora_referencia_min").alias("hora_programada")))


@query("P10_threshold_flags", f"""WITH {DAILY}, {TARGET}
SELECT event_id, CASE WHEN desvio_min > 15 THEN 1 ELSE 0 END::BIGINT AS retraso,
       CASE WHEN prcp > 1.0 THEN 1 ELSE 0 END::BIGINT AS dia_lluvioso
FROM target LEFT JOIN daily ON fecha = fecha_cruce""")
def threshold_flags(spark, d):
    daily = tables.daily_weather(spark, d).select(F.col("fecha").alias("fecha_cruce"), "prcp")
    both = We.join_weather(tables.target(spark, d), daily)
    return tidy(both.select(
        "event_id", C.exceeds("desvio_min", 15).alias("retraso"), C.exceeds("prcp", 1.0).alias("dia_lluvioso")))


@query("P11_P12_P13_P14_P16_weather_features", f"""WITH {WEATHER}
SELECT fecha_cruce, tavg, tmin, tmax, amplitud_termica, prcp, dia_lluvioso, wspd, wdir,
       round(viento_cruzado, 6) + 0.0::DOUBLE AS viento_cruzado, round(viento_frontal, 6) + 0.0::DOUBLE AS viento_frontal, pres
FROM weather""")
def weather_features(spark, d):
    return tidy(tables.weather(spark, d))


@query("P13_cross_wind_per_event", """
SELECT event_id, round(value * abs(sin(radians((user_id * 37) % 360 - 170))), 6) AS cruzado,
       round(value * cos(radians((user_id * 37) % 360 - 170)), 6) + 0.0::DOUBLE AS frontal FROM events""")
def cross_wind_events(spark, d):
    e = tables.table(spark, d, "events").withColumn("wdir", (F.col("user_id") * 37) % 360)
    return tidy(e.select(
        "event_id", wind.cross_wind("value", "wdir").alias("cruzado"), wind.head_wind("value", "wdir").alias("frontal")))


@query("P15_drop_empty_columns", f"""WITH {DAILY} SELECT fecha, tavg, prcp, wdir FROM daily""")
def drop_empty(spark, d):
    daily = tables.daily_weather(spark, d).select("fecha", "tavg", "prcp", "wdir", "snow")
    return prepare.drop_empty_columns(daily, ["snow", "prcp", "wdir"])


@query("P17_log_transforms", """
SELECT o_orderkey, round(ln(1 + o_totalprice), 6) AS log1p_v, round(log10(o_totalprice), 6) AS log10_v,
       round(sqrt(o_totalprice), 6) AS sqrt_v FROM orders""")
def log_transforms(spark, d):
    v = "o_totalprice"
    return tidy(tables.table(spark, d, "orders").select(
        "o_orderkey", F.log1p(v).alias("log1p_v"), F.log10(v).alias("log10_v"), F.sqrt(v).alias("sqrt_v")))


@query("P18_clip", f"""WITH {TARGET}
SELECT event_id, CASE WHEN pmd IS NOT NULL THEN least(pmd, 10.0::DOUBLE) END AS pmd_recortado,
       greatest(least(desvio_min, 180.0::DOUBLE), -90.0::DOUBLE) AS desvio_recortado
FROM target""")
def clip(spark, d):
    return tables.target(spark, d).select(
        "event_id", C.clip("pmd", high=10.0).alias("pmd_recortado"),
        C.clip("desvio_min", -90.0, 180.0).alias("desvio_recortado"))


@query("P19_fixed_edge_bins", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
       CASE WHEN l_quantity <= 5 THEN '< 5' WHEN l_quantity <= 10 THEN '5-10' WHEN l_quantity <= 20 THEN '10-20'
            WHEN l_quantity <= 30 THEN '20-30' WHEN l_quantity <= 100 THEN '> 30' END AS rango FROM lineitem""")
def fixed_bins(spark, d):
    return tables.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        B.band("l_quantity", B.WIND_EDGES, B.WIND_LABELS).alias("rango"))


_DECILES = [i / 10 for i in range(11)]


@query("P20_quantile_bins", """
WITH e AS (SELECT unnest(quantile_cont(l_discount, [0,.1,.2,.3,.4,.5,.6,.7,.8,.9,1.0])) AS edge FROM lineitem),
     u AS (SELECT DISTINCT edge FROM e),
     inner_edges AS (SELECT edge FROM u WHERE edge > (SELECT min(edge) FROM u) AND edge < (SELECT max(edge) FROM u))
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_discount,
       (SELECT count(*) FROM inner_edges WHERE edge < l_discount) AS grupo FROM lineitem""")
def quantile_bins(spark, d):
    li = tables.table(spark, d, "lineitem")
    row = exact_quantiles(li, "l_discount", _DECILES, [f"e{i}" for i in range(11)]).first()
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_discount",
        B.quantile_band("l_discount", [v for v in row if v is not None]).cast("long").alias("grupo"))


@query("P21_label_encoding", """
WITH t AS (SELECT p_partkey, coalesce(p_type, 'nan') AS v FROM part)
SELECT p_partkey, v AS p_type, dense_rank() OVER (ORDER BY v) - 1 AS codigo FROM t""")
def label_encoding(spark, d):
    part = tables.table(spark, d, "part").select("p_partkey", "p_type")
    return prepare.label_code(part, "p_type", "codigo")


@query("P22_category_codes", f"""WITH {FLIGHTS},
codes AS (SELECT numero_vuelo, row_number() OVER (ORDER BY numero_vuelo) - 1 AS codigo
          FROM (SELECT DISTINCT numero_vuelo FROM flights WHERE numero_vuelo IS NOT NULL))
SELECT event_id, f.numero_vuelo, coalesce(codigo, -1) AS codigo FROM flights f LEFT JOIN codes USING (numero_vuelo)""")
def category_codes(spark, d):
    f = tables.flights(spark, d).select("event_id", "numero_vuelo")
    return prepare.category_code(f, "numero_vuelo", "codigo")


@query("P23_binary_encodings", f"""WITH {FLIGHTS}
SELECT event_id, CASE WHEN tipo_operacion = 'D' THEN 1 ELSE 0 END::BIGINT AS tipo_operacion_cod,
       CAST(es_internacional AS BIGINT) AS es_internacional FROM flights""")
def binary_encodings(spark, d):
    return tables.flights(spark, d).select(
        "event_id", (F.col("tipo_operacion") == "D").cast("long").alias("tipo_operacion_cod"),
        F.col("es_internacional").cast("long").alias("es_internacional"))


@query("P25_report_rounding", """
SELECT c_custkey, round(c_acctbal / 7, 2) AS r2, round(c_acctbal / 7, 3) AS r3, round(c_acctbal / 7, 4) AS r4 FROM customer""")
def report_rounding(spark, d):
    v = F.col("c_acctbal") / 7
    return tables.table(spark, d, "customer").select(
        "c_custkey", *[F.round(v, p).alias(f"r{p}") for p in (2, 3, 4)])


@query("P26_pseudonym", f"""WITH {FLIGHTS} SELECT event_id, sha256('sal-' || matricula) AS matricula_hash FROM flights""")
def pseudonym(spark, d):
    return tables.flights(spark, d).select("event_id", C.pseudonym("matricula", "sal-").alias("matricula_hash"))


# --- imputation


@query("I1_group_median_imputation", f"""WITH {CLEAN}
SELECT event_id, modelo_avion, round(pmd, 6) AS pmd, pmd_fue_imputado FROM clean""")
def group_median(spark, d):
    repaired = tables.flights(spark, d).withColumn("pmd", C.zero_to_null("pmd"))
    done = prepare.impute_group_median(repaired, "pmd", "modelo_avion")
    return tidy(done.select("event_id", "modelo_avion", "pmd", "pmd_fue_imputado"))


@query("I1_preprocess_log", f"""WITH {CLEAN}
SELECT event_id, numero_vuelo, round(pmd, 6) AS pmd, pmd_fue_imputado, mes_id, internacional_domestico FROM clean""")
def preprocess(spark, d):
    log = prepare.preprocess_log(tables.flights(spark, d))
    return tidy(log.select("event_id", "numero_vuelo", "pmd", "pmd_fue_imputado", "mes_id", "internacional_domestico"))


@query("I2_train_only_median", f"""WITH {FLIGHTS}
SELECT event_id, round(coalesce(pmd, (SELECT quantile_cont(pmd, 0.5) FROM flights WHERE dt_operacion < TIMESTAMP '2024-01-20')), 6) AS pmd
FROM flights""")
def train_only_median(spark, d):
    f = tables.flights(spark, d)
    train = f.filter(F.col("dt_operacion") < F.lit("2024-01-20").cast("timestamp_ntz"))
    return tidy(prepare.impute_medians(f, ["pmd"], learn_on=train).select("event_id", "pmd"))


# --- joins


@query("J1_monthly_enrichment", """
WITH o AS (SELECT o_orderkey, CASE WHEN o_custkey % 50 = 0 THEN NULL ELSE o_orderpriority END AS aeropuerto_oaci,
                  (year(o_orderdate) * 100 + month(o_orderdate))::BIGINT AS mes_id, o_orderstatus AS internacional_domestico FROM orders),
     m AS (SELECT aeropuerto_oaci, mes_id, internacional_domestico, count(*)::BIGINT AS cnt_operaciones FROM o
           WHERE internacional_domestico <> 'P' GROUP BY ALL)
SELECT o.*, m.cnt_operaciones FROM o LEFT JOIN m ON o.aeropuerto_oaci IS NOT DISTINCT FROM m.aeropuerto_oaci
  AND o.mes_id IS NOT DISTINCT FROM m.mes_id AND o.internacional_domestico IS NOT DISTINCT FROM m.internacional_domestico
""")
def monthly_enrichment(spark, d):
    o = tables.table(spark, d, "orders").select(
        "o_orderkey", F.when(F.col("o_custkey") % 50 != 0, F.col("o_orderpriority")).alias("aeropuerto_oaci"),
        clock.month_key("o_orderdate").alias("mes_id"), F.col("o_orderstatus").alias("internacional_domestico"))
    monthly = (
        o.filter(F.col("internacional_domestico") != "P")
        .groupBy(*enrich.OPS_KEYS).agg(F.count("*").alias("cnt_operaciones"))
    )
    return enrich.join_monthly_operations(o, monthly)


@query("J2_weather_join", f"""WITH {JOINED}
SELECT event_id, fecha_cruce, retraso, tavg, prcp, round(viento_cruzado, 6) AS viento_cruzado FROM joined""")
def weather_join(spark, d):
    j = tables.joined(spark, d)
    return tidy(j.select("event_id", "fecha_cruce", "retraso", "tavg", "prcp", "viento_cruzado"))


@query("J2_weather_coverage", f"""WITH {TARGET}, {WEATHER},
some_days AS (SELECT * FROM weather WHERE tavg > 9)
SELECT count(*) AS vuelos, round(avg(CASE WHEN tavg IS NULL THEN 1.0 ELSE 0.0 END), 6) AS sin_clima,
       avg(CASE WHEN tavg IS NULL THEN 1.0 ELSE 0.0 END) > 0.05 AS aviso
FROM target LEFT JOIN some_days USING (fecha_cruce)""")
def weather_coverage(spark, d):
    some = tables.weather(spark, d).filter(F.col("tavg") > 9)
    return tidy(We.weather_coverage(We.join_weather(tables.target(spark, d), some)))


@query("J3_key_grain_guard", """
SELECT o_custkey, CAST(o_orderdate AS DATE) AS dia, count(*) AS n FROM orders GROUP BY ALL HAVING count(*) > 1""")
def key_grain(spark, d):
    o = tables.table(spark, d, "orders").select("o_custkey", F.to_date("o_orderdate").alias("dia"))
    return enrich.repeated_keys(o, ["o_custkey", "dia"])


@query("J4_as_of_hourly_weather", f"""WITH {FLIGHTS},
hourly AS (SELECT 'A' || (user_id % 7) AS aeropuerto_oaci, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS lectura, max(value) AS temp
           FROM events GROUP BY ALL)
SELECT f.event_id, f.aeropuerto_oaci, f.dt_operacion, h.lectura AS lectura_ts, h.temp
FROM flights f ASOF LEFT JOIN hourly h ON f.aeropuerto_oaci = h.aeropuerto_oaci AND f.dt_operacion >= h.lectura""")
def as_of_weather(spark, d):
    f = tables.flights(spark, d).select("event_id", "aeropuerto_oaci", "dt_operacion")
    hourly = tables.hourly_weather(spark, d)
    return enrich.as_of_join(f, hourly, "aeropuerto_oaci", "dt_operacion", "lectura", ["temp"])


@query("W1_group_size", f"""WITH {FLIGHTS}
SELECT event_id, CASE WHEN aerolinea_dgac IS NULL OR numero_vuelo IS NULL OR tipo_operacion IS NULL THEN NULL
       ELSE count(*) OVER (PARTITION BY aerolinea_dgac, numero_vuelo, tipo_operacion) END AS n_obs_grupo FROM flights""")
def group_size(spark, d):
    return filters.with_group_size(tables.flights(spark, d), FLIGHT).select("event_id", "n_obs_grupo")


@query("W4_group_median_on_rows", """
WITH m AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.5) AS mediana FROM lineitem GROUP BY l_returnflag)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, round(mediana, 6) AS mediana FROM lineitem JOIN m USING (l_returnflag)""")
def group_median_rows(spark, d):
    li = tables.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_extendedprice")
    medians = exact_quantiles(li, "l_extendedprice", [0.5], ["mediana"], keys=["l_returnflag"])
    rows = enrich.left_enrich(li, medians, ["l_returnflag"], ["mediana"]).drop("l_extendedprice")
    return rows.withColumn("mediana", F.round("mediana", 6))
