"""Profiles, volumes and data-quality tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from slotwise.functions.cleaning import clip
from slotwise.operators import filters, prepare
from slotwise.operators import profiles as Pr
from slotwise.operators import quality as Q
from slotwise.operators.ranking import stored
from slotwise.plans import tables
from slotwise.plans.registry import query, tidy
from slotwise.plans.sql import CLEAN, DAILY, FLIGHTS, NATION_PROFILE

YEARS = list(range(1995, 2002))


def nation_log(spark, d):
    """Customers' orders seen as operations of their nation."""
    o, c = tables.table(spark, d, "orders"), tables.table(spark, d, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.concat(F.lit("N"), "c_nationkey").alias("aeropuerto_oaci"),
        (F.col("o_orderstatus") == "F").alias("es_internacional"),
        F.col("o_totalprice").alias("pmd"),
        F.col("c_mktsegment").alias("aerolinea_dgac"),
        F.col("o_custkey").alias("modelo_avion"),
        F.year("o_orderdate").cast("double").alias("cnt_operaciones"),
    )


@query("A1_airport_profile", f"""WITH {NATION_PROFILE}
SELECT aeropuerto_oaci, total_vuelos, round(pct_intl, 6) AS pct_intl, round(pmd_mediana, 6) AS pmd_mediana, n_aerolineas, n_modelos,
       round(cnt_ops_media, 6) AS cnt_ops_media FROM profile""")
def airport_profile(spark, d):
    return tidy(Pr.airport_profile(nation_log(spark, d)))


@query("A7_yearly_volume", "SELECT year(o_orderdate)::BIGINT AS anio, count(*) AS vuelos FROM orders GROUP BY ALL")
def yearly_volume(spark, d):
    return tidy(Pr.yearly_volume(tables.table(spark, d, "orders"), "o_orderdate"))


@query("A8_year_category_pivot", """
SELECT year(o_orderdate)::BIGINT AS anio, count(*) FILTER (WHERE o_orderstatus = 'F') AS "F",
       count(*) FILTER (WHERE o_orderstatus = 'O') AS "O", count(*) FILTER (WHERE o_orderstatus = 'P') AS "P"
FROM orders GROUP BY ALL""")
def category_pivot(spark, d):
    o = tables.table(spark, d, "orders")
    return tidy(Pr.count_pivot(o, F.year("o_orderdate").alias("anio"), "o_orderstatus"))


@query("A9_top12_by_year", """
WITH top AS (SELECT o_custkey FROM orders GROUP BY o_custkey ORDER BY count(*) DESC, o_custkey LIMIT 12)
SELECT o_custkey, """ + ", ".join(
    f"round(count(*) FILTER (WHERE year(o_orderdate) = {y}) / 1000, 6) AS y{y}" for y in YEARS) + """
FROM orders WHERE o_custkey IN (SELECT o_custkey FROM top) GROUP BY o_custkey""")
def top12_by_year(spark, d):
    return tidy(Pr.top_by_year(tables.table(spark, d, "orders"), "o_custkey", "o_orderdate"))


_LI = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _profile_sql(table: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS columna, '{t}' AS tipo, count(*) - count({c}) AS nulos, "
        f"round((count(*) - count({c})) / count(*) * 100, 2) AS pct_nulos, count(DISTINCT {c}) AS valores_distintos, "
        f"substr(min(CAST({c} AS VARCHAR)), 1, 28) AS ejemplo FROM {table}" for c, t in columns.items())


@query("A15_column_profile", _profile_sql("orders", {
    "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"}))
def column_profile(spark, d):
    return Q.column_profile(tables.table(spark, d, "orders"))


@query("A15_column_examples", f"""WITH {FLIGHTS}
SELECT 'numero_vuelo' AS columna, count(*) - count(numero_vuelo) AS nulos, min(numero_vuelo) AS ejemplo FROM flights
UNION ALL SELECT 'modelo_avion', count(*) - count(modelo_avion), min(modelo_avion) FROM flights
UNION ALL SELECT 'actividad_cod', count(*) - count(actividad_cod), min(actividad_cod) FROM flights""")
def column_examples(spark, d):
    f = tables.flights(spark, d)
    return Q.column_profile(f, ["numero_vuelo", "modelo_avion", "actividad_cod"]).select("columna", "nulos", "ejemplo")


@query("A16_describe", " UNION ALL ".join(
    f"SELECT '{c}' AS variable, count({c}) AS n, round(avg({c}), 2) AS media, round(stddev_samp({c}), 2) AS desv_estandar, "
    f"round(min({c}), 2) AS minimo, " + ", ".join(
        f"round(quantile_cont({c}, {p}), 2) AS {n}" for p, n in zip(Q.DESCRIBE_PROBS, Q.DESCRIBE_NAMES))
    + f", round(max({c}), 2) AS maximo FROM lineitem" for c in _LI))
def describe(spark, d):
    return Q.describe(tables.table(spark, d, "lineitem"), _LI)


_FENCES = """q AS (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS q2, quantile_cont({c}, 0.75) AS q3 FROM {t}),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)"""


@query("A17_outlier_summary", f"""WITH {CLEAN},
{_FENCES.format(c='pmd', t='clean')}
SELECT 'pmd' AS variable, round(any_value(q1), 4) AS q1, round(any_value(q3), 4) AS q3, round(any_value(q3 - q1), 4) AS iqr,
       round(any_value(lo), 4) AS limite_inferior, round(any_value(hi), 4) AS limite_superior,
       count(*) FILTER (WHERE pmd < lo) AS outliers_inferiores, count(*) FILTER (WHERE pmd > hi) AS outliers_superiores,
       round(100 * (count(*) FILTER (WHERE pmd < lo OR pmd > hi)) / count(pmd), 2) AS pct_outliers,
       round(max(pmd), 4) AS maximo, round(min(pmd), 4) AS minimo FROM clean, f""")
def outliers(spark, d):
    # Cleaned once, for the scans of the quartiles and of what lies outside the fences.
    cleaned = stored(prepare.preprocess_log(tables.flights(spark, d)).select("pmd"))
    return Q.outlier_summary(cleaned, "pmd", places=4)


@query("A18_extreme_values", "SELECT l_extendedprice AS valor FROM lineitem ORDER BY 1 DESC LIMIT 8")
def extremes(spark, d):
    return Q.extreme_values(tables.table(spark, d, "lineitem"), "l_extendedprice", 8)


@query("A19_A20_duplicates", """
WITH a AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
             l_tax, l_returnflag, l_linestatus, l_shipdate),
     b AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
SELECT 'filas_identicas' AS tipo, sum(n - 1)::BIGINT AS cantidad, round(100 * sum(n - 1) / sum(n), 3) AS pct_total FROM a
UNION ALL SELECT 'llave_de_negocio', sum(n - 1)::BIGINT, round(100 * sum(n - 1) / sum(n), 3) FROM b""")
def duplicates(spark, d):
    return Q.duplicate_summary(tables.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("A21_heavy_tail_models", f"""WITH {FLIGHTS}
SELECT modelo_avion, count(*) AS operaciones, max(pmd) AS pmd_max FROM flights WHERE pmd > 5 AND pmd <= 20
GROUP BY 1 ORDER BY operaciones DESC, modelo_avion LIMIT 5""")
def heavy_tail(spark, d):
    return Q.heavy_models(tables.flights(spark, d), 5.0, 20.0, ["modelo_avion"], 5, "pmd_max")


@query("A22_impossible_unit_models", f"""WITH {FLIGHTS}
SELECT modelo_avion, modelo_avion_desc, count(*) AS operaciones, max(pmd) AS pmd_registrado FROM flights WHERE pmd > 20
GROUP BY 1, 2 ORDER BY operaciones DESC, modelo_avion, modelo_avion_desc LIMIT 6""")
def impossible_unit(spark, d):
    return Q.heavy_models(
        tables.flights(spark, d), 20.0, None, ["modelo_avion", "modelo_avion_desc"], 6, "pmd_registrado")


@query("A23_disguised_zeros", f"WITH {FLIGHTS} SELECT count(*) FILTER (WHERE pmd = 0) AS ceros FROM flights")
def disguised_zeros(spark, d):
    return Q.disguised_zeros(tables.flights(spark, d), "pmd")


@query("A24_imputed_share", f"""WITH {CLEAN}
SELECT sum(pmd_fue_imputado)::BIGINT AS imputados, round(100 * avg(pmd_fue_imputado), 2) AS pct_imputados FROM clean""")
def imputed_share(spark, d):
    return Q.imputed_share(prepare.preprocess_log(tables.flights(spark, d)), "pmd_fue_imputado")


_PAIRS = [(a, b) for i, a in enumerate(_LI) for b in _LI[i + 1:]]


@query("A26_correlations", " UNION ALL ".join(
    f"SELECT '{a}' AS variable_a, '{b}' AS variable_b, round(corr({a}, {b}), 6) AS r FROM lineitem" for a, b in _PAIRS))
def correlations(spark, d):
    return tidy(Pr.correlations(tables.table(spark, d, "lineitem"), _LI))


@query("A27_histogram", """
WITH r AS (SELECT min(log10(l_extendedprice)) AS lo, max(log10(l_extendedprice)) AS hi FROM lineitem),
b AS (SELECT least(floor((log10(l_extendedprice) - lo) / ((hi - lo) / 100)) + 1, 100)::BIGINT AS bin, lo, hi FROM lineitem, r)
SELECT bin, round(lo + (hi - lo) / 100 * (bin - 1), 6) AS desde, count(*) AS n,
       round(count(*) / (sum(count(*)) OVER () * ((hi - lo) / 100)), 6) AS densidad FROM b GROUP BY bin, lo, hi""")
def histogram(spark, d):
    return tidy(Q.histogram(tables.table(spark, d, "lineitem"), F.log10("l_extendedprice"), 100))


@query("A27_histogram_by_group", f"""WITH {CLEAN},
v AS (SELECT pmd_fue_imputado, least(pmd, 500.0::DOUBLE) AS x FROM clean),
r AS (SELECT pmd_fue_imputado, min(x) AS lo, max(x) AS hi FROM v GROUP BY 1),
b AS (SELECT pmd_fue_imputado, least(floor((x - lo) / ((hi - lo) / 80)) + 1, 80)::BIGINT AS bin, lo, hi FROM v JOIN r USING (pmd_fue_imputado))
SELECT pmd_fue_imputado, bin, round(lo + (hi - lo) / 80 * (bin - 1), 6) AS desde, count(*) AS n,
       round(count(*) / (sum(count(*)) OVER (PARTITION BY pmd_fue_imputado) * ((hi - lo) / 80)), 6) AS densidad
FROM b GROUP BY pmd_fue_imputado, bin, lo, hi""")
def histogram_by_group(spark, d):
    log = prepare.preprocess_log(tables.flights(spark, d))
    return tidy(Q.histogram(log, clip("pmd", high=500.0), 80, by="pmd_fue_imputado"))


@query("A28_box_statistics", f"""WITH {_FENCES.format(c='l_extendedprice', t='lineitem')}
SELECT 'l_extendedprice' AS variable, round(any_value(q1), 6) AS q1, round(any_value(q2), 6) AS mediana, round(any_value(q3), 6) AS q3,
       min(l_extendedprice) FILTER (WHERE l_extendedprice >= lo) AS bigote_inferior,
       max(l_extendedprice) FILTER (WHERE l_extendedprice <= hi) AS bigote_superior,
       count(*) FILTER (WHERE l_extendedprice < lo OR l_extendedprice > hi) AS atipicos FROM lineitem, f""")
def box_statistics(spark, d):
    return tidy(Q.box_statistics(tables.table(spark, d, "lineitem"), "l_extendedprice"))


@query("A29_null_rates", f"""WITH {FLIGHTS}
SELECT * FROM (
  SELECT 'numero_vuelo' AS columna, round((count(*) - count(numero_vuelo)) / count(*) * 100, 2) AS pct_nulos FROM flights
  UNION ALL SELECT 'pmd', round((count(*) - count(pmd)) / count(*) * 100, 2) FROM flights
  UNION ALL SELECT 'matricula', round((count(*) - count(matricula)) / count(*) * 100, 2) FROM flights)
WHERE pct_nulos > 0""")
def null_rates(spark, d):
    return Q.null_rates(tables.flights(spark, d))


@query("A30_temporal_coverage", f"""WITH {FLIGHTS}
SELECT 'dt_operacion' AS columna, min(CAST(dt_operacion AS DATE)) AS desde, max(CAST(dt_operacion AS DATE)) AS hasta FROM flights""")
def temporal_coverage(spark, d):
    return Q.temporal_coverage(tables.flights(spark, d))


@query("A31_cardinality", f"""WITH {FLIGHTS} """ + " UNION ALL ".join(
    f"SELECT '{c}' AS columna, count(DISTINCT {c}) AS valores_distintos FROM flights"
    for c in Q.CATEGORICAL_COLUMNS if c != "internacional_domestico"))
def cardinality(spark, d):
    return Q.cardinality(tables.flights(spark, d))


# The estimates of all years' sketches together, and of each year's, lie within four standard errors of exact counts.
@query("A31_cardinality_by_year", f"""WITH p AS (SELECT year(o_orderdate)::BIGINT AS anio, o_custkey, o_orderpriority, o_orderdate FROM orders),
""" + "u AS (" + " UNION ALL ".join(
    f"SELECT anio, '{c}' AS columna, count(*) AS n, count(DISTINCT {c}) AS exactos FROM p GROUP BY ROLLUP (anio)"
    for c in ("o_custkey", "o_orderpriority", "o_orderdate")) + ") SELECT anio, columna, n, exactos, true AS cerca FROM u")
def cardinality_by_year(spark, d):
    orders = tables.table(spark, d, "orders").withColumn("anio", F.year("o_orderdate").cast("long"))
    columns = ["o_custkey", "o_orderpriority", "o_orderdate"]
    sketches = stored(Q.distinct_sketches(orders, ["anio"], columns))
    whole = Q.merged_cardinality(sketches).withColumn("anio", F.lit(None).cast("long"))
    estimates = Q.merged_cardinality(sketches, ["anio"]).unionByName(whole)
    years = orders.select(*[F.col(c).cast("string").alias(c) for c in columns], "anio").unpivot(
        ["anio"], columns, "columna", "valor").distinct()
    exact = years.groupBy("anio", "columna").agg(F.count("valor").alias("exactos")).unionByName(
        years.groupBy("columna").agg(F.count_distinct("valor").alias("exactos")).withColumn("anio", F.lit(None).cast("long")))
    both = estimates.alias("e").join(exact.alias("x"), F.expr("e.columna = x.columna and e.anio <=> x.anio"))
    near = F.abs(F.col("valores_distintos") - F.col("exactos")) <= 4 * 1.04 / 2 ** (Q.SKETCH_PRECISION / 2) * F.col("exactos")
    return both.select("e.anio", "e.columna", "n", "exactos", near.alias("cerca"))


@query("A36_concentration", """
SELECT l_suppkey, count(*) AS n, round(count(*) / (SELECT count(l_suppkey) FROM lineitem), 6) AS participacion
FROM lineitem GROUP BY l_suppkey ORDER BY n DESC, l_suppkey LIMIT 10""")
def concentration(spark, d):
    return tidy(Pr.concentration(tables.table(spark, d, "lineitem"), "l_suppkey", 10))


@query("A36_year_over_year", """
WITH y AS (SELECT year(o_orderdate)::BIGINT AS anio, count(*) AS vuelos FROM orders GROUP BY ALL)
SELECT anio, vuelos, round((vuelos - lag(vuelos) OVER (ORDER BY anio)) / lag(vuelos) OVER (ORDER BY anio), 6) AS variacion FROM y""")
def year_over_year(spark, d):
    return tidy(Pr.year_over_year(tables.table(spark, d, "orders"), "o_orderdate"))


@query("W5_top_n_per_group", """
WITH n AS (SELECT c_mktsegment, o_custkey, count(*) AS vuelos FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
SELECT c_mktsegment, o_custkey, vuelos, row_number() OVER (PARTITION BY c_mktsegment ORDER BY vuelos DESC, o_custkey) AS puesto
FROM n QUALIFY puesto <= 4""")
def top_per_group(spark, d):
    o, c = tables.table(spark, d, "orders"), tables.table(spark, d, "customer")
    n = o.groupBy("o_custkey").agg(F.count("*").alias("vuelos")).join(c, F.col("o_custkey") == F.col("c_custkey"))
    ranked = Pr.top_per_group(
        n.select("c_mktsegment", "o_custkey", "vuelos"), "c_mktsegment", [F.col("vuelos").desc(), F.col("o_custkey")], 4)
    return tidy(ranked)


@query("L1_value_counts_top", """
SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey ORDER BY n DESC, l_partkey LIMIT 15""")
def value_counts(spark, d):
    return filters.top_values(tables.table(spark, d, "lineitem"), "l_partkey", 15)


@query("L2_sort_by_measure_head", """
SELECT l_suppkey, count(*) AS n, round(sum(l_extendedprice), 2) AS total FROM lineitem
GROUP BY l_suppkey ORDER BY n DESC, l_suppkey LIMIT 6""")
def measure_head(spark, d):
    g = tables.table(spark, d, "lineitem").groupBy("l_suppkey").agg(
        F.count("*").alias("n"), F.sum("l_extendedprice").alias("total"))
    return tidy(filters.head_by(g, [F.col("n").desc(), F.col("l_suppkey")], 6), 2)


@query("L3_arg_max", """
SELECT arg_max(l_suppkey, n) AS l_suppkey, max(n) AS n FROM (
  SELECT l_suppkey, count(*) * 1000000 - l_suppkey AS n FROM lineitem GROUP BY l_suppkey)""")
def arg_max(spark, d):
    g = tables.table(spark, d, "lineitem").groupBy("l_suppkey").agg(
        (F.count("*") * 1000000 - F.col("l_suppkey")).alias("n"))
    return g.agg(F.max_by("l_suppkey", "n").alias("l_suppkey"), F.max("n").alias("n"))


@query("L4_full_sort", f"""WITH {DAILY} SELECT fecha, prcp, wspd FROM daily ORDER BY prcp DESC NULLS LAST, fecha""")
def full_sort(spark, d):
    daily = tables.daily_weather(spark, d).select("fecha", "prcp", "wspd")
    return daily.orderBy(F.col("prcp").desc_nulls_last(), "fecha")
