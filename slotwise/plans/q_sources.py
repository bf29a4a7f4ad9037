"""Scans, sources and sinks over stored tables."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from slotwise.operators import enrich, prepare, weather
from slotwise.operators.fitted import border_pipeline, fit_codes, fit_pipeline, risk_pipeline
from slotwise.operators.quality import fact, inventory_summary, null_rates
from slotwise.plans import tables
from slotwise.plans.registry import query, tidy
from slotwise.plans.sql import DAILY, FLIGHTS, JOINED
from slotwise.session import scratch_path
from slotwise.sources import files, readers, sinks


@query("S1_parquet_scan", "SELECT * FROM orders")
def parquet_scan(spark, d):
    return readers.read_parquet(spark, f"{d}/orders.parquet")


@query("S2_csv_scan", """
SELECT (year(o_orderdate) * 100 + month(o_orderdate))::BIGINT AS mes_id, o_orderpriority AS aeropuerto_oaci,
       CASE WHEN o_orderstatus = 'F' THEN 'I' ELSE 'D' END AS internacional_domestico,
       count(*)::DOUBLE AS cnt_operaciones
FROM orders GROUP BY ALL
""")
def csv_scan(spark, d):
    path = scratch_path(spark, "ops-csv")
    _monthly(spark, d).write.csv(path, header=True)
    return readers.read_monthly_ops(spark, path)


def _monthly(spark, d):
    o = tables.table(spark, d, "orders")
    return o.groupBy(
        (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("long").alias("mes_id"),
        F.col("o_orderpriority").alias("aeropuerto_oaci"),
        F.when(F.col("o_orderstatus") == "F", "I").otherwise("D").alias("internacional_domestico"),
    ).agg(F.count("*").cast("double").alias("cnt_operaciones"))


_FEED = readers.WEATHER_FEED


def _feed(spark, d):
    daily = tables.daily_weather(spark, d)
    return daily.select(*[
        F.col(c) if c in daily.columns else F.lit(None).cast("double").alias(c) for c in _FEED
    ])


_FEED_SQL = f"""WITH {DAILY}
SELECT fecha, tavg, tmin, tmax, prcp, snow, wdir, wspd, CAST(NULL AS DOUBLE) AS wpgt, pres, CAST(NULL AS DOUBLE) AS tsun
FROM daily"""


@query("S3_csv_date_scan", _FEED_SQL)
def csv_date_scan(spark, d):
    path = scratch_path(spark, "weather-csv")
    _feed(spark, d).write.csv(path, header=True, dateFormat="yyyy-MM-dd")
    return readers.read_weather_csv(spark, path)


@query("S4_headerless_gzip_feed", _FEED_SQL + """
WHERE fecha >= DATE '2024-01-05' AND fecha < DATE '2024-01-25'""")
def gzip_feed(spark, d):
    path = scratch_path(spark, "weather-gz")
    _feed(spark, d).write.csv(path, header=False, compression="gzip", dateFormat="yyyy-MM-dd")
    return readers.read_weather_feed(spark, path, "2024-01-05", "2024-01-25")


@query("S5_feed_coverage", """
WITH found AS (SELECT count(DISTINCT CAST(o_orderdate AS DATE)) AS n FROM orders
               WHERE o_orderdate >= DATE '1995-01-01' AND o_orderdate < DATE '2003-01-01')
SELECT 2922::BIGINT AS esperados, n AS encontrados, 2922 - n AS faltantes FROM found
""")
def feed_coverage(spark, d):
    days = tables.table(spark, d, "orders").select(F.to_date("o_orderdate").alias("fecha"))
    return weather.feed_coverage(days, "fecha", "1995-01-01", "2003-01-01")


@query("S5_missing_days", """
SELECT CAST(g AS DATE) AS fecha FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2002-12-31', INTERVAL 1 DAY) t(g)
WHERE CAST(g AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)
""")
def missing_days(spark, d):
    days = tables.table(spark, d, "orders").select(F.to_date("o_orderdate").alias("fecha"))
    return weather.missing_days(days, "fecha", "1995-01-01", "2003-01-01")


@query("S5_column_coverage", f"""WITH {DAILY}
SELECT columna, round(pct * 100, 6) AS pct_con_dato FROM (
  SELECT avg(CASE WHEN tavg IS NULL THEN 0.0 ELSE 1.0 END) AS tavg, avg(CASE WHEN prcp IS NULL THEN 0.0 ELSE 1.0 END) AS prcp,
         avg(CASE WHEN wdir IS NULL THEN 0.0 ELSE 1.0 END) AS wdir, avg(CASE WHEN snow IS NULL THEN 0.0 ELSE 1.0 END) AS snow
  FROM daily) UNPIVOT (pct FOR columna IN (tavg, prcp, wdir, snow))
""")
def column_coverage(spark, d):
    return tidy(weather.column_coverage(tables.daily_weather(spark, d), ["tavg", "prcp", "wdir", "snow"]))


@query("S6_projected_filtered_scan", """
SELECT l_orderkey, l_extendedprice, l_shipdate FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 10
""")
def projected_scan(spark, d):
    li = tables.table(spark, d, "lineitem")
    return readers.project(
        li, ["l_orderkey", "l_extendedprice", "l_shipdate"],
        (F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 10),
    )


@query("S7_partial_read", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 20")
def partial_read(spark, d):
    return readers.first_rows(tables.table(spark, d, "orders"), 20, ["o_orderkey"])


@query("S8_partitioned_parquet_sink", """
SELECT year(o_orderdate)::BIGINT AS anio, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY ALL
""")
def parquet_sink(spark, d):
    o = tables.table(spark, d, "orders").withColumn("anio", F.year("o_orderdate"))
    back = sinks.save_table(o, scratch_path(spark, "orders"), ["anio"])
    return tidy(back.groupBy("anio").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total")), 2)


@query("S9_file_inventory")
def file_inventory(spark, d):
    """The files of every table, with the rows read from each."""
    index = files.file_index(spark, d)
    names = sorted(r["ruta_relativa"] for r in index.filter("formato = 'parquet'").collect())
    rows = enrich.stack([
        spark.read.parquet(f"{d}/{n}").agg(F.count("*").alias("filas")).select(F.lit(n).alias("ruta_relativa"), "filas")
        for n in names
    ])
    return index.join(rows, on="ruta_relativa", how="left")


@query("S9_csv_sample_profile")
def csv_sample_profile(spark, d):
    folder = scratch_path(spark, "raw")
    _monthly(spark, d).write.csv(f"{folder}/ops", header=True)
    return files.profile_csv_sample(spark, folder)


@query("A32_inventory_summary")
def inventory(spark, d):
    o = tables.table(spark, d, "orders")
    rates = null_rates(o).select(*fact("orders", "columna", F.col("pct_nulos")))
    return inventory_summary(files.file_index(spark, d), rates)


@query("S10_model_persistence", """
SELECT count(*) AS filas, 0::BIGINT AS distintas, count(*) FILTER (p_size IS NULL OR p_retailprice IS NULL) AS sin_grupo FROM part
""")
def model_persistence(spark, d):
    points = tables.table(spark, d, "part").select("p_partkey", "p_size", "p_retailprice")
    stages = [VectorAssembler(inputCols=["p_size", "p_retailprice"], outputCol="features"),
              KMeans(k=3, seed=42, predictionCol="cluster")]
    fitted = Pipeline(stages=stages).fit(points)
    path = scratch_path(spark, "kmeans")
    sinks.save_model(fitted, path)
    # Every row scored by the fitted pipeline and by the one read back.
    again = sinks.load_pipeline(path).transform(fitted.transform(points).withColumnsRenamed(
        {"cluster": "antes", "features": "antes_features"}))
    return again.agg(
        F.count("*").alias("filas"), F.count_if(~F.col("cluster").eqNullSafe(F.col("antes"))).alias("distintas"),
        F.count_if(F.col("cluster").isNull()).alias("sin_grupo"))


def _agree(before, after, key):
    """Rows scored by a fitted pipeline and by the same one read back, and how many differ."""
    p = vector_to_array("probability")[1]
    a = before.select(key, p.alias("antes"))
    b = after.select(key, p.alias("despues"))
    return a.join(b, key, "full").agg(
        F.count("*").alias("filas"), F.count_if(~F.col("antes").eqNullSafe(F.col("despues"))).alias("distintas"),
        F.count_if(F.coalesce(~F.col("despues").between(0, 1), F.lit(True))).alias("sin_probabilidad"))


@query("S10_M20_risk_model_scores_raw_flights", f"""WITH {JOINED}
SELECT count(*) AS filas, 0::BIGINT AS distintas, 0::BIGINT AS sin_probabilidad FROM joined""")
def risk_scores(spark, d):
    """The risk model with its codes, medians and moments, saved, read back, and given flights as they come."""
    flights = tables.joined(spark, d).persist()
    line = LogisticRegression(labelCol="retraso", weightCol="peso", maxIter=30, regParam=0.01)
    fitted = fit_pipeline(risk_pipeline(line, scaled=True), flights.filter("tavg IS NOT NULL"), "retraso")
    path = scratch_path(spark, "risk")
    sinks.save_model(fitted, path)
    return _agree(fitted.transform(flights), sinks.load_pipeline(path).transform(flights), "event_id")


@query("S10_M20_forest_scores_raw_flights", """
SELECT count(*) AS filas, 0::BIGINT AS distintas, 0::BIGINT AS sin_probabilidad FROM events""")
def forest_scores(spark, d):
    log = prepare.preprocess_log(tables.flights(spark, d)).persist()
    trees = RandomForestClassifier(labelCol="es_internacional", weightCol="peso", numTrees=20, maxDepth=6, maxBins=64, seed=42)
    fitted = fit_pipeline(border_pipeline(trees), log.withColumn("es_internacional", F.col("es_internacional").cast("int")),
                          "es_internacional")
    path = scratch_path(spark, "forest")
    sinks.save_model(fitted, path)
    return _agree(fitted.transform(log), sinks.load_pipeline(path).transform(log), "event_id")


@query("P21_P22_codes_learnt_once", f"""WITH {FLIGHTS},
codes AS (SELECT modelo_avion, row_number() OVER (ORDER BY modelo_avion) - 1 AS c FROM
  (SELECT DISTINCT modelo_avion FROM flights WHERE modelo_avion NOT IN ('M3', 'M11')))
SELECT f.modelo_avion, coalesce(c, (SELECT max(c) + 1 FROM codes))::BIGINT AS modelo_cod, count(*) AS n
FROM flights f LEFT JOIN codes USING (modelo_avion) WHERE tipo_operacion = 'D' AND f.modelo_avion <> 'M0' GROUP BY ALL""")
def codes_learnt_once(spark, d):
    """Codes learnt from one table, saved, and given to another, with values missing here and others never seen there."""
    log = tables.flights(spark, d)
    path = scratch_path(spark, "codes")
    sinks.save_model(fit_codes(log.filter(~F.col("modelo_avion").isin("M3", "M11")), {"modelo_avion": "modelo_cod"}), path)
    coded = sinks.load_pipeline(path).transform(log.filter("tipo_operacion = 'D' AND modelo_avion <> 'M0'"))
    return coded.groupBy("modelo_avion", "modelo_cod").agg(F.count("*").alias("n"))


@query("S11_report_facts_sink", """
SELECT 'orders' AS categoria, o_orderstatus AS clave, CAST(count(*) AS VARCHAR) AS valor FROM orders GROUP BY o_orderstatus
""")
def report_sink(spark, d):
    counts = tables.table(spark, d, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    return sinks.save_facts(counts.select(*fact("orders", F.col("o_orderstatus"), F.col("n"))), scratch_path(spark, "facts"))


@query("U1_concatenate_facts", """
SELECT 'orders' AS categoria, 'filas' AS clave, CAST(count(*) AS VARCHAR) AS valor FROM orders
UNION ALL SELECT 'lineitem', 'filas', CAST(count(*) AS VARCHAR) FROM lineitem
""")
def concatenate_facts(spark, d):
    return enrich.stack([
        tables.table(spark, d, name).agg(F.count("*").alias("n")).select(*fact(name, "filas", F.col("n")))
        for name in ("orders", "lineitem")
    ])


@query("U2_stack_tagged_tables", """
SELECT 'estado' AS variable, o_orderstatus AS valor, count(*) AS n FROM orders GROUP BY o_orderstatus
UNION ALL SELECT 'prioridad', o_orderpriority, count(*) FROM orders GROUP BY o_orderpriority
""")
def stack_tagged(spark, d):
    o = tables.table(spark, d, "orders")
    counted = {
        "estado": o.groupBy(F.col("o_orderstatus").alias("valor")).agg(F.count("*").alias("n")),
        "prioridad": o.groupBy(F.col("o_orderpriority").alias("valor")).agg(F.count("*").alias("n")),
    }
    return enrich.stack_tagged(counted)
