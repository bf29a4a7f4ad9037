"""The workload's tables (flight log, daily and hourly weather, monthly counts) drawn from stored tables.

A projection of ``events`` gives a flight log with every trait the operators care about: times around
midnight, two slots per flight, late flights, missing flight numbers, missing and zero weights, and a
model without any weight. Rows and groups grow with ``events``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.functions.cleaning import nan_to_null
from slotwise.operators.timetable import delay_target
from slotwise.operators.weather import join_weather, prepare_weather


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_FLIGHTS = """
SELECT event_id,
       CAST(CAST(ts AS DATE) AS TIMESTAMP_NTZ) + make_dt_interval(0, 0, CAST(m AS INT)) AS dt_operacion,
       concat('A', user_id % 7) AS aeropuerto_oaci,
       event_type AS aerolinea_dgac,
       CASE WHEN event_id % 53 = 0 THEN NULL ELSE CAST(user_id % 3 AS STRING) END AS numero_vuelo,
       CASE WHEN event_id % 2 = 0 THEN 'A' ELSE 'D' END AS tipo_operacion,
       CASE WHEN event_id % 9 = 0 THEN 'N' ELSE 'U' END AS actividad_cod,
       concat('M', user_id % 23) AS modelo_avion,
       concat('modelo ', user_id % 23) AS modelo_avion_desc,
       concat('T', user_id) AS matricula,
       user_id % 8 = 0 AS es_internacional,
       CASE WHEN user_id % 23 = 22 OR event_id % 37 = 0 THEN NULL
            WHEN event_id % 41 = 0 THEN 0 ELSE value END AS pmd
FROM (SELECT *, pmod((user_id % 3) * 477 + 476 + IF(user_id % 5 = 0, 600, 0) + (event_id * 7919) % 41 - 20
                     + IF(event_id % 11 = 0, 25 + event_id % 150, 0), 1440) AS m
      FROM {events})
"""

_WEATHER = """
SELECT fecha, tavg, tavg - 3 - dd % 4 AS tmin, tavg + 4 + dd % 5 AS tmax,
       CASE WHEN dd % 5 = 0 THEN NULL ELSE greatest((dd * 7) % 23 - 5, 0) END AS prcp,
       CAST(NULL AS DOUBLE) AS snow,
       CASE WHEN dd % 13 = 0 THEN NULL ELSE (dd * 37) % 360 END AS wdir,
       5 + (dd * 17) % 45 AS wspd, 1005 + dd % 25 AS pres
FROM (SELECT fecha, day(fecha) AS dd, 8 + day(fecha) % 9 AS tavg
      FROM (SELECT DISTINCT CAST(ts AS DATE) AS fecha FROM {events}))
"""

_HOURLY = """
SELECT concat('A', user_id % 7) AS aeropuerto_oaci, date_trunc('HOUR', ts) AS lectura,
       CAST(max(value) AS DOUBLE) AS temp
FROM {events}
GROUP BY 1, 2
"""


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nan_to_null(spark.sql(_FLIGHTS, events=table(spark, sf_dir, "events")))


def daily_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = spark.sql(_WEATHER, events=table(spark, sf_dir, "events"))
    numbers = ["tavg", "tmin", "tmax", "prcp", "wdir", "wspd", "pres"]
    return raw.withColumns({c: F.col(c).cast("double") for c in numbers})


def hourly_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = spark.sql(_HOURLY, events=table(spark, sf_dir, "events"))
    return hourly.withColumn("lectura", F.col("lectura").cast("timestamp_ntz"))


def target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regular flights with their delay label."""
    return delay_target(flights(spark, sf_dir).filter(F.col("actividad_cod") == "U"))


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_weather(daily_weather(spark, sf_dir))


def joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_weather(target(spark, sf_dir), weather(spark, sf_dir))
