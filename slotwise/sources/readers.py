"""Scans. CSV sources carry their schema; missing values are null only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise.functions.cleaning import nan_to_null

# Column order of the headerless daily weather feed.
WEATHER_FEED = ["fecha", "tavg", "tmin", "tmax", "prcp", "snow", "wdir", "wspd", "wpgt", "pres", "tsun"]
WEATHER_SCHEMA = T.StructType(
    [T.StructField("fecha", T.DateType())] + [T.StructField(c, T.DoubleType()) for c in WEATHER_FEED[1:]]
)
MONTHLY_OPS_SCHEMA = T.StructType([
    T.StructField("mes_id", T.LongType()),
    T.StructField("aeropuerto_oaci", T.StringType()),
    T.StructField("internacional_domestico", T.StringType()),
    T.StructField("cnt_operaciones", T.DoubleType()),
])


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return nan_to_null(spark.read.parquet(path))


def read_csv(spark: SparkSession, path: str, schema: T.StructType, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """A CSV with a header; values that do not fit their type become null."""
    return nan_to_null(
        spark.read.option("dateFormat", date_format).csv(path, header=True, schema=schema, enforceSchema=False)
    )


def read_monthly_ops(spark: SparkSession, path: str) -> DataFrame:
    """The monthly operations file; its columns are taken by name, further ones are ignored."""
    names = MONTHLY_OPS_SCHEMA.fieldNames()
    raw = spark.read.csv(path, header=True)
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in MONTHLY_OPS_SCHEMA]).select(names)


def read_weather_csv(spark: SparkSession, path: str) -> DataFrame:
    """Daily weather with a header and an ISO date column."""
    return read_csv(spark, path, WEATHER_SCHEMA)


def read_weather_feed(spark: SparkSession, path: str, date_from: str, date_to: str) -> DataFrame:
    """The headerless (gzip) feed, clipped to ``[date_from, date_to)``."""
    raw = spark.read.option("dateFormat", "yyyy-MM-dd").csv(path, header=False, schema=WEATHER_SCHEMA)
    day = F.col("fecha")
    return nan_to_null(raw).filter(
        (day >= F.lit(date_from).cast("date")) & (day < F.lit(date_to).cast("date"))
    )


def project(df: DataFrame, columns: Sequence[str], where: Column | None = None) -> DataFrame:
    """Chosen columns of chosen rows; both reach the file scan."""
    return (df if where is None else df.filter(where)).select(*columns)


def first_rows(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """A small sample for profiling, fixed by an order."""
    return df.orderBy(*order_by).limit(n)
