"""Daily weather: operational variables, the join to flights, and the effect on the delay rate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotwise.functions import binning as B
from slotwise.functions import cleaning as C
from slotwise.functions import wind
from slotwise.operators.sizing import broadcast_if_small, require_columns

# The columns of the prepared weather, in order.
WEATHER_COLUMNS = [
    "fecha_cruce", "tavg", "tmin", "tmax", "amplitud_termica", "prcp", "dia_lluvioso",
    "wspd", "wdir", "viento_cruzado", "viento_frontal", "pres",
]


def prepare_weather(daily: DataFrame, heading: float = 170, rainy_mm: float = 1.0) -> DataFrame:
    """Join date, filled rain, daily range, wind across and along the runway, rainy-day flag."""
    require_columns(daily, ["fecha", "tavg", "tmin", "tmax", "prcp", "wdir", "wspd", "pres"])
    return (
        C.nan_to_null(daily)
        .withColumns({
            "fecha_cruce": F.to_date("fecha"),
            "prcp": F.coalesce(F.col("prcp"), F.lit(0.0)),
            "amplitud_termica": F.col("tmax") - F.col("tmin"),
            "viento_cruzado": wind.cross_wind("wspd", "wdir", heading),
            "viento_frontal": wind.head_wind("wspd", "wdir", heading),
        })
        .withColumn("dia_lluvioso", C.exceeds("prcp", rainy_mm))
        .select(WEATHER_COLUMNS)
    )


def join_weather(flights: DataFrame, weather: DataFrame) -> DataFrame:
    """Left join on the day; one weather row per day, so no flight is lost or repeated."""
    return flights.join(broadcast_if_small(weather), on="fecha_cruce", how="left")


def weather_coverage(joined: DataFrame, warn_above: float = 0.05) -> DataFrame:
    """Flights, share without weather, and whether that share is too large."""
    return joined.agg(
        F.count("*").alias("vuelos"), C.share(F.col("tavg").isNull()).alias("sin_clima")
    ).withColumn("aviso", F.col("sin_clima") > warn_above)


def weather_effect(joined: DataFrame) -> DataFrame:
    """Flights, delay rate and points against the base rate per band of rain and of cross wind.

    Both variables are counted in one pass: every flight gives one row per variable, merged on the
    map side into a handful of band counts. The base rate is the total of those same counts.
    """
    known = joined.filter(F.col("tavg").isNotNull())
    tagged = known.select(
        "retraso",
        F.explode(F.array(
            F.struct(F.lit("lluvia_mm").alias("variable"),
                     B.band("prcp", B.RAIN_EDGES, B.RAIN_LABELS).alias("rango")),
            F.struct(F.lit("viento_cruzado_kmh").alias("variable"),
                     B.band("viento_cruzado", B.WIND_EDGES, B.WIND_LABELS).alias("rango")),
        )).alias("b"),
    ).select("retraso", "b.variable", "b.rango")
    counts = tagged.groupBy("variable", "rango").agg(
        F.count("*").alias("n_vuelos"), F.sum("retraso").alias("_late")
    )
    whole = W.partitionBy("variable")  # six rows per variable
    base = F.sum("_late").over(whole) / F.sum("n_vuelos").over(whole)
    rate = F.col("_late") / F.col("n_vuelos")
    return (
        counts.withColumns({"_base": base, "_rate": rate})
        .filter(F.col("rango").isNotNull())
        .select(
            "variable", "rango", "n_vuelos",
            F.round("_rate", 4).alias("tasa_retraso"),
            F.round((F.col("_rate") - F.col("_base")) * 100, 2).alias("puntos_vs_base"),
        )
    )


def rainy_share(weather: DataFrame) -> DataFrame:
    """Share of days with any rain, and with more than the rainy-day threshold."""
    return weather.agg(
        F.count("*").alias("dias"),
        C.share(F.col("prcp") > 0).alias("pct_con_lluvia"),
        F.avg(F.col("dia_lluvioso").cast("double")).alias("pct_dia_lluvioso"),
    )


def wind_alert(joined: DataFrame, above_kmh: float = 30) -> DataFrame:
    """Rows whose cross wind is over the contingency threshold."""
    return joined.filter(F.col("viento_cruzado") > above_kmh)


def feed_coverage(feed: DataFrame, day: str, date_from: str, date_to: str) -> DataFrame:
    """Expected and found days of a daily feed in ``[date_from, date_to)``."""
    inside = feed.filter((F.col(day) >= F.lit(date_from).cast("date")) & (F.col(day) < F.lit(date_to).cast("date")))
    expected = F.datediff(F.lit(date_to), F.lit(date_from)).cast("long")
    return inside.agg(F.count_distinct(day).alias("encontrados")).select(
        expected.alias("esperados"), "encontrados", (expected - F.col("encontrados")).alias("faltantes")
    )


def missing_days(feed: DataFrame, day: str, date_from: str, date_to: str) -> DataFrame:
    """Calendar days of ``[date_from, date_to)`` with no row in the feed."""
    spark = feed.sparkSession
    span = spark.range(1).select(F.explode(F.sequence(
        F.lit(date_from).cast("date"), F.date_sub(F.lit(date_to).cast("date"), 1)
    )).alias(day))
    return span.join(feed.select(day).distinct(), on=day, how="left_anti")


def column_coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    """Percentage of rows with a value, one row per column."""
    one = df.agg(*[(F.avg(F.col(c).isNotNull().cast("double")) * 100).alias(c) for c in columns])
    return one.unpivot([], columns, "columna", "pct_con_dato")
