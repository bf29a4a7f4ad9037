"""Entity profiles, volumes, indicators and small summary tables.

Deviations are half-minute steps within [-720, 720), so their exact percentiles keep at most 2880
counted values per group and use Spark's own ``percentile``; unbounded columns (weights) go through
``exact_quantiles``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotwise.functions import cleaning as C
from slotwise.operators.filters import among_top, top_values
from slotwise.operators.ranking import exact_quantiles
from slotwise.operators.sizing import broadcast_if_small, drop_null_keys
from slotwise.operators.timetable import FLIGHT, SLOT_KEY

SEVERE_MIN = 60
LATE_MIN = 15

DAY_FEATURES = [
    "n_operaciones", "n_aerolineas", "prcp", "viento_cruzado", "wspd", "tavg", "amplitud_termica", "pres",
]


def _quantile(column: str, p: float) -> Column:
    return F.percentile(column, F.lit(p))


def airport_profile(
    log: DataFrame,
    key: str = "aeropuerto_oaci",
    intl: str = "es_internacional",
    weight: str = "pmd",
    carrier: str = "aerolinea_dgac",
    model: str = "modelo_avion",
    ops: str = "cnt_operaciones",
) -> DataFrame:
    """Volume, share international, median weight, distinct carriers and models, mean monthly count."""
    known = drop_null_keys(log, [key])
    counts = known.groupBy(key).agg(
        F.count(key).alias("total_vuelos"),
        F.avg(F.col(intl).cast("double")).alias("pct_intl"),
        F.count_distinct(carrier).alias("n_aerolineas"),
        F.count_distinct(model).alias("n_modelos"),
        F.avg(ops).alias("cnt_ops_media"),
    )
    medians = exact_quantiles(known, weight, [0.5], ["pmd_mediana"], keys=[key])
    return counts.join(medians, on=key, how="left").select(
        key, "total_vuelos", "pct_intl", "pmd_mediana", "n_aerolineas", "n_modelos", "cnt_ops_media"
    )


def slot_profile(joined: DataFrame, min_ops_slot: int = 30) -> DataFrame:
    """Behaviour of each carrier + flight number + operation type with enough operations."""
    quartiles = F.percentile("desvio_min", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return (
        drop_null_keys(joined, FLIGHT)
        .groupBy(*FLIGHT)
        .agg(
            F.count("*").alias("n_operaciones"),
            F.avg("hora_programada").alias("hora_programada"),
            F.avg(F.col("retraso").cast("double")).alias("tasa_retraso"),
            quartiles.alias("_q"),
            C.share(F.col("desvio_min") > SEVERE_MIN).alias("pct_severo"),
            F.avg(F.col("es_internacional").cast("double")).alias("pct_internacional"),
        )
        .filter(F.col("n_operaciones") >= min_ops_slot)
        .select(
            *FLIGHT, "n_operaciones", "hora_programada", "tasa_retraso",
            F.col("_q")[1].alias("desvio_mediano"),
            (F.col("_q")[2] - F.col("_q")[0]).alias("variabilidad_min"),
            "pct_severo", "pct_internacional",
        )
    )


def day_profile(joined: DataFrame, min_ops_dia: int = 10) -> DataFrame:
    """Load and weather of each complete day, with its delay rate.

    Weather is constant within a day, so its maximum is its first known value.
    """
    weather = ["prcp", "viento_cruzado", "wspd", "tavg", "amplitud_termica", "pres"]
    return (
        drop_null_keys(joined, ["fecha_cruce"])
        .groupBy("fecha_cruce")
        .agg(
            F.count("*").alias("n_operaciones"),
            F.count_distinct("aerolinea_dgac").alias("n_aerolineas"),
            *[F.max(c).alias(c) for c in weather],
            F.avg(F.col("retraso").cast("double")).alias("tasa_retraso"),
        )
        .na.drop(subset=DAY_FEATURES)
        .filter(F.col("n_operaciones") >= min_ops_dia)
    )


def cluster_summary(clustered: DataFrame, cluster: str = "cluster") -> DataFrame:
    return clustered.groupBy(cluster).agg(
        F.count("*").alias("n_aeropuertos"),
        F.sum("total_vuelos").alias("total_vuelos_sum"),
        F.avg("pct_intl").alias("pct_intl_media"),
        F.avg("pmd_mediana").alias("pmd_mediana_media"),
    )


def segment_summary(segments: DataFrame, segment: str = "segmento") -> DataFrame:
    """Slots, flights and means per segment, the critical one (largest mean delay rate) flagged.

    One row per segment, so the totals over all segments are a window over a handful of rows.
    """
    everything = W.partitionBy()
    return (
        segments.groupBy(segment)
        .agg(
            F.count("*").alias("n_slots"),
            F.sum("n_operaciones").alias("vuelos_cubiertos"),
            F.avg("hora_programada").alias("hora_media"),
            F.avg("tasa_retraso").alias("tasa_retraso"),
            F.avg("variabilidad_min").alias("variabilidad_min"),
            F.avg("pct_severo").alias("pct_severo"),
        )
        .withColumns({
            "pct_slots": F.col("n_slots") / F.sum("n_slots").over(everything),
            "pct_vuelos": F.col("vuelos_cubiertos") / F.sum("vuelos_cubiertos").over(everything),
            "es_segmento_critico": (
                F.row_number().over(everything.orderBy(F.col("tasa_retraso").desc(), segment)) == 1
            ).cast("int"),
        })
        .orderBy(F.col("tasa_retraso").desc(), segment)
    )


def flag_critical(segments: DataFrame, segment: str = "segmento") -> DataFrame:
    """Each slot with the flag of its segment."""
    flags = segment_summary(segments, segment).select(segment, "es_segmento_critico")
    return segments.join(broadcast_if_small(flags), on=segment)


def day_type_summary(days: DataFrame, kind: str = "tipo_dia") -> DataFrame:
    """Means per day type, and on every row the spread of the delay rate between types."""
    everything = W.partitionBy()  # one row per day type
    return (
        days.groupBy(kind)
        .agg(
            F.count("*").alias("n_dias"),
            F.avg("n_operaciones").alias("operaciones"),
            F.avg("prcp").alias("lluvia_mm"),
            F.avg("viento_cruzado").alias("viento_cruzado"),
            F.avg("tavg").alias("temperatura"),
            F.avg("tasa_retraso").alias("tasa_retraso"),
        )
        .withColumn(
            "dispersion",
            F.max("tasa_retraso").over(everything) - F.min("tasa_retraso").over(everything),
        )
    )


def yearly_volume(df: DataFrame, ts: str = "dt_operacion") -> DataFrame:
    year = F.year(ts).alias("anio")
    return df.filter(F.col(ts).isNotNull()).groupBy(year).agg(F.count("*").alias("vuelos"))


MOST_COLUMNS = 1000


def _found(df: DataFrame, value: Column) -> list:
    """The values that become columns, in order."""
    rows = df.select(value.alias("v")).filter("v is not null").distinct().limit(MOST_COLUMNS + 1).collect()
    if len(rows) > MOST_COLUMNS:
        raise ValueError(f"more than {MOST_COLUMNS} values to make columns of")
    return sorted(r["v"] for r in rows)


def count_pivot(
    df: DataFrame, row: Column, column: str, values: Sequence[str] | None = None, scale: float | None = None
) -> DataFrame:
    """Counts of ``row`` by each value of ``column`` (all there are, unless listed); a missing pair is zero.

    Rows with a missing value count in no column.
    """
    values = _found(df, F.col(column)) if values is None else values
    counted = [
        F.count_if(F.col(column) == v) / scale if scale else F.count_if(F.col(column) == v) for v in values
    ]
    return df.groupBy(row).agg(*[c.alias(str(v)) for c, v in zip(counted, values)])


def top_by_year(
    df: DataFrame, column: str, ts: str, years: Sequence[int] | None = None, n: int = 12
) -> DataFrame:
    """Thousands of rows per year (all there are, unless listed) for the ``n`` most frequent values."""
    years = _found(df, F.year(ts)) if years is None else years
    best = among_top(df, column, n)
    return best.groupBy(column).agg(
        *[(F.count_if(F.year(ts) == y) / 1000).alias(f"y{y}") for y in years]
    )


def delay_by_hour(joined: DataFrame, at_least: int = 100) -> DataFrame:
    """Flights and delay rate per scheduled hour with enough flights."""
    return (
        joined.filter(F.col("hora_programada").isNotNull())
        .groupBy(F.floor("hora_programada").alias("hora"))
        .agg(F.count("*").alias("n_vuelos"), F.avg(F.col("retraso").cast("double")).alias("tasa_retraso"))
        .filter(F.col("n_vuelos") >= at_least)
    )


def delay_by_year(joined: DataFrame) -> DataFrame:
    return joined.groupBy("anio").agg(
        F.count("*").alias("vuelos"),
        F.round(F.avg(F.col("retraso").cast("double")), 3).alias("tasa_retraso"),
        F.round(_quantile("desvio_min", 0.5), 3).alias("desvio_mediano"),
    )


def main_carriers(joined: DataFrame, n: int = 8) -> DataFrame:
    return (
        drop_null_keys(joined, ["aerolinea_dgac"])
        .groupBy("aerolinea_dgac")
        .agg(
            F.count("*").alias("vuelos"),
            F.round(F.avg(F.col("retraso").cast("double")), 3).alias("tasa_retraso"),
            F.round(_quantile("desvio_min", 0.75), 3).alias("desvio_p75"),
        )
        .orderBy(F.col("vuelos").desc(), "aerolinea_dgac")
        .limit(n)
    )


def target_summary(joined: DataFrame) -> DataFrame:
    q = F.percentile("desvio_min", F.array(F.lit(0.05), F.lit(0.5), F.lit(0.95)))
    return joined.agg(
        F.count("*").alias("vuelos"),
        F.avg(F.col("retraso").cast("double")).alias("tasa_retraso"),
        C.share(F.col("desvio_min") > SEVERE_MIN).alias("tasa_severo"),
        q.alias("_q"),
        F.stddev_samp("desvio_min").alias("desv_estandar"),
    ).select(
        "vuelos", "tasa_retraso", "tasa_severo",
        F.col("_q")[0].alias("desvio_p05"), F.col("_q")[1].alias("desvio_mediano"),
        F.col("_q")[2].alias("desvio_p95"), "desv_estandar",
    )


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson coefficient of every pair of columns over the rows that hold both, in one pass."""
    columns = list(columns)
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    one = numbers.agg(*[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    cells = [
        F.struct(F.lit(a).alias("variable_a"), F.lit(b).alias("variable_b"), F.col(f"r{i}").alias("r"))
        for i, (a, b) in enumerate(pairs)
    ]
    return one.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def punctuality_by_month(joined: DataFrame) -> DataFrame:
    """Share on time, share severely late and late minutes per month."""
    return joined.groupBy("mes_ym").agg(
        F.count("*").alias("vuelos"),
        C.share(F.col("desvio_min") <= LATE_MIN).alias("pct_puntual"),
        C.share(F.col("desvio_min") > SEVERE_MIN).alias("pct_severo"),
        F.sum(F.when(F.col("desvio_min") > LATE_MIN, F.col("desvio_min")).otherwise(0.0)).alias("minutos_atraso"),
    )


def wave_spread(joined: DataFrame, at_least: int = 100) -> DataFrame:
    """Delay rate of the first and of the last scheduled hour of the day, and their difference."""
    hours = delay_by_hour(joined, at_least)
    return hours.agg(
        F.min_by("tasa_retraso", "hora").alias("primera_ola"),
        F.max_by("tasa_retraso", "hora").alias("ultima_ola"),
    ).withColumn("diferencia", F.col("ultima_ola") - F.col("primera_ola"))


def inclusion_by_carrier(dated: DataFrame, grupo_min_obs: int = 3) -> DataFrame:
    """Share of each carrier's flights whose group reaches the support needed for a reference.

    Group sizes are counted once; carriers are sums over those sizes, no row-level join.
    """
    sizes = dated.groupBy(*SLOT_KEY).agg(F.count("*").alias("_n"))
    complete = F.lit(True)
    for k in SLOT_KEY:
        complete = complete & F.col(k).isNotNull()
    kept = F.when(complete & (F.col("_n") >= grupo_min_obs), F.col("_n")).otherwise(0)
    return (
        sizes.filter(F.col("aerolinea_dgac").isNotNull())
        .groupBy("aerolinea_dgac")
        .agg(F.sum("_n").alias("vuelos"), F.sum(kept).alias("incluidos"))
        .withColumn("pct_incluido", F.col("incluidos") / F.col("vuelos"))
    )


def concentration(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The most frequent values with their share of all rows that hold a value."""
    total = df.agg(F.count(column).alias("t")).scalar()
    return top_values(df, column, n).withColumn("participacion", F.col("n") / total)


def year_over_year(df: DataFrame, ts: str) -> DataFrame:
    """Rows per year and relative change from the year before; one row per calendar year."""
    by_year = W.orderBy("anio")
    before = F.lag("vuelos").over(by_year)
    return yearly_volume(df, ts).withColumn("variacion", (F.col("vuelos") - before) / before)


def top_per_group(df: DataFrame, group: str, order: Sequence[Column], n: int, name: str = "puesto") -> DataFrame:
    """First ``n`` rows of each group; Spark trims groups to ``n`` before the shuffle."""
    ranked = df.withColumn(name, F.row_number().over(W.partitionBy(group).orderBy(*order)))
    return ranked.filter(F.col(name) <= n)
