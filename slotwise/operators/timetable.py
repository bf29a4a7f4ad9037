"""The habitual timetable, rebuilt from actual times, and the delay label derived from it.

Grouping key: carrier, flight number, operation type, month and weekday. Times are whole minutes, so
a group holds at most 1440 distinct ones; the log is counted per key and minute before anything is
gathered by key, and every window below runs on those counts. A key that holds a third of the log is
as cheap as any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotwise.functions import cleaning as C
from slotwise.functions import clock
from slotwise.operators.enrich import stack_tagged
from slotwise.operators.prepare import with_calendar
from slotwise.operators.sizing import broadcast_if_small, drop_null_keys, require_columns
from slotwise.sources.sinks import save_bucketed

FLIGHT = ("aerolinea_dgac", "numero_vuelo", "tipo_operacion")
SLOT_KEY = (*FLIGHT, "mes_ym", "dia_semana")

# One query block over the counts (n flights at minute m per key): every window is on the key, or on
# the key and slot, so one shuffle by key serves them all. At most 1440 / gap slots fit on the circle.
_SLOTS = """
WITH gaps AS (
  SELECT *, coalesce(lead(m) OVER (PARTITION BY <keys> ORDER BY m),
                     min(m) OVER (PARTITION BY <keys>) + 1440) - m > :gap AS cut_after
  FROM {counts}
), cuts AS (
  SELECT *, count_if(cut_after) OVER (PARTITION BY <keys>) AS cuts,
         count_if(cut_after) OVER (PARTITION BY <keys> ORDER BY m
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS cuts_before
  FROM gaps
), slotted AS (  -- times after the last cut continue, over midnight, into slot 0
  SELECT *, if(cuts = 0, 0, cuts_before % cuts) AS slot FROM cuts
), based AS (    -- a slot starts at its first time after the cut
  SELECT *, coalesce(min(if(cuts_before = cuts, m, NULL)) OVER (PARTITION BY <keys>, slot),
                     min(m) OVER (PARTITION BY <keys>, slot)) AS base
  FROM slotted
), centred AS (
  SELECT *, pmod(base + percentile(pmod(m - base + 720, 1440) - 720, 0.5, n)
                          OVER (PARTITION BY <keys>, slot), 1440.0D) AS center,
         sum(n) OVER (PARTITION BY <keys>, slot) AS slot_n
  FROM based
), listed AS (
  SELECT <keys>, m, n, sum(n) OVER (PARTITION BY <keys>) AS n_obs_grupo,
         collect_set(struct(slot, center, slot_n)) OVER (PARTITION BY <keys>) AS slots
  FROM centred
)
SELECT <keys>, m, n, n_obs_grupo,
       coalesce(
         array_min(transform(filter(slots, s -> s.slot_n >= :min_obs),
           s -> struct(abs(pmod(m - s.center + 720, 1440.0D) - 720) AS far, s.slot, s.center))).center,
         array_max(transform(slots, s -> struct(s.slot_n, -s.slot AS first, s.center))).center
       ) AS hora_referencia_min
FROM listed
"""


def slot_reference(
    df: DataFrame,
    keys: Sequence[str] = SLOT_KEY,
    minute: str = "min_dia",
    gap: int = 120,
    min_obs: int = 2,
) -> DataFrame:
    """Reference time per key and minute: ``hora_referencia_min``, with the group size ``n_obs_grupo``.

    The 24-hour circle of a key is cut wherever two neighbouring times lie more than ``gap`` minutes
    apart. Each slot between cuts has a circular median; slots with fewer than ``min_obs`` flights do
    not count as habitual unless there is no other, and then the largest one does. Every time refers
    to the nearest habitual slot (the first of two at the same distance).
    """
    counts = minute_counts(df, keys, minute)
    return _references(counts, keys, gap, min_obs).drop("n").withColumnRenamed("m", minute)


def minute_counts(df: DataFrame, keys: Sequence[str], minute: str = "min_dia") -> DataFrame:
    """Flights ``n`` per key and minute ``m``; rows with a missing key belong to no group."""
    known = drop_null_keys(df, [*keys, minute])
    return known.groupBy(*keys, F.col(minute).alias("m")).agg(F.count("*").alias("n"))


def store_minute_counts(
    df: DataFrame, name: str, path: str, keys: Sequence[str] = SLOT_KEY, minute: str = "min_dia",
    buckets: int | None = None, append: bool = False,
) -> DataFrame:
    """The counts as a table in buckets of the key: the log is shuffled once, the timetables drawn from it never again.

    A new month is appended without counting the old ones again. Buckets default to the session's shuffle
    partitions; appended rows need the number that the table was made with.
    """
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return save_bucketed(minute_counts(df, keys, minute), name, path, keys, n, ["m"], append)


def stored_slot_reference(
    stored: DataFrame, keys: Sequence[str] = SLOT_KEY, minute: str = "min_dia", gap: int = 120, min_obs: int = 2,
) -> DataFrame:
    """``slot_reference`` from a table of ``store_minute_counts``: no shuffle between the scan and the result.

    A key and minute that several appended parts hold are added up first, inside their bucket.
    """
    counts = stored.groupBy(*keys, "m").agg(F.sum("n").alias("n"))
    return _references(counts, keys, gap, min_obs).drop("n").withColumnRenamed("m", minute)


def _references(counts: DataFrame, keys: Sequence[str], gap: int, min_obs: int) -> DataFrame:
    text = _SLOTS.replace("<keys>", ", ".join(f"`{k}`" for k in keys))
    return counts.sparkSession.sql(text, {"gap": gap, "min_obs": min_obs}, counts=counts)


def delay_target(
    flights: DataFrame,
    slot_gap_min: int = 120,
    slot_min_obs: int = 2,
    grupo_min_obs: int = 3,
    umbral_retraso_min: float = 15,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Flights with a trustworthy reference, their deviation from it and the delay label.

    ``counts``, a table of ``store_minute_counts`` over these flights or a longer log, spares counting them again;
    flights at a key and minute that it does not hold have no reference.
    """
    require_columns(flights, ["dt_operacion", *FLIGHT])
    dated = with_calendar(flights)
    times = {"gap": slot_gap_min, "min_obs": slot_min_obs}
    known = slot_reference(dated, **times) if counts is None else stored_slot_reference(counts, **times)
    reference = known.filter(F.col("n_obs_grupo") >= grupo_min_obs)
    on = [*SLOT_KEY, "min_dia"]
    return (
        dated.join(broadcast_if_small(reference), on=on)
        .withColumn("desvio_min", clock.wrap_minutes(F.col("min_dia") - F.col("hora_referencia_min")))
        .withColumns({
            "retraso": C.exceeds("desvio_min", umbral_retraso_min),
            "hora_programada": clock.fractional_hour("hora_referencia_min"),
            "fecha_cruce": clock.local_date("dt_operacion"),
        })
        .select(
            *dated.columns,
            "n_obs_grupo", "hora_referencia_min", "desvio_min", "retraso", "hora_programada", "fecha_cruce",
        )
    )


def plain_median(df: DataFrame, keys: Sequence[str], minute: str = "min_dia") -> DataFrame:
    """Median minute per key on a straight axis: the naive reference that ignores midnight."""
    # At most 1440 distinct minutes per key.
    return minute_counts(df, keys, minute).groupBy(*keys).agg(
        F.percentile(F.col("m").cast("double"), F.lit(0.5), F.col("n")).alias("mediana_min"),
        F.sum("n").alias("n_vuelos"),
    )


def target_ablation(flights: DataFrame, late_after: float = 15) -> DataFrame:
    """Spread of the deviation and share late under four definitions of the reference time.

    Plain median per flight and month; the same on the circle; with slots; with slots and weekday. All
    four are computed from one table of counts per key and minute, without going back to the flights.
    """
    monthly = [*FLIGHT, "mes_ym"]
    fine = minute_counts(with_calendar(flights), SLOT_KEY).persist()
    counts = fine.groupBy(*monthly, "m").agg(F.sum("n").alias("n"))
    middle = F.percentile(F.col("m").cast("double"), F.lit(0.5), F.col("n")).over(W.partitionBy(*monthly))
    wrapped = clock.wrap_minutes(F.col("m") - F.col("hora_referencia_min"))
    versions = {
        "1_mediana_simple": counts.select((F.col("m") - middle).alias("d"), "n"),
        # No gap is longer than a day, so that setting keeps each circle in one slot.
        "2_reloj_circular": _references(counts, monthly, clock.DAY_MIN, 2).select(wrapped.alias("d"), "n"),
        "3_slots": _references(counts, monthly, 120, 2).select(wrapped.alias("d"), "n"),
        "4_dia_semana": _references(fine, SLOT_KEY, 120, 2).select(wrapped.alias("d"), "n"),
    }
    # Deviations are half-minute steps within a day: a bounded number of values per version.
    merged = stack_tagged(versions, "version").groupBy("version", "d").agg(F.sum("n").alias("n"))
    n, s, q = F.sum("n"), F.sum(F.col("n") * F.col("d")), F.sum(F.col("n") * F.col("d") * F.col("d"))
    quantiles = F.percentile("d", F.array(F.lit(0.05), F.lit(0.95)), F.col("n"))
    return merged.groupBy("version").agg(
        n.alias("vuelos"),
        F.sqrt((q - s * s / n) / (n - 1)).alias("desv_estandar"),
        quantiles[0].alias("p05"),
        quantiles[1].alias("p95"),
        (F.sum(F.when(F.col("d") > late_after, F.col("n")).otherwise(0)) / n).alias("tasa_retraso"),
    )
