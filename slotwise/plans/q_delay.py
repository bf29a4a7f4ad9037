"""Timetable reconstruction, the delay label, and the delay tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from slotwise.operators import profiles as Pr
from slotwise.operators import timetable as TT
from slotwise.operators import weather as We
from slotwise.operators.prepare import with_calendar
from slotwise.plans import tables
from slotwise.plans.registry import query, tidy
from slotwise.plans.sql import DATED, DAY_PROFILE, JOINED, SLOT_PROFILE, TARGET, WEATHER, slots
from slotwise.session import scratch_path

_BANDS = f"""WITH {JOINED},
known AS (SELECT * FROM joined WHERE tavg IS NOT NULL),
base AS (SELECT avg(retraso) AS b FROM known),
banded AS (
  SELECT 'lluvia_mm' AS variable, CASE WHEN prcp <= -0.1 THEN NULL WHEN prcp <= 0 THEN 'Sin lluvia' WHEN prcp <= 1 THEN '0-1 mm'
         WHEN prcp <= 5 THEN '1-5 mm' WHEN prcp <= 15 THEN '5-15 mm' WHEN prcp <= 1000 THEN '> 15 mm' END AS rango, retraso FROM known
  UNION ALL
  SELECT 'viento_cruzado_kmh', CASE WHEN viento_cruzado <= -0.1 THEN NULL WHEN viento_cruzado <= 5 THEN '< 5' WHEN viento_cruzado <= 10 THEN '5-10'
         WHEN viento_cruzado <= 20 THEN '10-20' WHEN viento_cruzado <= 30 THEN '20-30' WHEN viento_cruzado <= 100 THEN '> 30' END, retraso FROM known
)
SELECT variable, rango, count(*) AS n_vuelos, round(avg(retraso), 4) AS tasa_retraso,
       round((avg(retraso) - (SELECT b FROM base)) * 100, 2) AS puntos_vs_base
FROM banded WHERE rango IS NOT NULL GROUP BY variable, rango"""


@query("A10_weather_effect", _BANDS)
def weather_effect(spark, d):
    return We.weather_effect(tables.joined(spark, d))


_SLOT_REFERENCE = f"""WITH {DATED},
regular AS (SELECT * FROM dated WHERE actividad_cod = 'U'),""" + slots(
    "regular", "aerolinea_dgac, numero_vuelo, tipo_operacion, mes_ym, dia_semana", "t") + """
SELECT aerolinea_dgac, numero_vuelo, tipo_operacion, mes_ym, dia_semana, min_dia,
       any_value(center)::DOUBLE AS hora_referencia_min FROM t_gap JOIN t_ref USING (event_id) GROUP BY ALL"""


@query("W2_slot_reference", _SLOT_REFERENCE)
def slot_reference(spark, d):
    dated = with_calendar(tables.flights(spark, d).filter(F.col("actividad_cod") == "U"))
    return tidy(TT.slot_reference(dated).drop("n_obs_grupo"))


def minute_counts(spark, d):
    """Counts of all regular flights, stored under a name and path of their own."""
    dated = with_calendar(tables.flights(spark, d).filter(F.col("actividad_cod") == "U"))
    path = scratch_path(spark, "minute_counts")
    return TT.store_minute_counts(dated, f"minute_counts_{path.rsplit('-', 1)[-1]}", path)


@query("W2_stored_counts", _SLOT_REFERENCE)
def stored_counts(spark, d):
    return tidy(TT.stored_slot_reference(minute_counts(spark, d)).drop("n_obs_grupo"))


_DELAY_TARGET = f"""WITH {TARGET}
SELECT event_id, min_dia, n_obs_grupo, hora_referencia_min::DOUBLE AS hora_referencia_min, desvio_min::DOUBLE AS desvio_min, retraso,
       round(hora_programada, 6) AS hora_programada, fecha_cruce FROM target"""
_TARGET_COLUMNS = (
    "event_id", "min_dia", "n_obs_grupo", "hora_referencia_min", "desvio_min", "retraso", "hora_programada", "fecha_cruce")


@query("W3_delay_target", _DELAY_TARGET)
def delay_target(spark, d):
    return tidy(tables.target(spark, d).select(*_TARGET_COLUMNS))


@query("W3_target_from_stored_counts", _DELAY_TARGET)
def target_from_stored_counts(spark, d):
    regular = tables.flights(spark, d).filter(F.col("actividad_cod") == "U")
    return tidy(TT.delay_target(regular, counts=minute_counts(spark, d)).select(*_TARGET_COLUMNS))


@query("W6_plain_median_hour", f"""WITH {DATED}
SELECT aerolinea_dgac, numero_vuelo, tipo_operacion, mes_ym, median(min_dia)::DOUBLE AS mediana_min, count(*) AS n_vuelos
FROM dated WHERE numero_vuelo IS NOT NULL GROUP BY ALL""")
def plain_median(spark, d):
    return TT.plain_median(with_calendar(tables.flights(spark, d)), [*TT.FLIGHT, "mes_ym"])


_MONTHLY_KEY = "aerolinea_dgac, numero_vuelo, tipo_operacion, mes_ym"


@query("A35_target_ablation", f"""WITH {DATED},
keyed AS (SELECT * FROM dated WHERE numero_vuelo IS NOT NULL),
plain AS (SELECT {_MONTHLY_KEY}, median(min_dia) AS ref FROM keyed GROUP BY ALL),
{slots("keyed", _MONTHLY_KEY, "c", gap=1440)},
{slots("keyed", _MONTHLY_KEY, "s")},
{slots("keyed", _MONTHLY_KEY + ", dia_semana", "w")},
dev AS (
  SELECT '1_mediana_simple' AS version, min_dia - ref AS d FROM keyed JOIN plain USING ({_MONTHLY_KEY})
  UNION ALL SELECT '2_reloj_circular', ((((min_dia - center + 720) % 1440) + 1440) % 1440) - 720 FROM keyed JOIN c_ref USING (event_id)
  UNION ALL SELECT '3_slots', ((((min_dia - center + 720) % 1440) + 1440) % 1440) - 720 FROM keyed JOIN s_ref USING (event_id)
  UNION ALL SELECT '4_dia_semana', ((((min_dia - center + 720) % 1440) + 1440) % 1440) - 720 FROM keyed JOIN w_ref USING (event_id)
)
SELECT version, count(*) AS vuelos, round(stddev_samp(d), 4) AS desv_estandar, round(quantile_cont(d::DOUBLE, 0.05), 4) AS p05,
       round(quantile_cont(d::DOUBLE, 0.95), 4) AS p95, round(avg(CASE WHEN d > 15 THEN 1.0 ELSE 0.0 END), 4) AS tasa_retraso
FROM dev GROUP BY version""")
def target_ablation(spark, d):
    return tidy(TT.target_ablation(tables.flights(spark, d)), 4)


@query("A34_inclusion_by_carrier", f"""WITH {DATED},
sized AS (SELECT *, CASE WHEN numero_vuelo IS NULL THEN 0
  ELSE count(*) OVER (PARTITION BY aerolinea_dgac, numero_vuelo, tipo_operacion, mes_ym, dia_semana) END AS n FROM dated)
SELECT aerolinea_dgac, count(*) AS vuelos, count(*) FILTER (WHERE n >= 3) AS incluidos,
       round(count(*) FILTER (WHERE n >= 3) / count(*), 6) AS pct_incluido FROM sized GROUP BY aerolinea_dgac""")
def inclusion(spark, d):
    return tidy(Pr.inclusion_by_carrier(with_calendar(tables.flights(spark, d))))


@query("A2_slot_profile", f"""WITH {SLOT_PROFILE}
SELECT aerolinea_dgac, numero_vuelo, tipo_operacion, n_operaciones, round(hora_programada, 6) AS hora_programada,
       round(tasa_retraso, 6) AS tasa_retraso, round(desvio_mediano::DOUBLE, 6) AS desvio_mediano,
       round(variabilidad_min::DOUBLE, 6) AS variabilidad_min, round(pct_severo, 6) AS pct_severo,
       round(pct_internacional, 6) AS pct_internacional FROM slot_profile""")
def slot_profile(spark, d):
    return tidy(Pr.slot_profile(tables.joined(spark, d)))


@query("A3_day_profile", f"""WITH {DAY_PROFILE}
SELECT fecha_cruce, n_operaciones, n_aerolineas, prcp, round(viento_cruzado, 6) AS viento_cruzado, wspd, tavg, amplitud_termica, pres,
       round(tasa_retraso, 6) AS tasa_retraso FROM day_profile""")
def day_profile(spark, d):
    return tidy(Pr.day_profile(tables.joined(spark, d)))


@query("A11_delay_by_hour", f"""WITH {JOINED}
SELECT floor(hora_programada)::BIGINT AS hora, count(*) AS n_vuelos, round(avg(retraso), 6) AS tasa_retraso
FROM joined GROUP BY 1 HAVING count(*) >= 100""")
def delay_by_hour(spark, d):
    return tidy(Pr.delay_by_hour(tables.joined(spark, d)))


@query("A12_coverage_by_year", f"""WITH {JOINED}
SELECT anio, count(*) AS vuelos, round(avg(retraso), 3) AS tasa_retraso, round(median(desvio_min)::DOUBLE, 3) AS desvio_mediano
FROM joined GROUP BY anio""")
def coverage_by_year(spark, d):
    return tidy(Pr.delay_by_year(tables.joined(spark, d)))


@query("A13_main_carriers", f"""WITH {JOINED}
SELECT aerolinea_dgac, count(*) AS vuelos, round(avg(retraso), 3) AS tasa_retraso,
       round(quantile_cont(desvio_min::DOUBLE, 0.75), 3) AS desvio_p75
FROM joined GROUP BY aerolinea_dgac ORDER BY vuelos DESC, aerolinea_dgac LIMIT 8""")
def main_carriers(spark, d):
    return Pr.main_carriers(tables.joined(spark, d))


@query("A14_target_summary", f"""WITH {JOINED}
SELECT count(*) AS vuelos, round(avg(retraso), 6) AS tasa_retraso, round(avg(CASE WHEN desvio_min > 60 THEN 1.0 ELSE 0.0 END), 6) AS tasa_severo,
       round(quantile_cont(desvio_min::DOUBLE, 0.05), 6) AS desvio_p05, round(median(desvio_min::DOUBLE), 6) AS desvio_mediano,
       round(quantile_cont(desvio_min::DOUBLE, 0.95), 6) AS desvio_p95, round(stddev_samp(desvio_min), 6) AS desv_estandar FROM joined""")
def target_summary(spark, d):
    return tidy(Pr.target_summary(tables.joined(spark, d)))


@query("A25_rainy_share", f"""WITH {WEATHER}
SELECT count(*) AS dias, round(avg(CASE WHEN prcp > 0 THEN 1.0 ELSE 0.0 END), 6) AS pct_con_lluvia,
       round(avg(dia_lluvioso), 6) AS pct_dia_lluvioso FROM weather""")
def rainy_share(spark, d):
    return tidy(We.rainy_share(tables.weather(spark, d)))


@query("A33_punctuality_by_month", f"""WITH {JOINED}
SELECT mes_ym, count(*) AS vuelos, round(avg(CASE WHEN desvio_min <= 15 THEN 1.0 ELSE 0.0 END), 6) AS pct_puntual,
       round(avg(CASE WHEN desvio_min > 60 THEN 1.0 ELSE 0.0 END), 6) AS pct_severo,
       round(sum(CASE WHEN desvio_min > 15 THEN desvio_min ELSE 0 END)::DOUBLE, 6) AS minutos_atraso FROM joined GROUP BY mes_ym""")
def punctuality(spark, d):
    return tidy(Pr.punctuality_by_month(tables.joined(spark, d)))


@query("A33_wave_spread", f"""WITH {JOINED},
hours AS (SELECT floor(hora_programada) AS hora, avg(retraso) AS r FROM joined GROUP BY 1 HAVING count(*) >= 100)
SELECT round(arg_min(r, hora), 6) AS primera_ola, round(arg_max(r, hora), 6) AS ultima_ola,
       round(arg_max(r, hora) - arg_min(r, hora), 6) AS diferencia FROM hours""")
def wave_spread(spark, d):
    return tidy(Pr.wave_spread(tables.joined(spark, d)))
