"""SQL for the checking engine: the mapped tables as common table expressions.

The reference time is written here over single flights with joins, apart from the library's counted
windows, so that the two are independent.
"""

FLIGHTS = """
numbered AS (
  SELECT *, ((((user_id % 3) * 477 + 476 + CASE WHEN user_id % 5 = 0 THEN 600 ELSE 0 END + (event_id * 7919) % 41 - 20
            + CASE WHEN event_id % 11 = 0 THEN 25 + event_id % 150 ELSE 0 END) % 1440) + 1440) % 1440 AS mm
  FROM events
),
flights AS (
  SELECT event_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) + to_minutes(CAST(mm AS BIGINT)) AS dt_operacion,
         'A' || (user_id % 7) AS aeropuerto_oaci, event_type AS aerolinea_dgac,
         CASE WHEN event_id % 53 = 0 THEN NULL ELSE CAST(user_id % 3 AS VARCHAR) END AS numero_vuelo,
         CASE WHEN event_id % 2 = 0 THEN 'A' ELSE 'D' END AS tipo_operacion,
         CASE WHEN event_id % 9 = 0 THEN 'N' ELSE 'U' END AS actividad_cod,
         'M' || (user_id % 23) AS modelo_avion, 'modelo ' || (user_id % 23) AS modelo_avion_desc,
         'T' || user_id AS matricula, user_id % 8 = 0 AS es_internacional,
         CASE WHEN user_id % 23 = 22 OR event_id % 37 = 0 THEN NULL
              WHEN event_id % 41 = 0 THEN 0.0 ELSE value END AS pmd
  FROM numbered
)"""

CLEAN = FLIGHTS + """,
repaired AS (SELECT * REPLACE (nullif(pmd, 0) AS pmd, coalesce(numero_vuelo, 'DESCONOCIDO') AS numero_vuelo) FROM flights),
by_model AS (SELECT modelo_avion, quantile_cont(pmd, 0.5) AS gm FROM repaired GROUP BY modelo_avion),
clean AS (
  SELECT r.* REPLACE (coalesce(r.pmd, b.gm, (SELECT quantile_cont(pmd, 0.5) FROM repaired)) AS pmd),
         CASE WHEN r.pmd IS NULL THEN 1 ELSE 0 END::BIGINT AS pmd_fue_imputado,
         (year(dt_operacion) * 100 + month(dt_operacion))::BIGINT AS mes_id,
         CASE WHEN es_internacional THEN 'I' WHEN NOT es_internacional THEN 'D' END AS internacional_domestico
  FROM repaired r LEFT JOIN by_model b USING (modelo_avion)
)"""

DATED = FLIGHTS + """,
dated AS (
  SELECT *, (hour(dt_operacion) * 60 + minute(dt_operacion))::BIGINT AS min_dia, year(dt_operacion)::BIGINT AS anio,
         month(dt_operacion)::BIGINT AS mes, (isodow(dt_operacion) - 1)::BIGINT AS dia_semana,
         strftime(dt_operacion, '%Y-%m') AS mes_ym
  FROM flights
)"""


def slots(source: str, keys: str, prefix: str, gap: int = 120, min_obs: int = 2) -> str:
    """CTEs that end in ``<prefix>_ref (event_id, center)``."""
    p, k = prefix, keys
    wrap = lambda x: f"((((({x}) + 720) % 1440) + 1440) % 1440 - 720)"
    not_null = " AND ".join(f"{c.strip()} IS NOT NULL" for c in k.split(","))
    return f"""
{p}_gap AS (
  SELECT event_id, {k}, min_dia,
         CASE WHEN coalesce(lead(min_dia) OVER (PARTITION BY {k} ORDER BY min_dia, event_id),
                            min(min_dia) OVER (PARTITION BY {k}) + 1440) - min_dia > {gap} THEN 1 ELSE 0 END AS cut
  FROM {source} WHERE {not_null}
),
{p}_cut AS (
  SELECT *, sum(cut) OVER (PARTITION BY {k}) AS cuts,
         coalesce(sum(cut) OVER (PARTITION BY {k} ORDER BY min_dia, event_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seen
  FROM {p}_gap
),
{p}_slot AS (SELECT *, CASE WHEN cuts = 0 THEN 0 ELSE seen % cuts END AS slot FROM {p}_cut),
{p}_base AS (
  SELECT {k}, slot, count(*) AS n,
         coalesce(min(min_dia) FILTER (WHERE cuts > 0 AND seen = cuts), min(min_dia)) AS base
  FROM {p}_slot GROUP BY {k}, slot
),
{p}_center AS (
  SELECT {k}, slot, any_value(n) AS n,
         (any_value(base) + median({wrap('min_dia - base')}) + 1440) % 1440 AS center
  FROM {p}_slot JOIN {p}_base USING ({k}, slot) GROUP BY {k}, slot
),
{p}_kept AS (
  SELECT * FROM {p}_center
  QUALIFY n >= {min_obs} OR (max(n) OVER (PARTITION BY {k}) < {min_obs}
          AND row_number() OVER (PARTITION BY {k} ORDER BY n DESC, slot) = 1)
),
{p}_ref AS (
  SELECT event_id, center FROM {p}_gap JOIN {p}_kept USING ({k})
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY abs({wrap('min_dia - center')}), slot) = 1
)"""


SLOT_KEY = "aerolinea_dgac, numero_vuelo, tipo_operacion, mes_ym, dia_semana"

TARGET = DATED + """,
regular AS (SELECT * FROM dated WHERE actividad_cod = 'U'),""" + slots("regular", SLOT_KEY, "t") + f""",
target AS (
  SELECT d.*, g.n_obs_grupo, r.center AS hora_referencia_min,
         ((((d.min_dia - r.center + 720) % 1440) + 1440) % 1440) - 720 AS desvio_min,
         CASE WHEN ((((d.min_dia - r.center + 720) % 1440) + 1440) % 1440) - 720 > 15 THEN 1 ELSE 0 END::BIGINT AS retraso,
         r.center / 60.0 AS hora_programada, CAST(d.dt_operacion AS DATE) AS fecha_cruce
  FROM regular d JOIN t_ref r USING (event_id)
       JOIN (SELECT {SLOT_KEY}, count(*) AS n_obs_grupo FROM regular GROUP BY ALL) g USING ({SLOT_KEY})
  WHERE g.n_obs_grupo >= 3
)"""

DAILY = """
days AS (SELECT DISTINCT CAST(ts AS DATE) AS fecha FROM events),
daily AS (
  SELECT fecha, (8 + dd % 9)::DOUBLE AS tavg, (8 + dd % 9 - 3 - dd % 4)::DOUBLE AS tmin, (8 + dd % 9 + 4 + dd % 5)::DOUBLE AS tmax,
         (CASE WHEN dd % 5 = 0 THEN NULL ELSE greatest((dd * 7) % 23 - 5, 0) END)::DOUBLE AS prcp, CAST(NULL AS DOUBLE) AS snow,
         (CASE WHEN dd % 13 = 0 THEN NULL ELSE (dd * 37) % 360 END)::DOUBLE AS wdir,
         (5 + (dd * 17) % 45)::DOUBLE AS wspd, (1005 + dd % 25)::DOUBLE AS pres
  FROM (SELECT fecha, day(fecha) AS dd FROM days)
)"""

WEATHER = DAILY + """,
weather AS (
  SELECT fecha AS fecha_cruce, tavg, tmin, tmax, tmax - tmin AS amplitud_termica, coalesce(prcp, 0.0) AS prcp,
         CASE WHEN prcp > 1.0 THEN 1 ELSE 0 END::BIGINT AS dia_lluvioso, wspd, wdir,
         coalesce(wspd * abs(sin(radians(wdir - 170))), wspd * 0.5::DOUBLE) AS viento_cruzado,
         coalesce(wspd * cos(radians(wdir - 170)), 0.0::DOUBLE) AS viento_frontal, pres
  FROM daily
)"""

JOINED = TARGET + "," + WEATHER + """,
joined AS (SELECT * FROM target LEFT JOIN weather USING (fecha_cruce))"""

SLOT_PROFILE = JOINED + """,
slot_profile AS (
  SELECT aerolinea_dgac, numero_vuelo, tipo_operacion, count(*) AS n_operaciones, avg(hora_programada) AS hora_programada,
         avg(retraso) AS tasa_retraso, median(desvio_min) AS desvio_mediano,
         quantile_cont(desvio_min, 0.75) - quantile_cont(desvio_min, 0.25) AS variabilidad_min,
         avg(CASE WHEN desvio_min > 60 THEN 1.0 ELSE 0.0 END) AS pct_severo,
         avg(CASE WHEN es_internacional THEN 1.0 ELSE 0.0 END) AS pct_internacional
  FROM joined GROUP BY ALL HAVING count(*) >= 30
)"""

DAY_PROFILE = JOINED + """,
day_profile AS (
  SELECT fecha_cruce, count(*) AS n_operaciones, count(DISTINCT aerolinea_dgac) AS n_aerolineas,
         max(prcp) AS prcp, max(viento_cruzado) AS viento_cruzado, max(wspd) AS wspd, max(tavg) AS tavg,
         max(amplitud_termica) AS amplitud_termica, max(pres) AS pres, avg(retraso) AS tasa_retraso
  FROM joined GROUP BY fecha_cruce HAVING count(*) >= 10 AND max(tavg) IS NOT NULL
)"""

# Customers and orders by nation, as the profile of an airport.
NATION_PROFILE = """
nation_log AS (
  SELECT 'N' || c_nationkey AS aeropuerto_oaci, o_orderstatus = 'F' AS es_internacional, o_totalprice AS pmd,
         c_mktsegment AS aerolinea_dgac, o_custkey AS modelo_avion, year(o_orderdate)::DOUBLE AS cnt_operaciones
  FROM orders JOIN customer ON o_custkey = c_custkey
),
profile AS (
  SELECT aeropuerto_oaci, count(*) AS total_vuelos, avg(CASE WHEN es_internacional THEN 1.0 ELSE 0.0 END) AS pct_intl,
         quantile_cont(pmd, 0.5) AS pmd_mediana, count(DISTINCT aerolinea_dgac) AS n_aerolineas,
         count(DISTINCT modelo_avion) AS n_modelos, avg(cnt_operaciones) AS cnt_ops_media
  FROM nation_log GROUP BY aeropuerto_oaci
)"""

# Line items with a label and two scores.
SCORED = """
scored AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, l_quantity / 50.0::DOUBLE AS p, l_discount * 10.0::DOUBLE AS q,
         l_shipdate
  FROM lineitem
)"""
CURVE = SCORED + """,
by_score AS (SELECT p AS umbral, sum(y) AS pos, sum(1 - y) AS neg FROM scored GROUP BY p),
points AS (
  SELECT umbral, pos, neg, sum(pos) OVER (ORDER BY umbral DESC) AS tp, sum(neg) OVER (ORDER BY umbral DESC) AS fp,
         sum(pos) OVER () AS tot_p, sum(neg) OVER () AS tot_n
  FROM by_score
)"""
