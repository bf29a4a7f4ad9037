"""The two analysis chains and the exploratory report, as functions from tables to tables.

Every step is an operator; a chain only fixes their order and writes the tables that later steps or
readers share. The primary tables are written once and read back, so what follows starts from stored
data and not from the whole history.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.functions import cleaning as C
from slotwise.operators import clusters as K
from slotwise.operators import enrich, filters, fitted, prepare, quality, timetable, weather
from slotwise.operators import models as M
from slotwise.operators import profiles as Pr
from slotwise.operators import search as S
from slotwise.sources import files, sinks


@dataclass(frozen=True)
class Settings:
    """Parameters with their published defaults."""

    aeropuerto_oaci: str = "SCTE"
    fecha_desde: str = "2020-01-01"
    fecha_hasta: str = "2026-01-01"
    zona: str = "America/Santiago"
    actividades: Sequence[str] = ("U",)
    slot_gap_min: int = 120
    slot_min_obs: int = 2
    grupo_min_obs: int = 3
    umbral_retraso_min: float = 15
    rumbo_pista: float = 170
    anio_validacion: int = 2024
    anio_corte_test: int = 2025
    random_state: int = 42
    min_ops_slot: int = 30
    min_ops_dia: int = 10
    k_min: int = 2
    k_max: int = 8
    min_pct_cluster: float = 0.02
    starts: int = 20
    trees: int = 200
    cv_trees: int = 150
    depth: int = 12
    sample: int = 500_000
    cv_sample: int = 200_000
    repeats: int = 5
    grid: Mapping[str, Sequence[Mapping[str, Any]]] = field(default_factory=lambda: M.GRID)


class Store:
    """Tables and models under one folder, by name."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def table(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        return sinks.save_table(df, f"{self.root}/{name}", partition_by)

    def model(self, name: str, model: Any) -> None:
        sinks.save_model(model, f"{self.root}/{name}")


def inventory(spark, folder: str, store: Store, max_files: int = 2, max_rows: int = 20) -> DataFrame:
    """Index of the raw files, facts on a sample, and both in one summary."""
    index = store.table("data_inventory_raw_files_index", files.file_index(spark, folder))
    profile = store.table(
        "data_inventory_raw_sample_profile", files.profile_csv_sample(spark, folder, max_files, max_rows))
    return store.table("data_inventory_summary", quality.inventory_summary(index, profile))


def integrate(log: DataFrame, monthly: DataFrame, store: Store, s: Settings = Settings()) -> DataFrame:
    """Cleaned log in local time with the monthly operation count, stored by year: ``scope_cut`` reads the years it needs."""
    cleaned = prepare.preprocess_log(prepare.localise(log, s.zona))
    joined = enrich.join_monthly_operations(cleaned, monthly)
    by_year = joined.withColumn("anio_operacion", F.year("dt_operacion"))
    return store.table("vuelos_con_operaciones", by_year, ["anio_operacion"])


def volume_tables(log: DataFrame, years: Sequence[int]) -> dict[str, DataFrame]:
    """The tables behind the volume charts."""
    year = F.year("dt_operacion")
    return {
        "top_aeropuertos": filters.top_values(log, "aeropuerto_oaci", 15),
        "anio_por_tipo": Pr.count_pivot(log, year.alias("anio"), "internacional_domestico"),
        "histograma_pmd": quality.histogram(log, C.clip("pmd", high=500.0), 80, by="pmd_fue_imputado"),
        "vuelos_por_anio": Pr.yearly_volume(log),
        "top12_por_anio": Pr.top_by_year(log, "aeropuerto_oaci", "dt_operacion", years, 12),
        "correlaciones": Pr.correlations(
            log.withColumn("es_intl", F.col("es_internacional").cast("int")),
            ["pmd", "mes_id", "cnt_operaciones", "pmd_fue_imputado", "es_intl"]),
    }


def baseline(log: DataFrame, key: str, store: Store, s: Settings = Settings()) -> dict[str, DataFrame]:
    """Airport profiles, their clusters, and the classifier of international flights.

    ``log`` is the integrated log; ``key`` a column that identifies its rows.
    """
    profile = store.table("aeropuertos_perfil", Pr.airport_profile(log))
    found = K.cluster_airports(profile, 4, s.random_state, s.starts)
    labels = store.table("cluster_labels", K.with_cluster_names(found.rows))
    store.model("modelo_kmeans", found.model)
    scan = store.table("cluster_metricas", K.scan_airports(profile, range(2, 9), s.random_state, s.starts))
    coded, features = M.border_features(log, key)
    coded = store.table("clasificador_features", coded)
    forest = M.train_forest(
        coded, features, "y", key, s.sample, s.trees, s.depth, s.random_state, target="es_internacional")
    store.model("modelo_rf", fitted.with_model(fitted.learnt_border(log), features, forest.model))
    cv = M.cross_validate_forest(
        coded, features, "y", key, 5, s.cv_sample, s.cv_trees, s.depth, s.random_state)
    return {
        "aeropuertos_perfil": profile,
        "cluster_labels": labels,
        "cluster_resumen": Pr.cluster_summary(labels),
        "cluster_metricas": scan,
        "metricas_supervisado": store.table("metricas_supervisado", forest.report),
        "importancia_gini": store.table("importancia_gini", forest.importance),
        "matriz_confusion": store.table("matriz_confusion", forest.confusion),
        "metricas_cv_supervisado": store.table("metricas_cv_supervisado", cv),
    }


def flights_with_weather(
    log: DataFrame, daily: DataFrame, store: Store, s: Settings = Settings()
) -> tuple[DataFrame, DataFrame]:
    """Delay label and daily weather for the flights in scope, and the prepared weather."""
    scope = filters.scope_cut(
        log, s.aeropuerto_oaci, s.fecha_desde, s.fecha_hasta, s.actividades, s.zona)
    scope = store.table("vuelos_scte", prepare.localise(scope, s.zona))
    target = timetable.delay_target(
        scope, s.slot_gap_min, s.slot_min_obs, s.grupo_min_obs, s.umbral_retraso_min)
    features = store.table("clima_scte_features", weather.prepare_weather(daily, s.rumbo_pista))
    return store.table("vuelos_clima", weather.join_weather(target, features)), features


def delay_risk(
    log: DataFrame, daily: DataFrame, key: str, store: Store, s: Settings = Settings()
) -> dict[str, DataFrame]:
    """From the raw log and daily weather to the weather effect, segments, and the chosen risk model."""
    joined, features = flights_with_weather(log, daily, store, s)
    matrix = store.table("matriz_features", M.feature_matrix(joined, key))
    tagged = M.temporal_split(matrix, "_year", s.anio_validacion, s.anio_corte_test)
    found = S.search_models(
        tagged, "retraso", "tramo", key, M.FEATURE_SETS, s.grid, repeats=s.repeats, seed=s.random_state)
    known = joined.filter(F.col("tavg").isNotNull())
    learnt = fitted.learnt_risk(known, F.col("anio") < s.anio_validacion)
    prepared = PipelineModel(stages=[*learnt.stages, found.bins])
    store.model("modelo_retrasos", fitted.with_model(prepared, found.features, found.model))
    scored = store.table("proba_test", found.scored)
    slots = store.table("perfil_vuelos", Pr.slot_profile(joined, s.min_ops_slot))
    out = {
        "vuelos_clima": joined,
        "clima_scte_features": features,
        "metricas_retrasos": store.table("metricas_retrasos", found.metrics),
        "busqueda_hiperparametros": store.table("busqueda_hiperparametros", found.search),
        "efecto_clima_retraso": store.table("efecto_clima_retraso", weather.weather_effect(joined)),
        "retraso_por_hora": Pr.delay_by_hour(joined),
        "proba_test": scored,
        "perfil_vuelos": slots,
    }
    if found.importance is not None:
        out["importancia"] = store.table("importancia", found.importance)
    limits = (s.k_min, s.k_max, s.min_pct_cluster, s.random_state, s.starts)
    flights = K.segment_flights(slots, *limits)
    store.model("modelo_segmentacion", flights.model)
    out["segmentos_vuelos"] = store.table("segmentos_vuelos", flights.rows)
    out["segmentos_resumen"] = Pr.segment_summary(out["segmentos_vuelos"])
    out["segmentos_diagnostico"] = store.table("segmentos_diagnostico", flights.diagnosis)
    days = K.segment_days(Pr.day_profile(joined, s.min_ops_dia), *limits)
    out["segmentos_dias"] = store.table("segmentos_dias", days.rows)
    out["tipos_dia_resumen"] = Pr.day_type_summary(out["segmentos_dias"])
    out["dias_diagnostico"] = store.table("dias_diagnostico", days.diagnosis)
    return out


def exploration(
    raw: DataFrame, log: DataFrame, features: DataFrame, joined: DataFrame, airport: str = "SCTE"
) -> dict[str, DataFrame]:
    """The tables of the exploratory report: the whole log, the weather, and the labelled flights."""
    weather_numbers = ["tavg", "tmin", "tmax", "amplitud_termica", "prcp", "wspd", "viento_cruzado", "pres"]
    return {
        "columnas_log": quality.column_profile(log),
        "describe_log": quality.describe(log, ["pmd", "mes_id", "cnt_operaciones"]),
        "duplicados": quality.duplicate_summary(
            log, ["dt_operacion", "aeropuerto_oaci", "matricula", "tipo_operacion"]),
        "outliers_pmd": quality.outlier_summary(log, "pmd"),
        "extremos_pmd": quality.extreme_values(log, "pmd", 8),
        "fuselaje_ancho": quality.heavy_models(log, 300.0, 650.0, ["modelo_avion"], 5, "pmd_max"),
        "unidad_imposible": quality.heavy_models(
            log, 650.0, None, ["modelo_avion", "modelo_avion_desc"], 6, "pmd_registrado"),
        "unidad_imposible_total": log.agg(
            F.count_if(F.col("pmd") > 650).alias("total"),
            F.count_if((F.col("pmd") > 650) & (F.col("aeropuerto_oaci") == airport)).alias("en_aeropuerto")),
        "ceros": quality.disguised_zeros(raw, "pmd"),
        "imputados": quality.imputed_share(log, "pmd_fue_imputado"),
        "columnas_clima": quality.column_profile(features),
        "describe_clima": quality.describe(features, weather_numbers),
        "dias_con_lluvia": weather.rainy_share(features),
        "cobertura_anio": Pr.delay_by_year(joined),
        "operadores": Pr.main_carriers(joined, 8),
        "objetivo": Pr.target_summary(joined),
        "histograma_log_pmd": quality.histogram(log.filter(F.col("pmd") > 0), F.log10("pmd"), 100),
        "caja_pmd": quality.box_statistics(log, "pmd"),
        "histograma_desvio": quality.histogram(joined, C.clip("desvio_min", -90.0, 180.0), 100),
        "operadores_principales": Pr.main_carriers(filters.among_top(joined, "aerolinea_dgac", 6), 6),
        "puntualidad_mensual": Pr.punctuality_by_month(joined),
        "olas": Pr.wave_spread(joined),
    }
