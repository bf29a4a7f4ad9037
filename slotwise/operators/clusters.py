"""Standardised features, k-means with a size rule for k, and the segmentations built on them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial
from typing import NamedTuple

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotwise.operators.fits import at_once, dealt
from slotwise.operators.profiles import DAY_FEATURES, flag_critical
from slotwise.operators.ranking import stored
from slotwise.operators.sizing import broadcast_if_small

AIRPORT_FEATURES = ["total_vuelos", "pct_intl", "pmd_mediana", "n_aerolineas", "cnt_ops_media"]
AIRPORT_LOGS = ["total_vuelos", "pmd_mediana", "n_aerolineas", "cnt_ops_media"]
SLOT_FEATURES = ["hora_programada", "tasa_retraso", "variabilidad_min", "pct_severo", "n_operaciones"]

#: Runs of k-means at a time: their points are few or cached once, and all they hold is centres.
STARTS_AT_ONCE = 8

# Cluster names in the order in which they are given out; the last is for the rest.
CLUSTER_NAMES = ["Hub internacional", "Pesados / carga", "Alta aviacion general", "Pequeños / regionales"]


def standardise(df: DataFrame, columns: Sequence[str], log1p: Sequence[str] = (), prefix: str = "z_") -> DataFrame:
    """Each feature minus its mean over its population deviation; a constant feature becomes 0.

    The two moments per feature are one small row, read once.
    """
    raw = {c: F.log1p(F.col(c)) if c in log1p else F.col(c).cast("double") for c in columns}
    moments = df.agg(
        *[F.avg(e).alias(f"m_{c}") for c, e in raw.items()],
        *[F.stddev_pop(e).alias(f"s_{c}") for c, e in raw.items()],
    ).first()
    scaled = {
        f"{prefix}{c}": (e - F.lit(moments[f"m_{c}"])) / F.lit(moments[f"s_{c}"] or 1.0)
        for c, e in raw.items()
    }
    return df.withColumns(scaled)


def assemble(df: DataFrame, columns: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=out).transform(df)


def fit_kmeans(points: DataFrame, k: int, seed: int = 42, starts: int = 20) -> KMeansModel:
    """The cheapest of several seeded runs."""
    return fit_all_k(points, [k], seed, starts)[k]


def fit_all_k(points: DataFrame, ks: Sequence[int], seed: int = 42, starts: int = 20) -> dict[int, KMeansModel]:
    """The cheapest of several seeded runs for every k; all runs are submitted together. Ties go to the first seed."""
    def run(k: int, i: int) -> KMeansModel:
        return KMeans(k=k, seed=seed + i, featuresCol="features", predictionCol="cluster").fit(points)

    runs = [(k, i) for k in ks for i in range(starts)]
    found = dict(zip(runs, at_once(points.sparkSession, [partial(run, *r) for r in runs], STARTS_AT_ONCE)))
    return {k: min((found[k, i] for i in range(starts)), key=lambda m: m.summary.trainingCost) for k in ks}


def project_2d(points: DataFrame) -> tuple[DataFrame, list[float]]:
    """First two principal components of standardised features, and their shares of variance."""
    model = PCA(k=2, inputCol="features", outputCol="_pc").fit(points)
    xy = vector_to_array("_pc")
    out = model.transform(points).withColumns({"pca_1": xy[0], "pca_2": xy[1]}).drop("_pc")
    return out, [float(v) for v in model.explainedVariance]


class Scan(NamedTuple):
    models: dict[int, KMeansModel]
    table: DataFrame


def scan_k(points: DataFrame, ks: Sequence[int], seed: int = 42, starts: int = 20,
           extra: Callable[[DataFrame], float] | None = None) -> Scan:
    """Cost, silhouette and smallest cluster share for every k (and one more number if given).

    Points are scanned many times, so they are kept for the length of the scan.
    """
    points = points.persist()
    total = points.count()
    even = dealt(points, total).persist()
    models = fit_all_k(even, ks, seed, starts)

    def judged(k: int) -> tuple:
        placed = models[k].transform(even)
        sizes = [n for n in models[k].summary.clusterSizes if n > 0]
        judge = ClusteringEvaluator(featuresCol="features", predictionCol="cluster")
        return (k, float(models[k].summary.trainingCost), float(judge.evaluate(placed)),
                min(sizes) / total, float(extra(placed)) if extra else None)

    rows = at_once(points.sparkSession, [partial(judged, k) for k in ks], STARTS_AT_ONCE)
    even.unpersist()
    points.unpersist()
    table = points.sparkSession.createDataFrame(
        rows, "k int, inercia double, silhouette double, cluster_mas_chico_pct double, extra double"
    )
    return Scan(models, table if extra else table.drop("extra"))


def choose_k(diagnosis: DataFrame, min_pct: float = 0.02) -> DataFrame:
    """Mark the k with the best silhouette among those whose smallest cluster is large enough.

    When no k qualifies, the best silhouette overall is taken. One row per k, so one small window.
    """
    whole = W.partitionBy()
    fit = F.col("cluster_mas_chico_pct") >= min_pct
    return (
        diagnosis.withColumn("admisible", fit)
        .withColumn("_open", F.col("admisible") | ~F.max("admisible").over(whole))
        .withColumn("_place", F.row_number().over(
            whole.orderBy(F.col("_open").desc(), F.round("silhouette", 4).desc(), "k")))
        .withColumn("elegido", F.col("_place") == 1)
        .drop("_open", "_place")
    )


def chosen_k(diagnosis: DataFrame) -> int:
    return int(diagnosis.filter("elegido").first()["k"])


def name_clusters(clustered: DataFrame, cluster: str = "cluster") -> DataFrame:
    """A name per cluster, drawn from its profile.

    Most international first; then the heaviest of the rest; then the busiest of the rest; all others
    share the last name. Ties go to the lower number. One row per cluster.
    """
    table = clustered.groupBy(cluster).agg(
        F.avg("pct_intl").alias("pct_intl"),
        F.avg("pmd_mediana").alias("pmd"),
        F.avg("total_vuelos").alias("vuelos"),
    ).withColumn("nombre", F.lit(None).cast("string"))
    for measure, name in zip(["pct_intl", "pmd", "vuelos"], CLUSTER_NAMES):
        free = F.col("nombre").isNull()
        place = F.row_number().over(W.orderBy(free.desc(), F.col(measure).desc_nulls_last(), cluster))
        table = table.withColumn("nombre", F.when(free & (place == 1), name).otherwise(F.col("nombre")))
    return table.withColumn("nombre", F.coalesce("nombre", F.lit(CLUSTER_NAMES[-1])))


class Clustered(NamedTuple):
    rows: DataFrame
    model: KMeansModel
    variance: list[float]
    diagnosis: DataFrame | None = None


def _points(df: DataFrame, columns: Sequence[str], log1p: Sequence[str]) -> DataFrame:
    """Standardised points. A profile is few rows behind a long plan: it is stored, and all that follows reads it there."""
    return assemble(standardise(stored(df), columns, log1p), [f"z_{c}" for c in columns])


def _plain(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop("features", *[f"z_{c}" for c in columns])


def cluster_airports(profile: DataFrame, k: int = 4, seed: int = 42, starts: int = 20) -> Clustered:
    """Airports in ``k`` groups by volume, share international, weight, carriers and monthly count."""
    points = _points(profile.na.drop(subset=AIRPORT_FEATURES), AIRPORT_FEATURES, AIRPORT_LOGS).persist()
    model = fit_kmeans(points, k, seed, starts)
    flat, variance = project_2d(model.transform(points))
    return Clustered(_plain(flat, AIRPORT_FEATURES), model, variance)


def scan_airports(profile: DataFrame, ks: Sequence[int] = range(2, 9), seed: int = 42, starts: int = 20) -> DataFrame:
    """Cost and silhouette of the airport clustering for every k."""
    points = _points(profile.na.drop(subset=AIRPORT_FEATURES), AIRPORT_FEATURES, AIRPORT_LOGS)
    return scan_k(points, ks, seed, starts).table.select("k", F.col("inercia").alias("inertia"), "silhouette")


def segment_flights(
    slots: DataFrame, k_min: int = 2, k_max: int = 8, min_pct: float = 0.02, seed: int = 42, starts: int = 20
) -> Clustered:
    """Flight slots grouped by behaviour; the group with the highest delay rate is the critical one."""
    points = _points(slots, SLOT_FEATURES, ["n_operaciones"])
    scan = scan_k(points, range(k_min, k_max + 1), seed, starts)
    diagnosis = choose_k(scan.table, min_pct)
    model = scan.models[chosen_k(diagnosis)]
    flat, variance = project_2d(model.transform(points))
    rows = flag_critical(_plain(flat, SLOT_FEATURES).withColumnRenamed("cluster", "segmento"))
    return Clustered(rows, model, variance, diagnosis)


def outcome_spread(placed: DataFrame, outcome: str = "tasa_retraso") -> float:
    """Points between the best and the worst cluster mean of an outcome."""
    means = placed.groupBy("cluster").agg(F.avg(outcome).alias("m"))
    return means.agg(F.max("m") - F.min("m")).first()[0] * 100


def segment_days(
    days: DataFrame, k_min: int = 2, k_max: int = 8, min_pct: float = 0.02, seed: int = 42, starts: int = 20
) -> Clustered:
    """Days grouped by load and weather only; the delay rate is looked at afterwards.

    The diagnosis also holds, for every k, how far apart the groups are in delay rate.
    """
    points = _points(days, DAY_FEATURES, ["prcp"])
    scan = scan_k(points, range(k_min, k_max + 1), seed, starts, extra=outcome_spread)
    diagnosis = choose_k(scan.table, min_pct).withColumn("brecha_puntos", F.round("extra", 2)).drop("extra")
    model = scan.models[chosen_k(diagnosis)]
    rows = _plain(model.transform(points), DAY_FEATURES).withColumnRenamed("cluster", "tipo_dia")
    return Clustered(rows, model, [], diagnosis)


def with_cluster_names(clustered: DataFrame, cluster: str = "cluster") -> DataFrame:
    names = name_clusters(clustered, cluster).select(cluster, "nombre")
    return clustered.join(broadcast_if_small(names), on=cluster)
