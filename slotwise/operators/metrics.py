"""Exact evaluation of a score column against a 0/1 label.

Rows without a score (null or NaN) or without a label count in no metric. Measures that need a class
which is not there are null. Rows are merged to counts per distinct score first. Curves need running counts over the scores from
high to low; those come from ``running_totals``, which orders scores cell by cell when there are many.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotwise.functions import binning as B
from slotwise.operators.ranking import exact_quantiles, running_totals, stored
from slotwise.operators.sizing import broadcast_if_small


def scored_rows(df: DataFrame, label: str, score: str) -> DataFrame:
    """Rows that have a label and a score."""
    return df.filter(F.col(label).isNotNull() & F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))


def score_counts(
    df: DataFrame, label: str, score: str, keys: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """Positives and negatives per distinct score (of each key); ``weight`` says how many rows a row stands for."""
    y, n = F.col(label).cast("long"), F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    return (
        scored_rows(df, label, score)
        .select(*keys, F.col(score).cast("double").alias("umbral"), y.alias("_y"), n.alias("_n"))
        .groupBy(*keys, "umbral")
        .agg(F.sum(F.col("_y") * F.col("_n")).alias("_pos"), F.sum((1 - F.col("_y")) * F.col("_n")).alias("_neg"))
    )


def curve_points(
    df: DataFrame, label: str, score: str, rows_per_cell: int | None = None, keys: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """Per distinct score, as a threshold: true and false positives, and the totals.

    With ``keys``, the curves of all of them at once: as many scored models as one pass should compare.
    """
    counts = stored(score_counts(df, label, score, keys, weight))
    running = running_totals(
        counts, "umbral", {"tp": F.col("_pos"), "fp": F.col("_neg")}, keys, descending=True,
        rows_per_cell=rows_per_cell, is_stored=True,
    )
    if keys:
        whole = counts.groupBy(*keys).agg(F.sum("_pos").alias("positivos"), F.sum("_neg").alias("negativos"))
        return running.join(broadcast_if_small(whole), on=list(keys))
    totals = counts.agg(F.sum("_pos").alias("tp"), F.sum("_neg").alias("fp")).first()
    return running.withColumns({
        "positivos": F.lit(totals["tp"] or 0).cast("long"), "negativos": F.lit(totals["fp"] or 0).cast("long"),
    })


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    return curve_points(df, label, score).select(
        "umbral", F.try_divide("fp", "negativos").alias("fpr"), F.try_divide("tp", "positivos").alias("tpr")
    )


def precision_recall_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    return curve_points(df, label, score).select(
        "umbral",
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.try_divide("tp", "positivos").alias("recall"),
    )


def _area(points: DataFrame) -> Column:
    """Area under the ROC curve from its steps: a tie between classes counts one half."""
    p, n = F.col("positivos").cast("double"), F.col("negativos").cast("double")
    return F.sum(F.try_divide(F.col("_neg") * (F.col("tp") - F.col("_pos") / 2.0), p * n))


def _average_precision() -> Column:
    """Step sum of recall gains times precision."""
    gain = F.try_divide("_pos", "positivos")
    return F.sum(gain * F.col("tp") / (F.col("tp") + F.col("fp")))


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    points = curve_points(df, label, score)
    return points.agg(_area(points).alias("roc_auc"))


def auc_value(df: DataFrame, label: str, score: str) -> float:
    """The area as a number, for choosing among models."""
    found = roc_auc(df, label, score).first()["roc_auc"]
    if found is None:
        raise ValueError("an area needs scores of both classes")
    return float(found)


def areas(df: DataFrame, label: str, score: str, keys: Sequence[str], weight: str | None = None) -> DataFrame:
    """The area of every key, all from one pass; null where a class is missing."""
    points = curve_points(df, label, score, keys=keys, weight=weight)
    return points.groupBy(*keys).agg(_area(points).alias("roc_auc"))


def average_precision(df: DataFrame, label: str, score: str) -> DataFrame:
    return curve_points(df, label, score).agg(_average_precision().alias("average_precision"))


def lift(df: DataFrame, label: str, score: str) -> DataFrame:
    """Average precision over the base rate."""
    rate = F.try_divide(F.max("positivos"), F.max("positivos") + F.max("negativos"))
    return curve_points(df, label, score).agg(
        rate.alias("tasa_base"), F.try_divide(_average_precision(), rate).alias("lift_vs_azar")
    )


def brier(df: DataFrame, label: str, score: str) -> DataFrame:
    return scored_rows(df, label, score).agg(F.avg(F.pow(F.col(score) - F.col(label), F.lit(2))).alias("brier"))


def threshold_metrics(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """Accuracy, precision, recall and F1 at a threshold; a division by zero gives 0."""
    y, hit = F.col(label) == 1, F.col(score) >= threshold
    tp, fp, fn = F.count_if(y & hit), F.count_if(~y & hit), F.count_if(y & ~hit)
    return scored_rows(df, label, score).agg(
        F.try_divide(F.count_if(y == hit), F.count("*")).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def confusion_matrix(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """All four cells of real against predicted, empty ones included."""
    y, hit = F.col(label) == 1, F.col(score) >= threshold
    one = scored_rows(df, label, score).agg(
        F.count_if(~y & ~hit).alias("c00"), F.count_if(~y & hit).alias("c01"),
        F.count_if(y & ~hit).alias("c10"), F.count_if(y & hit).alias("c11"),
    )
    cells = [
        F.struct(F.lit(r).alias("real"), F.lit(p).alias("predicho"), F.col(f"c{r}{p}").alias("n"))
        for r in (0, 1) for p in (0, 1)
    ]
    return one.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def calibration(df: DataFrame, label: str, score: str, bins: int = 10) -> DataFrame:
    """Mean score against mean outcome in quantile bins of the score; equal edges merge."""
    probs = [i / bins for i in range(bins + 1)]
    names = [f"e{i}" for i in range(bins + 1)]
    rows = scored_rows(df, label, score)
    row = exact_quantiles(rows, score, probs, names).first()
    edges = sorted({row[n] for n in names}) if row else [0.0, 1.0]
    return (
        rows.groupBy(B.quantile_band(score, edges).alias("grupo"))
        .agg(
            F.count("*").alias("n"),
            F.avg(score).alias("score_medio"),
            F.avg(F.col(label).cast("double")).alias("tasa_real"),
        )
    )


def metric_row(df: DataFrame, label: str, score: str, model: str, features: str) -> DataFrame:
    """One report row: base rate, area, average precision, lift, Brier, precision, recall and F1."""
    return metric_rows(df, label, score).select(
        F.lit(model).alias("modelo"), F.lit(features).alias("features"), "*")


def metric_rows(
    df: DataFrame, label: str, score: str, keys: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """The numbers of a report row, for every key at once if there are any."""
    n = [F.col(weight).alias("n")] if weight else []
    kept = df.select(*keys, F.col(label).cast("int").alias("y"), F.col(score).cast("double").alias("p"), *n)
    points = curve_points(kept, "y", "p", keys=keys, weight="n" if weight else None)
    rate = F.try_divide(F.max("positivos"), F.max("positivos") + F.max("negativos"))
    # Every metric is a sum over distinct scores, so one pass over the counts gives them all.
    s, n = F.col("umbral"), F.col("_pos") + F.col("_neg")
    squared = F.col("_pos") * F.pow(s - 1, F.lit(2)) + F.col("_neg") * F.pow(s, F.lit(2))
    tp = F.sum(F.when(s >= 0.5, F.col("_pos")).otherwise(0))
    fp = F.sum(F.when(s >= 0.5, F.col("_neg")).otherwise(0))
    fn = F.sum(F.when(s < 0.5, F.col("_pos")).otherwise(0))
    return points.groupBy(*keys).agg(
        F.round(rate, 4).alias("tasa_base_test"),
        F.round(_area(points), 4).alias("roc_auc"),
        F.round(_average_precision(), 4).alias("average_precision"),
        F.round(F.try_divide(_average_precision(), rate), 3).alias("lift_vs_azar"),
        F.round(F.try_divide(F.sum(squared), F.sum(n)), 4).alias("brier"),
        F.round(_ratio(tp, tp + fp), 4).alias("precision_u050"),
        F.round(_ratio(tp, tp + fn), 4).alias("recall_u050"),
        F.round(_ratio(2 * tp, 2 * tp + fp + fn), 4).alias("f1_u050"),
    )


def with_gap(search: DataFrame) -> DataFrame:
    """Train area minus validation area of every configuration."""
    return search.withColumn(
        "brecha_sobreajuste", F.round(F.col("roc_auc_train") - F.col("roc_auc_val"), 4)
    )


def best_row(df: DataFrame, measure: str, tie: Sequence[str]) -> DataFrame:
    """The row with the largest measure; ties go to the first by ``tie``."""
    return df.orderBy(F.col(measure).desc(), *tie).limit(1)


def mark_selected(metrics: DataFrame, measure: str = "roc_auc_val", tie: Sequence[str] = ("features", "modelo")) -> DataFrame:
    """Flag the winning row of a small result table (one row per model and feature set)."""
    place = F.row_number().over(W.orderBy(F.col(measure).desc(), *tie))
    return metrics.withColumn("seleccionado", place == 1)


def test_area_pivot(metrics: DataFrame, algorithms: Sequence[str]) -> DataFrame:
    """Area on the test rows by feature set (rows) and algorithm (columns), of a small result table."""
    return metrics.groupBy("features").agg(
        *[F.max(F.when(F.col("modelo") == a, F.col("roc_auc"))).alias(a) for a in algorithms])


def deployment_gate(
    metrics: DataFrame, with_weather: Sequence[str], without_weather: Sequence[str]
) -> DataFrame:
    """Pass or fail of the selected model against the four thresholds set before the test."""
    chosen = F.col("seleccionado")
    pick = lambda c: F.max(F.when(chosen, F.col(c)))
    auc = lambda names: F.max(F.when(F.col("features").isin(*names), F.col("roc_auc")))
    one = metrics.agg(
        pick("lift_vs_azar").alias("lift"), pick("roc_auc").alias("auc"), pick("brier").alias("brier"),
        (auc(with_weather) - auc(without_weather)).alias("aporte"),
    )
    # The four indicators and their thresholds.
    rules = [
        ("Lift sobre la tasa base", ">= 1.50", F.round("lift", 3), F.col("lift") >= 1.50),
        ("ROC-AUC en datos futuros", ">= 0.65", F.round("auc", 4), F.col("auc") >= 0.65),
        ("Brier score (calibracion)", "<= 0.13", F.round("brier", 4), F.col("brier") <= 0.13),
        ("Aporte del clima al AUC", "> 0", F.round("aporte", 4), F.col("aporte") > 0),
    ]
    cells = [
        F.struct(
            F.lit(name).alias("kpi"), F.lit(limit).alias("umbral"), value.alias("obtenido"),
            F.when(ok, "CUMPLE").otherwise("NO CUMPLE").alias("resultado"),
        )
        for name, limit, value, ok in rules
    ]
    return one.select(F.explode(F.array(*cells)).alias("r")).select("r.*")
