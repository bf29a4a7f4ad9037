"""Evaluation of a score against a label: line items, 'returned' against quantity and discount."""

from __future__ import annotations

from pyspark.sql import functions as F

from slotwise.operators import metrics as X
from slotwise.operators.models import temporal_split
from slotwise.plans import tables
from slotwise.plans.registry import query, tidy
from slotwise.plans.sql import CURVE, SCORED


def scored(spark, d):
    li = tables.table(spark, d, "lineitem")
    return li.select(
        (F.col("l_returnflag") == "R").cast("int").alias("y"), (F.col("l_quantity") / 50.0).alias("p"),
        (F.col("l_discount") * 10.0).alias("q"), "l_shipdate")


@query("X1_roc_auc", f"""WITH {CURVE}
SELECT round(sum(neg * (tp - pos / 2.0)) / any_value(tot_p) / any_value(tot_n), 6) AS roc_auc FROM points""")
def roc_auc(spark, d):
    return tidy(X.roc_auc(scored(spark, d), "y", "p"))


@query("X2_roc_curve", f"""WITH {CURVE}
SELECT umbral, round(fp / tot_n, 6) AS fpr, round(tp / tot_p, 6) AS tpr FROM points""")
def roc_curve(spark, d):
    return tidy(X.roc_curve(scored(spark, d), "y", "p"))


@query("X3_precision_recall_curve", f"""WITH {CURVE}
SELECT umbral, round(tp / (tp + fp), 6) AS "precision", round(tp / tot_p, 6) AS recall FROM points""")
def pr_curve(spark, d):
    return tidy(X.precision_recall_curve(scored(spark, d), "y", "p"))


@query("X4_average_precision", f"""WITH {CURVE}
SELECT round(sum(pos / tot_p * tp / (tp + fp)), 6) AS average_precision FROM points""")
def average_precision(spark, d):
    return tidy(X.average_precision(scored(spark, d), "y", "p"))


@query("X5_lift", f"""WITH {CURVE}
SELECT round(any_value(tot_p / (tot_p + tot_n)), 6) AS tasa_base,
       round(sum(pos / tot_p * tp / (tp + fp)) / any_value(tot_p / (tot_p + tot_n)), 6) AS lift_vs_azar FROM points""")
def lift(spark, d):
    return tidy(X.lift(scored(spark, d), "y", "p"))


@query("X6_brier", f"WITH {SCORED} SELECT round(avg((p - y) * (p - y)), 6) AS brier FROM scored")
def brier(spark, d):
    return tidy(X.brier(scored(spark, d), "y", "p"))


_CELLS = f"""WITH {SCORED},
c AS (SELECT count(*) FILTER (WHERE y = 1 AND p >= 0.5) AS tp, count(*) FILTER (WHERE y = 0 AND p >= 0.5) AS fp,
             count(*) FILTER (WHERE y = 1 AND p < 0.5) AS fn, count(*) FILTER (WHERE y = 0 AND p < 0.5) AS tn FROM scored)"""


@query("X7_threshold_metrics", _CELLS + """
SELECT round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS "precision",
       round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM c""")
def threshold_metrics(spark, d):
    return tidy(X.threshold_metrics(scored(spark, d), "y", "p"))


@query("X8_confusion_matrix", _CELLS + """
SELECT 0::BIGINT AS "real", 0::BIGINT AS predicho, tn AS n FROM c UNION ALL SELECT 0, 1, fp FROM c
UNION ALL SELECT 1, 0, fn FROM c UNION ALL SELECT 1, 1, tp FROM c""")
def confusion(spark, d):
    return tidy(X.confusion_matrix(scored(spark, d), "y", "p"))


@query("X9_calibration", f"""WITH {SCORED},
e AS (SELECT unnest(quantile_cont(p, [0,.1,.2,.3,.4,.5,.6,.7,.8,.9,1.0])) AS edge FROM scored), u AS (SELECT DISTINCT edge FROM e),
i AS (SELECT edge FROM u WHERE edge > (SELECT min(edge) FROM u) AND edge < (SELECT max(edge) FROM u)),
b AS (SELECT y, p, (SELECT count(*) FROM i WHERE edge < p) AS grupo FROM scored)
SELECT grupo, count(*) AS n, round(avg(p), 6) AS score_medio, round(avg(y), 6) AS tasa_real FROM b GROUP BY grupo""")
def calibration(spark, d):
    return tidy(X.calibration(scored(spark, d), "y", "p"))


@query("X10_metric_row", f"""WITH {CURVE},
r AS (SELECT any_value(tot_p / (tot_p + tot_n)) AS base, sum(neg * (tp - pos / 2.0)) / any_value(tot_p) / any_value(tot_n) AS auc,
             sum(pos / tot_p * tp / (tp + fp)) AS ap FROM points),
c AS (SELECT avg((p - y) * (p - y)) AS brier, count(*) FILTER (WHERE y = 1 AND p >= 0.5) AS tp,
             count(*) FILTER (WHERE y = 0 AND p >= 0.5) AS fp, count(*) FILTER (WHERE y = 1 AND p < 0.5) AS fn FROM scored)
SELECT 'cantidad' AS modelo, 'lineitem' AS features, round(base, 4) AS tasa_base_test, round(auc, 4) AS roc_auc,
       round(ap, 4) AS average_precision, round(ap / base, 3) AS lift_vs_azar, round(brier, 4) AS brier,
       round(tp / (tp + fp), 4) AS precision_u050, round(tp / (tp + fn), 4) AS recall_u050,
       round(2 * tp / (2 * tp + fp + fn), 4) AS f1_u050 FROM r, c""")
def metric_row(spark, d):
    return X.metric_row(scored(spark, d), "y", "p", "cantidad", "lineitem")


# A result table as a search leaves it, one row per supplier nation taken as a configuration.
_RESULTS = """res AS (
  SELECT CASE WHEN s_nationkey % 2 = 0 THEN 'solo operacion' ELSE 'clima + operacion' END AS features, 'm' || s_nationkey AS modelo,
         round(avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END) + 0.3, 4) AS roc_auc_train,
         round(avg(l_discount) * 10 + s_nationkey / 100, 4) AS roc_auc_val, round(avg(l_tax) * 10 + 0.2, 4) AS roc_auc,
         round(avg(l_quantity) / 20, 3) AS lift_vs_azar, round(avg(l_tax) * 3, 4) AS brier
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_nationkey)"""


def results(spark, d):
    li, s = tables.table(spark, d, "lineitem"), tables.table(spark, d, "supplier")
    per = li.join(s, li.l_suppkey == s.s_suppkey).groupBy("s_nationkey").agg(
        F.round(F.avg((F.col("l_returnflag") == "R").cast("double")) + 0.3, 4).alias("roc_auc_train"),
        F.round(F.avg("l_discount") * 10 + F.col("s_nationkey") / 100, 4).alias("roc_auc_val"),
        F.round(F.avg("l_tax") * 10 + 0.2, 4).alias("roc_auc"),
        F.round(F.avg("l_quantity") / 20, 3).alias("lift_vs_azar"),
        F.round(F.avg("l_tax") * 3, 4).alias("brier"),
    )
    return per.select(
        F.when(F.col("s_nationkey") % 2 == 0, "solo operacion").otherwise("clima + operacion").alias("features"),
        F.concat(F.lit("m"), "s_nationkey").alias("modelo"), "roc_auc_train", "roc_auc_val", "roc_auc", "lift_vs_azar", "brier")


@query("X11_overfit_gap", f"""WITH {_RESULTS}
SELECT features, modelo, roc_auc_train, roc_auc_val, round(roc_auc_train - roc_auc_val, 4) AS brecha_sobreajuste FROM res""")
def overfit_gap(spark, d):
    return X.with_gap(results(spark, d).select("features", "modelo", "roc_auc_train", "roc_auc_val"))


@query("X11_worst_overfit", f"""WITH {_RESULTS}
SELECT features, modelo, round(roc_auc_train - roc_auc_val, 4) AS brecha_sobreajuste FROM res ORDER BY 3 DESC, features, modelo LIMIT 1""")
def worst_overfit(spark, d):
    gaps = X.with_gap(results(spark, d)).select("features", "modelo", "brecha_sobreajuste")
    return X.best_row(gaps, "brecha_sobreajuste", ["features", "modelo"])


@query("X12_deployment_gate", f"""WITH {_RESULTS},
w AS (SELECT * FROM res ORDER BY roc_auc_val DESC, features, modelo LIMIT 1),
g AS (SELECT max(roc_auc) FILTER (WHERE features = 'clima + operacion') - max(roc_auc) FILTER (WHERE features = 'solo operacion') AS a FROM res)
SELECT 'Lift sobre la tasa base' AS kpi, '>= 1.50' AS umbral, round(lift_vs_azar, 3) AS obtenido,
       CASE WHEN lift_vs_azar >= 1.5 THEN 'CUMPLE' ELSE 'NO CUMPLE' END AS resultado FROM w
UNION ALL SELECT 'ROC-AUC en datos futuros', '>= 0.65', round(roc_auc, 4), CASE WHEN roc_auc >= 0.65 THEN 'CUMPLE' ELSE 'NO CUMPLE' END FROM w
UNION ALL SELECT 'Brier score (calibracion)', '<= 0.13', round(brier, 4), CASE WHEN brier <= 0.13 THEN 'CUMPLE' ELSE 'NO CUMPLE' END FROM w
UNION ALL SELECT 'Aporte del clima al AUC', '> 0', round(a, 4), CASE WHEN a > 0 THEN 'CUMPLE' ELSE 'NO CUMPLE' END FROM g""")
def deployment_gate(spark, d):
    marked = X.mark_selected(results(spark, d))
    return X.deployment_gate(marked, ["clima + operacion"], ["solo operacion"])


@query("M18_selection_and_test_pivot", f"""WITH {_RESULTS}
SELECT modelo, features, roc_auc, row_number() OVER (ORDER BY roc_auc_val DESC, features, modelo) = 1 AS seleccionado FROM res""")
def selection(spark, d):
    return X.mark_selected(results(spark, d)).select("modelo", "features", "roc_auc", "seleccionado")


@query("M14_temporal_split", """
SELECT CASE WHEN year(l_shipdate) < 1999 THEN 'train' WHEN year(l_shipdate) = 1999 THEN 'val' ELSE 'test' END AS tramo,
       count(*) AS n, round(avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END), 6) AS tasa FROM lineitem GROUP BY 1""")
def split(spark, d):
    tagged = temporal_split(scored(spark, d).withColumn("anio", F.year("l_shipdate")), "anio", 1999, 2000)
    return tidy(tagged.groupBy("tramo").agg(F.count("*").alias("n"), F.avg(F.col("y").cast("double")).alias("tasa")))
