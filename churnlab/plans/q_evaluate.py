"""Registered queries: evaluation (F*, E11) over the scored set."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as FN
from ..operators import evaluate as E
from .common import members, scores
from .registry import register

K = ["model_key"]

_HIST = """h AS (SELECT model_key, y_score AS score, count(*) FILTER (WHERE y_true = 1) AS pos,
                 count(*) FILTER (WHERE y_true <> 1) AS neg FROM scores GROUP BY model_key, y_score),
cum AS (SELECT *, sum(pos) OVER (PARTITION BY model_key ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
               sum(neg) OVER (PARTITION BY model_key ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp,
               sum(pos) OVER (PARTITION BY model_key) AS P, sum(neg) OVER (PARTITION BY model_key) AS N FROM h)"""

_CONF = """conf AS (SELECT model_key,
  count(*) FILTER (WHERE y_score < 0.5 AND y_true <> 1) AS tn, count(*) FILTER (WHERE y_score >= 0.5 AND y_true <> 1) AS fp,
  count(*) FILTER (WHERE y_score < 0.5 AND y_true = 1) AS fn, count(*) FILTER (WHERE y_score >= 0.5 AND y_true = 1) AS tp
  FROM scores GROUP BY model_key)"""

_RATES = """CASE WHEN tn + fp + fn + tp = 0 THEN 0 ELSE (tp + tn) / (tn + fp + fn + tp) END AS accuracy,
  CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS precision,
  CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall,
  CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1"""

_AUC = """auc AS (SELECT model_key,
  CASE WHEN max(P) * max(N) > 0 THEN sum(pos * (N - fp + 0.5 * neg)) / (max(P) * max(N)) END AS roc_auc,
  CASE WHEN max(P) > 0 THEN sum(pos / P * (tp / (tp + fp))) END AS pr_auc FROM cum GROUP BY model_key)"""


@register("f1_predictions", """
SELECT member_id, model_key, y_true, y_score, CAST(y_score >= 0.5 AS INTEGER) AS y_pred FROM scores""")
def f1_predictions(spark, sf):
    return E.predictions(scores(spark, sf), "y_score", 0.5)


@register("f2_confusion", _CONF + "\nSELECT * FROM conf")
def f2_confusion(spark, sf):
    return E.confusion(scores(spark, sf), "y_true", "y_score", 0.5, K)


@register("f3_classification_metrics", _CONF + f"\nSELECT model_key, {_RATES}, tn, fp, fn, tp FROM conf")
def f3_classification_metrics(spark, sf):
    return E.classification_metrics(scores(spark, sf), "y_true", "y_score", 0.5, K)


@register("f4_roc_auc", _HIST + ",\n" + _AUC + "\nSELECT model_key, roc_auc FROM auc")
def f4_roc_auc(spark, sf):
    return E.roc_auc(scores(spark, sf), "y_true", "y_score", K)


@register("f4_roc_auc_churn_label", """
s AS (SELECT churn AS y, score FROM planted),
h AS (SELECT score, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y <> 1) AS neg FROM s GROUP BY score),
c AS (SELECT *, sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp,
             sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM h)
SELECT sum(pos * (N - fp + 0.5 * neg)) / (max(P) * max(N)) AS roc_auc FROM c""")
def f4_roc_auc_churn_label(spark, sf):
    from .common import planted
    return E.roc_auc(planted(spark, sf), "churn", "score")


@register("f5_average_precision", _HIST + ",\n" + _AUC + "\nSELECT model_key, pr_auc FROM auc")
def f5_average_precision(spark, sf):
    return E.average_precision(scores(spark, sf), "y_true", "y_score", K)


@register("f6_roc_curve", _HIST + """
SELECT model_key, score AS threshold, fp / N AS fpr, tp / P AS tpr FROM cum
UNION ALL
SELECT DISTINCT model_key, 'inf'::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM scores""")
def f6_roc_curve(spark, sf):
    return E.roc_curve(scores(spark, sf), "y_true", "y_score", K)


@register("f6_roc_curve_thinned", _HIST + """,
nx AS (SELECT *, row_number() OVER (PARTITION BY model_key ORDER BY score DESC) AS rk,
              lead(pos) OVER (PARTITION BY model_key ORDER BY score DESC) AS npos,
              lead(neg) OVER (PARTITION BY model_key ORDER BY score DESC) AS nneg FROM cum)
SELECT model_key, score AS threshold, fp / N AS fpr, tp / P AS tpr FROM nx
WHERE rk = 1 OR npos IS NULL OR npos <> pos OR nneg <> neg
UNION ALL
SELECT DISTINCT model_key, 'inf'::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM scores""")
def f6_roc_curve_thinned(spark, sf):
    return E.roc_curve(scores(spark, sf), "y_true", "y_score", K, drop_intermediate=True)


@register("f7_pr_curve", _HIST + """
SELECT model_key, score AS threshold, tp / (tp + fp) AS precision,
       CASE WHEN P > 0 THEN tp / P ELSE 1.0 END AS recall FROM cum
UNION ALL
SELECT DISTINCT model_key, NULL::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE FROM scores""")
def f7_pr_curve(spark, sf):
    return E.pr_curve(scores(spark, sf), "y_true", "y_score", K)


@register("f8_trapezoid_roc_area", _HIST + """,
pts AS (SELECT model_key, fp / N AS x, tp / P AS y FROM cum
        UNION ALL SELECT DISTINCT model_key, 0.0, 0.0 FROM scores),
seg AS (SELECT model_key, (x - lag(x) OVER w) * (y + lag(y) OVER w) / 2 AS a FROM pts
        WINDOW w AS (PARTITION BY model_key ORDER BY x, y))
SELECT model_key, sum(coalesce(a, 0.0)) AS area FROM seg GROUP BY model_key""")
def f8_trapezoid_roc_area(spark, sf):
    curve = E.roc_curve(scores(spark, sf), "y_true", "y_score", K)
    return E.trapezoid(curve, "fpr", "tpr", K)


@register("f9_best_f1_threshold", _HIST + """,
pr AS (SELECT model_key, score, tp / (tp + fp) AS p, CASE WHEN P > 0 THEN tp / P ELSE 1.0 END AS r FROM cum),
f AS (SELECT model_key, score, 2 * p * r / (p + r + 1e-12) AS f1 FROM pr),
b AS (SELECT *, row_number() OVER (PARTITION BY model_key ORDER BY f1 DESC, score) AS rn FROM f)
SELECT model_key, score AS threshold, f1 FROM b WHERE rn = 1""")
def f9_best_f1_threshold(spark, sf):
    return E.best_f1_threshold(scores(spark, sf), "y_true", "y_score", K)


_BUNDLE = _CONF + ",\n" + _HIST + ",\n" + _AUC + f"""
SELECT conf.model_key, 0.5::DOUBLE AS threshold, {_RATES}, roc_auc, pr_auc, tn, fp, fn, tp,
       tp + fp AS selected, tp + fn AS actual_churn, tn + fp + fn + tp AS total
FROM conf JOIN auc ON conf.model_key = auc.model_key"""


@register("f11_metric_bundle", "b AS (WITH " + _BUNDLE + ")\n"
          "SELECT * EXCLUDE (model_key) FROM b WHERE model_key = 'rule_50'")
def f11_metric_bundle(spark, sf):
    s = scores(spark, sf).filter(F.col("model_key") == "rule_50")
    return E.metrics(s, "y_true", "y_score", 0.5)


@register("f12_threshold_sweep", """
g AS (SELECT model_key, k FROM (SELECT DISTINCT model_key FROM scores) t, range(5, 96) r(k)),
c AS (SELECT g.model_key, k::DOUBLE / 100.0::DOUBLE AS threshold,
        count(*) FILTER (WHERE s.y_score >= k::DOUBLE / 100.0::DOUBLE AND y_true = 1) AS tp,
        count(*) FILTER (WHERE s.y_score >= k::DOUBLE / 100.0::DOUBLE AND y_true <> 1) AS fp,
        count(*) FILTER (WHERE s.y_score < k::DOUBLE / 100.0::DOUBLE AND y_true = 1) AS fn,
        count(*) FILTER (WHERE s.y_score < k::DOUBLE / 100.0::DOUBLE AND y_true <> 1) AS tn
      FROM g JOIN scores s ON s.model_key = g.model_key GROUP BY g.model_key, k)
SELECT model_key, threshold, tp + fp AS selected, tp, fp, fn, tn, """ + _RATES + " FROM c")
def f12_threshold_sweep(spark, sf):
    return E.threshold_sweep(scores(spark, sf), "y_true", "y_score", 5, 95, K)


@register("f14_compare", "b AS (WITH " + _BUNDLE + """),
k AS (SELECT model_key, split_part(model_key, '_without_', 1) AS base FROM b)
SELECT b.model_key, regexp_extract(base, '^(.*)_[^_]*$', 1) AS model,
       CASE WHEN suffix(base, '_50') THEN '50' ELSE 'full' END AS dataset,
       CASE WHEN contains(b.model_key, '_without_') THEN substr(b.model_key, strpos(b.model_key, '_without_') + 9) END AS excluded,
       accuracy, precision, recall, f1, roc_auc, pr_auc
FROM b JOIN k ON b.model_key = k.model_key""")
def f14_compare(spark, sf):
    m = E.metrics(scores(spark, sf), "y_true", "y_score", 0.5, K)
    return m.select("model_key", FN.parse_key("model_key").alias("k"), "accuracy", "precision", "recall",
                    "f1", "roc_auc", "pr_auc").select("model_key", "k.model", "k.dataset", "k.excluded",
                                                      "accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc")


@register("f14_compare_stored", "b AS (WITH " + _BUNDLE + """),
k AS (SELECT model_key, split_part(model_key, '_without_', 1) AS base FROM b)
SELECT b.model_key, regexp_extract(base, '^(.*)_[^_]*$', 1) AS model,
       CASE WHEN suffix(base, '_50') THEN '50' ELSE 'full' END AS dataset,
       CASE WHEN contains(b.model_key, '_without_') THEN substr(b.model_key, strpos(b.model_key, '_without_') + 9) END AS excluded,
       accuracy, precision, recall, f1, roc_auc, pr_auc, tp / total AS latency_ms
FROM b JOIN k ON b.model_key = k.model_key WHERE b.model_key <> 'rule_50'""")
def f14_compare_stored(spark, sf):
    # records of the result store beside the scored sets; a model without a record is left out
    from ..session import scratch_path
    from ..sources.files import upsert
    s = scores(spark, sf)
    m = E.metrics(s, "y_true", "y_score", 0.5, K).filter("model_key <> 'rule_50'")
    new = m.select("model_key", F.lit("main").alias("label"), "accuracy", "precision", "recall", "f1", "roc_auc",
                   (F.col("tp") / F.col("total")).alias("latency_ms"))
    return E.compare(s, upsert(spark, scratch_path(spark, "results"), new), "y_true", "y_score")


@register("f15_grouped_metrics", _BUNDLE)
def f15_grouped_metrics(spark, sf):
    return E.metrics(scores(spark, sf), "y_true", "y_score", 0.5, K)


@register("e11_majority_baseline", """
SELECT greatest(avg(churn::DOUBLE), 1 - avg(churn::DOUBLE)) AS baseline_accuracy FROM members""")
def e11_majority_baseline(spark, sf):
    return E.majority_baseline(members(spark, sf), "churn")
