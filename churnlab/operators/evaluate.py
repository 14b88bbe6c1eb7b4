"""Evaluation over a scored set ``(y, score)`` (F*), optionally per group.

Every curve metric starts from the score histogram -- one row per distinct
score with its positive and negative counts (a partial aggregate, so a score
shared by a third of the rows is one row after the map-side combine). The
running counts along descending score come from ``ordered.running_totals``,
which cuts the distinct scores into ranges instead of sending them through
one task. ``by`` adds grouping columns (one model key per group) to every
step, so all models are evaluated in the same jobs.

Definitions follow scikit-learn: ROC-AUC counts ties as half; average
precision is the step sum ``sum(dR * P)`` over distinct thresholds (not the
trapezoid of MLlib's ``areaUnderPR``); precision / recall / F1 use
``zero_division=0``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import safe_div
from .ordered import _with_bucket, null_safe_join, running_totals


def predictions(df: DataFrame, s: str, t: float, name: str = "y_pred") -> DataFrame:
    """``(score >= t)`` as 0/1."""
    return df.withColumn(name, (F.col(s) >= F.lit(float(t))).cast("int"))


def _counts(y: str, s: str, t: float):
    pred = F.col(s) >= F.lit(float(t))
    pos = F.col(y) == 1
    return [F.count(F.when(~pred & ~pos, 1)).alias("tn"), F.count(F.when(pred & ~pos, 1)).alias("fp"),
            F.count(F.when(~pred & pos, 1)).alias("fn"), F.count(F.when(pred & pos, 1)).alias("tp")]


def confusion(df: DataFrame, y: str, s: str, t: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    """Confusion counts with labels fixed to [0, 1]: ``(by..., tn, fp, fn, tp)``."""
    return df.groupBy(*by).agg(*_counts(y, s, t))


def _rates(tn, fp, fn, tp):
    total = tn + fp + fn + tp
    return [safe_div(tp + tn, total).alias("accuracy"),
            safe_div(tp, tp + fp).alias("precision"),
            safe_div(tp, tp + fn).alias("recall"),
            safe_div(2 * tp, 2 * tp + fp + fn).alias("f1")]


def classification_metrics(df: DataFrame, y: str, s: str, t: float = 0.5,
                           by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall, F1 at threshold ``t``."""
    c = confusion(df, y, s, t, by)
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    return c.select(*by, *_rates(tn, fp, fn, tp), "tn", "fp", "fn", "tp")


def score_histogram(df: DataFrame, y: str, s: str, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., score, pos, neg)`` per distinct score."""
    return (df.groupBy(*by, F.col(s).alias("score"))
            .agg(F.count(F.when(F.col(y) == 1, 1)).alias("pos"),
                 F.count(F.when(F.col(y) != 1, 1)).alias("neg")))


def cumulative(df: DataFrame, y: str, s: str, by: Sequence[str] = (),
               buckets: int | None = None, hist: DataFrame | None = None) -> DataFrame:
    """Per distinct score: ``tp``/``fp`` = positives / negatives with score >= it,
    plus group totals ``P`` and ``N``."""
    hist = hist if hist is not None else score_histogram(df, y, s, by)
    run = running_totals(hist.filter(F.col("score").isNotNull()), "score", ["pos", "neg"], by=by,
                         buckets=buckets, prefix="c_", descending=True, totals_prefix="all_")
    return (run.withColumnRenamed("c_pos", "tp").withColumnRenamed("c_neg", "fp")
            .withColumnRenamed("all_pos", "P").withColumnRenamed("all_neg", "N"))


def _auc_ap(cum: DataFrame, by: Sequence[str]) -> DataFrame:
    pn = F.col("P").cast("double") * F.col("N")     # counts beyond 3e9 overflow a long product
    return (cum.groupBy(*by)
            .agg(F.sum(F.col("pos") * (F.col("N") - F.col("fp") + 0.5 * F.col("neg"))).alias("_auc_num"),
                 F.sum(F.try_divide(F.col("pos"), F.col("P")) * (F.col("tp") / (F.col("tp") + F.col("fp")))).alias("_ap"),
                 F.first("P").alias("P"), F.first("N").alias("N"))
            .select(*by,
                    F.when(pn > 0, F.col("_auc_num") / pn).alias("roc_auc"),
                    F.when(F.col("P") > 0, F.col("_ap")).alias("pr_auc")))


def roc_auc(df: DataFrame, y: str, s: str, by: Sequence[str] = ()) -> DataFrame:
    """ROC-AUC with ties counted half; null when a class is absent."""
    return _auc_ap(cumulative(df, y, s, by), by).select(*by, "roc_auc")


def average_precision(df: DataFrame, y: str, s: str, by: Sequence[str] = ()) -> DataFrame:
    """Average precision (step sum over distinct thresholds)."""
    return _auc_ap(cumulative(df, y, s, by), by).select(*by, "pr_auc")


def _thin(cum: DataFrame, by: Sequence[str], keep) -> DataFrame:
    """Rows of a running-count table filtered by ``keep(pos, neg, next_pos,
    next_neg, first)``; the next lower score is found by an equi-join on the
    rank of the distinct scores (no window over a whole group)."""
    ranked = running_totals(cum.withColumn("_one", F.lit(1).cast("long")), "score", ["_one"], by=by,
                            prefix="_r", descending=True)
    nxt = ranked.select(*by, (F.col("_r_one") - 1).alias("_r_one"),
                        F.col("pos").alias("_npos"), F.col("neg").alias("_nneg"))
    j = null_safe_join(ranked, nxt, by, ["_r_one"], "left")
    last = F.col("_npos").isNull()
    return j.filter((F.col("_r_one") == 1) | last
                    | keep(F.col("pos"), F.col("neg"), F.col("_npos"), F.col("_nneg")))


def roc_curve(df: DataFrame, y: str, s: str, by: Sequence[str] = (),
              drop_intermediate: bool = False) -> DataFrame:
    """``(by..., threshold, fpr, tpr)``: one point per distinct score plus the
    start point ``(inf, 0, 0)``.

    ``drop_intermediate`` applies scikit-learn's thinning: an inner point is
    kept only where the curve bends. On running counts the second difference
    of (fp, tp) at a point is the change of (neg, pos) from it to the next
    lower score.
    """
    by = list(by)
    cum = cumulative(df, y, s, by)
    if drop_intermediate:
        cum = _thin(cum, by, lambda pos, neg, npos, nneg: (npos != pos) | (nneg != neg))
    point = _point(threshold=F.col("score"), fpr=F.try_divide(F.col("fp"), F.col("N")), tpr=F.try_divide(F.col("tp"), F.col("P")))
    start = _point(threshold=F.lit(float("inf")), fpr=F.lit(0.0), tpr=F.lit(0.0))
    # the highest score also gives the start point of its group
    first = F.col("tp") + F.col("fp") == F.col("pos") + F.col("neg")
    return cum.select(*by, F.inline(F.when(first, F.array(start, point)).otherwise(F.array(point))))


def _point(**cols) -> Column:
    return F.struct(*[c.cast("double").alias(n) for n, c in cols.items()])


def pr_curve(df: DataFrame, y: str, s: str, by: Sequence[str] = (),
             drop_intermediate: bool = False) -> DataFrame:
    """``(by..., threshold, precision, recall)`` per distinct score plus the end
    point ``(null, 1, 0)``. Recall is 1 everywhere when there is no positive.

    ``drop_intermediate`` (scikit-learn >= 1.3): an inner point is kept only
    where the true-positive count changes into or out of it.
    """
    by = list(by)
    cum = cumulative(df, y, s, by)
    if drop_intermediate:
        cum = _thin(cum, by, lambda pos, neg, npos, nneg: (pos != 0) | (npos != 0))
    point = _point(threshold=F.col("score"), precision=F.col("tp") / (F.col("tp") + F.col("fp")),
                   recall=F.when(F.col("P") > 0, F.try_divide(F.col("tp"), F.col("P"))).otherwise(F.lit(1.0)))
    end = _point(threshold=F.lit(None), precision=F.lit(1.0), recall=F.lit(0.0))
    first = F.col("tp") + F.col("fp") == F.col("pos") + F.col("neg")     # the highest score
    return cum.select(*by, F.inline(F.when(first, F.array(point, end)).otherwise(F.array(point))))


def trapezoid(curve: DataFrame, x: str, y: str, by: Sequence[str] = (),
              buckets: int | None = None) -> DataFrame:
    """Area under a curve by the trapezoid rule, points ordered by ``(x, y)``.

    The previous point of each point comes from a window inside x-ranges
    (approximate-quantile buckets); the first point of a range takes the last
    point of the range before it. No window spans a whole group.
    """
    by = list(by)
    from ..session import materialize
    from .ordered import _n_buckets
    # the points feed three consumers (cut points, lagged window, range ends): written once
    pts = materialize(curve.select(*by, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")), "curve")
    tagged = _with_bucket(pts, "_x", by, _n_buckets(pts, buckets))
    b = "_rt_bucket"
    w = Window.partitionBy(*by, b).orderBy("_x", "_y")
    local = (tagged.withColumn("_px", F.lag("_x").over(w)).withColumn("_py", F.lag("_y").over(w)))
    last = tagged.groupBy(*by, b).agg(F.max(F.struct("_x", "_y")).alias("_last"))
    prev = (last.withColumn("_prev", F.lag("_last").over(Window.partitionBy(*by).orderBy(b)))
            .select(*by, b, "_prev"))
    j = null_safe_join(local, prev, by, [b], "left")
    px = F.coalesce(F.col("_px"), F.col("_prev._x"))
    py = F.coalesce(F.col("_py"), F.col("_prev._y"))
    seg = F.when(px.isNull(), F.lit(0.0)).otherwise((F.col("_x") - px) * (F.col("_y") + py) / 2)
    return j.groupBy(*by).agg(F.sum(seg).alias("area"))


def best_f1_threshold(df: DataFrame, y: str, s: str, by: Sequence[str] = ()) -> DataFrame:
    """F1-optimal threshold on the PR curve: first maximum of
    ``2pr/(p+r+1e-12)`` in ascending threshold order; 0.5 when there is no
    threshold (empty input). ``(by..., threshold, f1)``."""
    cum = cumulative(df, y, s, by)
    p = F.col("tp") / (F.col("tp") + F.col("fp"))
    r = F.when(F.col("P") > 0, F.try_divide(F.col("tp"), F.col("P"))).otherwise(F.lit(1.0))
    f1 = 2 * p * r / (p + r + F.lit(1e-12))
    best = cum.groupBy(*by).agg(F.max(F.struct(f1.alias("f1"), (-F.col("score")).alias("_nt"))).alias("_b"))
    # no threshold at all (empty input): the fixed 0.5
    return best.select(*by, F.coalesce(-F.col("_b._nt"), F.lit(0.5)).alias("threshold"), F.col("_b.f1").alias("f1"))


def metrics(df: DataFrame, y: str, s: str, t: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    """Threshold metric bundle (F11): confusion counts, rates, ROC-AUC, AP,
    selected / actual churners / total -- one row per group.

    One pass over the scored set (the score histogram) and one aggregate over
    the running counts give the confusion cells at ``t`` and the curve sums
    together. Rows without a score are left out of every figure (``total`` counts
    the scored rows).
    """
    by = list(by)
    cum = cumulative(df, y, s, by)
    at = F.col("score") >= F.lit(float(t))
    pn = F.col("P").cast("double") * F.col("N")     # counts beyond 3e9 overflow a long product
    agg = cum.groupBy(*by).agg(
        F.coalesce(F.sum(F.when(~at, F.col("neg"))), F.lit(0)).alias("tn"),
        F.coalesce(F.sum(F.when(at, F.col("neg"))), F.lit(0)).alias("fp"),
        F.coalesce(F.sum(F.when(~at, F.col("pos"))), F.lit(0)).alias("fn"),
        F.coalesce(F.sum(F.when(at, F.col("pos"))), F.lit(0)).alias("tp"),
        F.sum(F.col("pos") * (F.col("N") - F.col("fp") + 0.5 * F.col("neg"))).alias("_auc_num"),
        F.sum(F.try_divide(F.col("pos"), F.col("P")) * (F.col("tp") / (F.col("tp") + F.col("fp")))).alias("_ap"),
        F.first("P").alias("P"), F.first("N").alias("N"))
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    return agg.select(*by, F.lit(float(t)).alias("threshold"), *_rates(tn, fp, fn, tp),
                      F.when(pn > 0, F.try_divide(F.col("_auc_num"), pn)).alias("roc_auc"),
                      F.when(F.col("P") > 0, F.col("_ap")).alias("pr_auc"),
                      "tn", "fp", "fn", "tp", (tp + fp).alias("selected"), (tp + fn).alias("actual_churn"),
                      (tn + fp + fn + tp).alias("total"))


def threshold_sweep(df: DataFrame, y: str, s: str, start: int = 5, stop: int = 95,
                    by: Sequence[str] = ()) -> DataFrame:
    """Metrics at thresholds start/100 .. stop/100 (step 0.01) in one pass.

    Each row is placed in the highest centile bin ``k`` with ``score >= k/100``
    (exact double comparison, so equal to evaluating every threshold); the
    per-threshold counts are suffix sums over at most 101 bins per group. Rows
    without a score are selected by no threshold and left out, as in ``metrics``.
    """
    by = list(by)
    sc = F.col(s).cast("double")
    b0 = F.floor(sc * 100).cast("int")
    b1 = (F.when(sc >= (b0 + 1).cast("double") / 100.0, b0 + 1)
          .when(sc < b0.cast("double") / 100.0, b0 - 1).otherwise(b0))
    binned = df.filter(sc.isNotNull()).select(*by, F.col(y).alias("_y"), F.greatest(F.least(b1, F.lit(100)), F.lit(-1)).alias("_k"))
    counts = (binned.groupBy(*by, "_k")
              .agg(F.count(F.when(F.col("_y") == 1, 1)).alias("_p"), F.count(F.when(F.col("_y") != 1, 1)).alias("_n")))
    tot = counts.groupBy(*by).agg(F.sum("_p").alias("P"), F.sum("_n").alias("N"))
    grid = tot.select(*by, "P", "N", F.explode(F.sequence(F.lit(-1), F.lit(100))).alias("_k"))
    g = null_safe_join(grid, counts, by, ["_k"], "left").fillna(0, ["_p", "_n"])
    above = Window.partitionBy(*by).orderBy(F.desc("_k")).rowsBetween(Window.unboundedPreceding, 0)
    g = g.withColumn("tp", F.sum("_p").over(above)).withColumn("fp", F.sum("_n").over(above))
    g = g.filter((F.col("_k") >= start) & (F.col("_k") <= stop))
    tp, fp = F.col("tp"), F.col("fp")
    fn, tn = F.col("P") - tp, F.col("N") - fp
    return g.select(*by, (F.col("_k").cast("double") / 100.0).alias("threshold"),
                    (tp + fp).alias("selected"), tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"),
                    *_rates(tn, fp, fn, tp))


def majority_baseline(df: DataFrame, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy of always predicting the majority class."""
    m = F.avg(F.col(y).cast("double"))
    return df.groupBy(*by).agg(F.greatest(m, 1 - m).alias("baseline_accuracy"))


def compare(scored: DataFrame, records: DataFrame, y: str, s: str, by: str = "model_key",
            latency: str = "latency_ms") -> DataFrame:
    """Comparison table (F14): the stored metrics and latency of every model that has both a
    record and a scored set, its average precision computed from the scored set, and
    the parts of its key. ``records`` has one row per model: ``accuracy, precision, recall, f1,
    roc_auc`` and the latency column."""
    from ..functions.columns import parse_key
    ap = average_precision(scored, y, s, [by])
    stored = records.select(by, parse_key(by).alias("_k"), "accuracy", "precision", "recall", "f1", "roc_auc",
                            F.col(latency).alias("latency_ms"))
    return stored.join(ap, by).select(by, "_k.model", "_k.dataset", "_k.excluded", "accuracy", "precision", "recall", "f1",
                                      "roc_auc", "pr_auc", "latency_ms")
