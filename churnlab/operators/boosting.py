"""Boosting rounds chosen by average precision on validation rows.

The trees of a fitted ensemble are a bounded table (rounds x nodes), so every
task gets them as arrays: one pass over the validation rows gives the margin of
each row after every round, counted straight into per-round score histograms
(scores rounded to ``digits``). Histograms are combined by Spark and the average
precision of all rounds is one grouped job. The chosen prefix is cut out of the
fitted ensemble; nothing is fitted again for it.

Rounds are seeded one by one, so an ensemble of more rounds starts with the trees of
a shorter one. The ensemble is therefore grown in doubling sizes until the patience
rule is decided: at most twice the rounds that the rule needs.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from .evaluate import _auc_ap, cumulative

HISTOGRAM_ROWS = 1 << 20    # distinct (round, score) pairs that a task holds


def tree_arrays(model: GBTClassificationModel) -> dict[str, np.ndarray]:
    """``feature``, ``threshold``, ``left``, ``right``, ``value`` by (tree, node);
    a leaf has ``left`` -1. Read from the saved form of the model."""
    from pyspark.sql import SparkSession
    path = scratch_path(SparkSession.getActiveSession(), "ensemble")
    model.write().overwrite().save(path)
    t = (SparkSession.getActiveSession().read.parquet(f"{path}/data").select(
        "treeID", "nodeData.id", "nodeData.prediction", "nodeData.leftChild", "nodeData.rightChild",
        F.col("nodeData.split.featureIndex").alias("f"), F.col("nodeData.split.numCategories").alias("categories"),
        F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"))).toPandas()
    if ((t.leftChild >= 0) & (t.categories >= 0)).any():
        raise ValueError("categorical splits are not supported; encode categories as columns")
    shape = (model.getNumTrees, int(t.id.max()) + 1)
    out = {"feature": np.zeros(shape, np.int32), "threshold": np.zeros(shape), "left": np.full(shape, -1, np.int32),
           "right": np.full(shape, -1, np.int32), "value": np.zeros(shape)}
    at = (t.treeID.to_numpy(), t.id.to_numpy())
    inner = t.leftChild.to_numpy() >= 0
    out["feature"][at] = np.where(inner, t.f, 0)
    out["threshold"][at] = np.where(inner, t.threshold, 0.0)
    out["left"][at], out["right"][at] = t.leftChild, t.rightChild
    out["value"][at] = t.prediction.to_numpy() * np.array(model.treeWeights)[at[0]]
    return out


def round_margins(trees: dict[str, np.ndarray], x: np.ndarray):
    """Margin of every row of ``x`` after each round."""
    margin = np.zeros(len(x))
    rows = np.arange(len(x))
    for k in range(len(trees["value"])):
        left, right = trees["left"][k], trees["right"][k]
        at = np.zeros(len(x), np.int32)
        while True:
            inner = left[at] >= 0
            if not inner.any():
                break
            low = x[rows, trees["feature"][k][at]] <= trees["threshold"][k][at]
            at = np.where(inner, np.where(low, left[at], right[at]), at)
        margin = margin + trees["value"][k][at]
        yield margin


def round_histograms(model: GBTClassificationModel, df: DataFrame, label: str, features: str = "features",
                     first: int = 1, digits: int = 6) -> DataFrame:
    """``round, score, pos, neg``: rows by probability of class 1 (rounded to
    ``digits``) after every round from ``first`` on. Rows without a label are left out."""
    trees = tree_arrays(model)

    def run(batches):
        held: list[tuple] = []
        size = 0
        for batch in batches:
            y = batch.column("y").to_numpy(zero_copy_only=False)
            width = len(batch.column("x")[0]) if len(batch) else 0
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(y), width)
            for k, margin in enumerate(round_margins(trees, x), 1):
                if k < first:
                    continue
                p = np.round(1.0 / (1.0 + np.exp(-2.0 * margin)), digits)
                score, at = np.unique(p, return_inverse=True)
                pos = np.bincount(at, y == 1, len(score)).astype(np.int64)
                held.append((np.full(len(score), k, np.int32), score, pos, np.bincount(at, minlength=len(score)) - pos))
                size += len(score)
                if size >= HISTOGRAM_ROWS:
                    yield _batch(held)
                    held, size = [], 0
        if held:
            yield _batch(held)

    rows = df.filter(F.col(label).isNotNull()).select(F.col(label).cast("int").alias("y"), vector_to_array(features).alias("x"))
    part = rows.mapInArrow(run, "round int, score double, pos long, neg long")
    return part.groupBy("round", "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def _batch(held: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], ["round", "score", "pos", "neg"])


def round_average_precision(model: GBTClassificationModel, df: DataFrame, label: str, features: str = "features",
                            first: int = 1, digits: int = 6) -> DataFrame:
    """``round, pr_auc`` of every round from ``first`` on. The histograms are written once:
    the running counts read them several times, and joins have to see their real size
    (an estimate by the rows they come from is small enough for a broadcast)."""
    hist = materialize(round_histograms(model, df, label, features, first, digits), "round_histograms")
    return _auc_ap(cumulative(None, label, "score", ["round"], hist=hist), ["round"]).select("round", "pr_auc")


def patience_rule(values: Sequence[float], patience: int) -> tuple[int, bool]:
    """Best round (1-based) of the values seen and whether ``patience`` rounds
    passed after it without an improvement. Equal values keep the earlier round."""
    best, at = float("-inf"), 0
    for k, v in enumerate(values, 1):
        if v > best:
            best, at = v, k
        elif k - at >= patience:
            return at, True
    return at, False


def truncate(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The first ``rounds`` rounds of a fitted ensemble as a model of its own."""
    j = model._java_obj
    if rounds >= model.getNumTrees:
        return model
    from pyspark.sql import SparkSession
    sc = SparkSession.getActiveSession().sparkContext
    trees, weights = j.trees(), j.treeWeights()
    jvm = sc._jvm
    some = sc._gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    w = sc._gateway.new_array(jvm.double, rounds)
    for k in range(rounds):
        some[k], w[k] = trees[k], weights[k]
    cut = jvm.org.apache.spark.ml.classification.GBTClassificationModel(j.uid(), some, w, j.numFeatures(), 2)
    out = GBTClassificationModel(j.copyValues(cut, j.extractParamMap()))
    out._resetUid(model.uid)
    out._transfer_params_from_java()
    return out


def fit_by_average_precision(classifier, train: DataFrame, valid: DataFrame, label: str, patience: int = 50,
                             first: int | None = None, digits: int = 6):
    """Grow ``classifier`` (a ``GBTClassifier`` whose ``maxIter`` is the most rounds)
    until average precision on ``valid`` has not improved for ``patience`` rounds.
    Returns the model cut to its best round, that round and the values of all rounds seen."""
    most = classifier.getMaxIter()
    size, values = min(most, first or 2 * patience), []
    while True:
        model = classifier.copy({classifier.maxIter: size}).fit(train)
        got = round_average_precision(model, valid, label, first=len(values) + 1, digits=digits).collect()  # one row a round
        values += [round(r.pr_auc, 12) if r.pr_auc is not None else 0.0 for r in sorted(got, key=lambda r: r["round"])]
        best, settled = patience_rule(values, patience)
        if settled or size == most or not values:
            return truncate(model, max(best, 1)), max(best, 1), values
        size = min(most, 2 * size)
