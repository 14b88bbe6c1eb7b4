"""Scoring bundles: everything a score needs, saved as one pipeline.

A bundle is a ``PipelineModel`` of an input check, the fitted model and the decision
stage, which carries threshold, reference date and name of the model. Loading it
on another cluster gives the same decisions; a table without a required input is
refused by name before anything is computed. Both added stages are stateless, so a
bundle also scores a stream.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import risk_grade
from . import evaluate as E
from .ordered import named


class InputCheck(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Refuses a table without the required inputs; inputs that should be numbers and come
    as text are read as numbers (text that is none becomes null)."""
    inputs = Param(Params._dummy(), "inputs", "JSON object: input column -> 'number' or 'text'", TypeConverters.toString)

    @keyword_only
    def __init__(self, inputs=None):
        super().__init__()
        if inputs is not None:
            self._set(inputs=inputs if isinstance(inputs, str) else json.dumps(inputs))

    def _transform(self, df: DataFrame) -> DataFrame:
        want = json.loads(self.getOrDefault(self.inputs))
        missing = sorted(c for c in want if c not in df.columns)
        if missing:
            raise ValueError(f"required inputs are missing: {', '.join(missing)}")
        text = [c for c, kind in want.items() if kind == "number" and isinstance(df.schema[c].dataType, T.StringType)]
        return df.withColumns({c: named(c).try_cast("double") for c in text}) if text else df


class Decision(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """``churn_probability`` (from a ``probability`` vector, or from the numeric column
    ``scoreCol``), ``threshold``, ``churn_decision`` (1 from the threshold on) and
    ``risk_grade``. A null score has a null decision and grade."""
    threshold = Param(Params._dummy(), "threshold", "score from which a member counts as leaving", TypeConverters.toFloat)
    scoreCol = Param(Params._dummy(), "scoreCol", "probability vector or score column", TypeConverters.toString)
    referenceDate = Param(Params._dummy(), "referenceDate", "date that day counts refer to", TypeConverters.toString)
    modelKey = Param(Params._dummy(), "modelKey", "name of the model", TypeConverters.toString)

    @keyword_only
    def __init__(self, threshold=0.5, scoreCol="probability", referenceDate="", modelKey=""):
        super().__init__()
        self._setDefault(threshold=0.5, scoreCol="probability", referenceDate="", modelKey="")
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        c = self.getOrDefault(self.scoreCol)
        vector = not isinstance(df.schema[c].dataType, T.NumericType)
        p = F.get(vector_to_array(named(c)), F.lit(1)) if vector else named(c).cast("double")
        t = F.lit(float(self.getOrDefault(self.threshold)))
        out = df.withColumn("churn_probability", p).withColumn("threshold", t)
        return (out.withColumn("churn_decision", (F.col("churn_probability") >= F.col("threshold")).cast("int"))
                .withColumn("risk_grade", risk_grade("churn_probability")))


def bundle(model: PipelineModel, numeric: Sequence[str], categorical: Sequence[str] = (), threshold: float = 0.5,
           reference_date: str = "", model_key: str = "") -> PipelineModel:
    """The fitted model between an input check and the decision stage."""
    check = InputCheck(inputs={**{c: "number" for c in numeric}, **{c: "text" for c in categorical}})
    decide = Decision(threshold=float(threshold), referenceDate=str(reference_date), modelKey=model_key)
    return PipelineModel(stages=[check, *model.stages, decide])


def decide(b: PipelineModel, df: DataFrame, id_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """Decisions of a bundle for every row."""
    return b.transform(df).select(id_col, *keep, "churn_probability", "threshold", "churn_decision", "risk_grade")


def train(spec, df: DataFrame, id_col: str, label: str, numeric: Sequence[str], categorical: Sequence[str] = (),
          split: str = "split", reference_date: str = "", model_key: str | None = None, fraction: float = 1.0,
          seed: int = 42, **fit_args) -> tuple[PipelineModel, DataFrame]:
    """The whole trainer: fit on the training rows (or a stratified ``fraction`` of them), choose the
    threshold of the best F1 on the validation rows, judge it on the test rows, never
    the other way round. Returns the bundle and its record (one row: ``model_key,
    label, threshold``, test metrics, confusion cells, ``total_samples``)."""
    from ..session import materialize
    from . import models as M
    from .splits import stratified_subsample
    key = model_key or spec.name
    keep = list(dict.fromkeys([id_col, label, split, *numeric, *categorical]))
    data = materialize(df.select(*keep), "trainer")
    seen = {r[0] for r in data.select(split).distinct().limit(10).collect()}
    if not {"train", "validation", "test"} <= seen:
        raise ValueError(f"{split} needs train, validation and test rows, found {sorted(map(str, seen))}")
    part = data.filter(F.col(split) == "train")
    if fraction < 1.0:
        part = stratified_subsample(part, id_col, label, fraction, seed)
    model = M.fit(spec, part, numeric, categorical, label, seed=seed, **fit_args)
    scored = M.score(model, data.filter(F.col(split) != "train"), keep=[split, F.col(label).cast("int").alias("y_true")])
    scored = materialize(scored, "trainer_scores")
    best = E.best_f1_threshold(scored.filter(F.col(split) == "validation"), "y_true", "y_score").first()
    threshold = float(best["threshold"]) if best else 0.5
    record = E.metrics(scored.filter(F.col(split) == "test"), "y_true", "y_score", threshold)
    record = record.select(F.lit(key).alias("model_key"), F.lit(f"fraction {fraction:g}").alias("label"), "*")
    return bundle(model, numeric, categorical, threshold, reference_date, key), record


def search(spec, grid: dict[str, Sequence], df: DataFrame, id_col: str, label: str, numeric: Sequence[str],
           categorical: Sequence[str] = (), k: int = 5, seed: int = 42, metric: str = "areaUnderPR", parallel: int = 4,
           standard: Sequence[str] = (), robust: Sequence[str] = ()) -> tuple[PipelineModel, DataFrame]:
    """Cross-validated grid search (H11). Folds are ranks of id hashes inside each class, so
    they do not depend on partitions; imputer, scaler and encoder are fitted in every fold. Returns
    the model refitted on all rows with the best point and one row per point (the
    parameters as text, mean and deviation of the metric, rank; ties in grid order)."""
    from itertools import product

    from pyspark.ml import Pipeline
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator

    from ..session import materialize
    from . import models as M
    from .splits import kfold
    from .transformer import ColumnTransformer
    if not grid:
        raise ValueError("the grid is empty")
    data = df.select(*dict.fromkeys([id_col, label, *numeric, *categorical])).withColumn(label, F.col(label).cast("double"))
    data = kfold(data.filter(F.col(label).isNotNull()), id_col, label, k, seed)
    data = materialize(data.repartition(data.sparkSession.sparkContext.defaultParallelism, id_col).sortWithinPartitions(id_col), "folds")
    clf = M._classifier(spec, 0, data.count(), label, seed)
    scaled = {*standard, *robust}
    ct = ColumnTransformer(standard=[c for c in numeric if c in standard], robust=[c for c in numeric if c in robust],
                           passthrough=[c for c in numeric if c not in scaled], categorical=list(categorical))
    ct._set(outputCol="features")
    points = [dict(zip(grid, values)) for values in product(*grid.values())]
    maps = [{clf.getParam(p): v for p, v in point.items()} for point in points]
    judge = BinaryClassificationEvaluator(labelCol=label, metricName=metric, numBins=0)
    cv = CrossValidator(estimator=Pipeline(stages=[ct, clf]), estimatorParamMaps=maps, evaluator=judge,
                        numFolds=k, foldCol="fold", parallelism=parallel)
    fitted = cv.fit(data)
    rows = [(json.dumps(p, sort_keys=True), round(float(m), 6), round(float(s), 6))
            for p, m, s in zip(points, fitted.avgMetrics, fitted.stdMetrics)]
    order = sorted(range(len(rows)), key=lambda i: (-rows[i][1], i))
    ranked = [(*rows[i], order.index(i) + 1) for i in range(len(rows))]
    table = df.sparkSession.createDataFrame(ranked, "params string, mean_metric double, std_metric double, rank int")
    return fitted.bestModel, table
