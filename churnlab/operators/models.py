"""Classifiers on ``pyspark.ml`` (E*).

``fit`` builds one ``PipelineModel``: a column transformer (median imputation with
indicators, standard or robust scaling where asked for, ``Missing`` fill + one-hot),
a ``VectorAssembler`` and the classifier. Everything is fitted on the rows of
``fit_where`` (the training split), so test rows never move a parameter.

Estimator mapping (reference -> MLlib):

* logistic regression, C=1: ``LogisticRegression(regParam=1/(C*n))`` with
  ``standardization=False`` -- the same objective as scikit-learn's;
  ``class_weight='balanced'`` -> ``weightCol = n / (2 * n_class)``;
* random forest -> ``RandomForestClassifier`` (trees, depth, min leaf, sqrt);
* XGBoost / LightGBM -> ``GBTClassifier`` (first-order boosting; depth 5
  stands in for 31 leaves), ``scale_pos_weight`` -> ``weightCol``; early stopping on
  average precision in ``operators.boosting``;
* MLP -> ``MultilayerPerceptronClassifier`` (sigmoid hidden layers, L-BFGS);
* KNN -> ``operators.knn``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                       MultilayerPerceptronClassifier, RandomForestClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .transformer import ColumnTransformer


@dataclass
class ModelSpec:
    """A model of the sweep: estimator kind and its parameters."""
    name: str
    kind: str                      # logistic | randomforest | gbt | mlp | knn
    params: dict = field(default_factory=dict)
    balanced: bool = False         # class_weight='balanced'


# Reference hyperparameters.
REFERENCE_SPECS = {
    "logistic": ModelSpec("logistic", "logistic", {"C": 1.0, "maxIter": 1000}),
    "logistic_balanced": ModelSpec("logistic", "logistic", {"C": 1.0, "maxIter": 1000}, balanced=True),
    "randomforest": ModelSpec("randomforest", "randomforest",
                              {"numTrees": 200, "maxDepth": 7, "minInstancesPerNode": 50,
                               "featureSubsetStrategy": "sqrt"}),
    "xgboost": ModelSpec("xgboost", "gbt", {"maxIter": 200, "maxDepth": 5, "stepSize": 0.05,
                                            "subsamplingRate": 0.8}),
    "lightgbm": ModelSpec("lightgbm", "gbt", {"maxIter": 200, "maxDepth": 5, "stepSize": 0.05}),
    "importance": ModelSpec("importance", "gbt", {"maxIter": 200, "maxDepth": 6, "stepSize": 0.1}),
    "mlp": ModelSpec("mlp", "mlp", {"hidden": [128, 32, 8], "maxIter": 100, "blockSize": 16384}),
    "knn": ModelSpec("knn", "knn", {"k": 10, "weights": "uniform"}),
    "knn_distance": ModelSpec("knn", "knn", {"k": 15, "weights": "distance"}),
}


def _classifier(spec: ModelSpec, n_features: int, n_train: int, label: str, seed: int):
    p = dict(spec.params)
    if spec.kind == "logistic":
        c = float(p.pop("C", 1.0))
        lr = LogisticRegression(featuresCol="features", labelCol=label, regParam=1.0 / (c * max(n_train, 1)),
                                elasticNetParam=0.0, standardization=False,
                                maxIter=int(p.pop("maxIter", 100)), tol=float(p.pop("tol", 1e-4)))
        return lr.setWeightCol("_w") if spec.balanced else lr
    if spec.kind == "randomforest":
        return RandomForestClassifier(featuresCol="features", labelCol=label, seed=seed, **p)
    if spec.kind == "gbt":
        weighted = p.pop("scale_pos_weight", None) is not None
        gbt = GBTClassifier(featuresCol="features", labelCol=label, seed=seed, **p)
        return gbt.setWeightCol("_w") if weighted else gbt
    if spec.kind == "mlp":
        hidden = list(p.pop("hidden", [128, 32, 8]))
        return MultilayerPerceptronClassifier(featuresCol="features", labelCol=label, seed=seed,
                                              layers=[n_features, *hidden, 2], **p)
    raise ValueError(f"unknown model kind {spec.kind}")


def feature_stages(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], fit_where: str = "",
                   standard: Sequence[str] = (), robust: Sequence[str] = ()):
    """Fitted column transformer and the assembled feature names. Numeric columns
    are filled with their median (plus indicator); those in ``standard`` and ``robust``
    are also scaled."""
    scaled = {*standard, *robust}
    ct = ColumnTransformer(standard=[c for c in numeric if c in standard], robust=[c for c in numeric if c in robust],
                           passthrough=[c for c in numeric if c not in scaled], categorical=list(categorical),
                           fitWhere=fit_where).fit(df)
    return [ct], ct.featureNames, ct.transform(df)


def fit(spec: ModelSpec, df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (),
        label: str = "label", fit_where: str = "", seed: int = 42, checkpoint: bool = True,
        standard: Sequence[str] = (), robust: Sequence[str] = ()) -> PipelineModel:
    """Fit preprocessing + classifier on the ``fit_where`` rows -> PipelineModel.

    The fit runs several jobs over the same rows (imputer, encoder, class
    counts, solver iterations); with ``checkpoint`` the needed columns are
    written once to the checkpoint folder and every job reads that copy.
    ``standard`` and ``robust`` name the columns to scale (linear models, MLP).
    """
    if spec.kind == "knn":
        raise ValueError("use operators.knn.KNNClassifier for knn specs")
    if checkpoint:
        from ..session import materialize
        extra = [v for k, v in spec.params.items() if k in ("validationIndicatorCol", "weightCol")]
        keep = list(dict.fromkeys([*numeric, *categorical, label, *extra]))
        part = df.filter(F.expr(fit_where)) if fit_where else df
        df, fit_where = materialize(part.select(*keep)), ""
    stages, names, cur = feature_stages(df, numeric, categorical, fit_where, standard, robust)
    asm = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep")
    train = asm.transform(cur)
    if fit_where:
        train = train.filter(F.expr(fit_where))
    train = train.withColumn(label, F.col(label).cast("double"))
    counts = {r[0]: r[1] for r in train.groupBy(label).count().collect()}   # one row per class
    n = sum(counts.values())
    if spec.balanced:
        w = F.lit(None).cast("double")
        for cls, k in counts.items():
            w = F.when(F.col(label) == cls, F.lit(n / (len(counts) * k))).otherwise(w)
        train = train.withColumn("_w", w)
    train = _weighted(train, spec, label)
    clf = _classifier(spec, len(names), n, label, seed)
    model = clf.fit(train)
    return PipelineModel(stages=[*stages, asm, model])


def fit_early_stopped(spec: ModelSpec, df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                      label: str, train_where: str, valid_where: str, patience: int = 50,
                      seed: int = 42, first: int | None = None) -> tuple[PipelineModel, int]:
    """Boosting stopped by patience on average precision.

    Up to ``maxIter`` rounds are fitted on the training rows; the rounds kept are
    those up to the best average precision on the validation rows, once it has not
    improved for ``patience`` rounds (see ``boosting``). Imputer and encoder are
    fitted on the training rows alone. Returns ``(model, best_rounds)``.
    """
    if spec.kind != "gbt":
        raise ValueError("early stopping applies to boosting specs")
    from ..session import materialize
    from .boosting import fit_by_average_precision
    keep = list(dict.fromkeys([*numeric, *categorical, label]))
    train = materialize(df.filter(F.expr(train_where)).select(*keep))
    stages, names, cur = feature_stages(train, numeric, categorical)
    asm = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep")
    cols = ["features", F.col(label).cast("double").alias(label)]
    ready = materialize(_weighted(asm.transform(cur).select(*cols), spec, label), "train_vectors")
    valid = df.filter(F.expr(valid_where)).select(*keep)
    for st in stages:
        valid = st.transform(valid)
    valid = materialize(asm.transform(valid).select(*cols), "validation_vectors")
    clf = _classifier(spec, len(names), 0, label, seed)
    model, rounds, _ = fit_by_average_precision(clf, ready, valid, label, patience, first)
    return PipelineModel(stages=[*stages, asm, model]), rounds


def _weighted(df: DataFrame, spec: ModelSpec, label: str) -> DataFrame:
    """With ``scale_pos_weight`` in the spec, rows of class 1 get that weight."""
    w = spec.params.get("scale_pos_weight")
    return df if w is None else df.withColumn("_w", F.when(F.col(label) == 1, float(w)).otherwise(1.0))


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str] = (), name: str = "y_score") -> DataFrame:
    """Probability of class 1 for every row (stateless: works on streams too)."""
    out = model.transform(df)
    return out.select(*keep, vector_to_array(F.col("probability"))[1].alias(name))


def importances(model: PipelineModel, k: int | None = None) -> DataFrame:
    """Feature importances (trees) or |coefficients| (linear) as a DataFrame,
    ``(feature, importance)``, top ``k`` by importance then name (E7, E12)."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    asm = next(s for s in model.stages if isinstance(s, VectorAssembler))
    names = asm.getInputCols()
    clf = model.stages[-1]
    if hasattr(clf, "featureImportances"):
        vals = clf.featureImportances.toArray().tolist()
    elif hasattr(clf, "coefficients"):
        vals = [abs(v) for v in clf.coefficients.toArray().tolist()]
    else:
        raise ValueError("model has no importances")
    df = spark.createDataFrame([(n, float(v)) for n, v in zip(names, vals)], "feature string, importance double")
    if k:
        df = df.orderBy(F.desc("importance"), F.asc("feature")).limit(int(k))
    return df


def score_members(model: PipelineModel, df: DataFrame, id_col: str, threshold: float) -> DataFrame:
    """Batch scoring of raw members with a stored threshold."""
    from ..functions.columns import risk_grade
    s = score(model, df, keep=[id_col], name="churn_probability")
    return (s.withColumn("threshold", F.lit(float(threshold)))
            .withColumn("churn_decision", (F.col("churn_probability") >= F.lit(float(threshold))).cast("int"))
            .withColumn("risk_grade", risk_grade("churn_probability")))


def spec_key(spec: ModelSpec, features: Sequence[str], categorical: Sequence[str]) -> str:
    """Stable hash of a fit's inputs, used to reuse a saved model."""
    import hashlib
    import json
    blob = json.dumps([spec.name, spec.kind, spec.params, spec.balanced, list(features), list(categorical)],
                      sort_keys=True, default=str)
    return hashlib.sha1(blob.encode()).hexdigest()[:12]


def sweep(specs: Sequence[ModelSpec], df: DataFrame, datasets: dict, id_col: str, label: str,
          split_col: str = "split", exclude: Sequence[str | None] = (None,),
          categorical: Sequence[str] = (), model_dir: str | None = None, parallel: int = 1,
          standard: Sequence[str] = (), robust: Sequence[str] = ()) -> DataFrame:
    """Datasets x models x leave-one-feature-out variants.

    The column transformer is fitted once, on the training rows and all features,
    and one vector table is written; a variant is a slice of its vectors, so nothing
    is prepared twice and labels travel with the scores. The scored sets of all
    variants are written, each once, and returned as one table ``(model_key, id, y_true, y_score)``, so that the
    evaluation of every variant is one grouped job
    (``evaluate.metrics(..., by=['model_key'])``). A feature excluded but absent from a
    dataset skips that variant. With ``model_dir`` a fitted pipeline is saved under a
    hash of its inputs and reused on the next run; ``parallel`` > 1 submits fits
    from a thread pool (Spark runs the jobs of different fits concurrently).
    """
    from concurrent.futures import ThreadPoolExecutor
    from functools import reduce

    from pyspark.ml.feature import VectorSlicer

    from ..session import materialize
    from ..sources.files import load_model, path_exists, save_model
    from .knn import KNNClassifier
    numeric = list(dict.fromkeys(f for feats in datasets.values() for f in feats))
    df = materialize(df.select(*dict.fromkeys([id_col, label, split_col, *numeric, *categorical])), "sweep_rows")
    stages, names, cur = feature_stages(df, numeric, categorical, f"{split_col} = 'train'", standard, robust)
    asm = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep")
    vectors = materialize(asm.transform(cur).select(
        id_col, split_col, F.col(label).cast("double").alias(label), "features"), "sweep_vectors")
    owner = _owners(names, numeric, categorical)
    counts = {r[0]: r[1] for r in vectors.filter(F.col(split_col) == "train").groupBy(label).count().collect()}
    jobs = []
    for ds_name, feats in datasets.items():
        for spec in specs:
            for ex in exclude:
                if ex is not None and ex not in feats:
                    continue
                key = f"{spec.name}_{ds_name}" + (f"_without_{ex}" if ex else "")
                jobs.append((key, spec, [f for f in feats if f != ex], [c for c in categorical if c != ex]))

    def run(job):
        # written once: an evaluation reads the scores several times
        return materialize(scored(*job), "sweep_scores")

    def scored(key, spec, use, cats):
        keyed = F.lit(key).alias("model_key")
        if spec.kind == "knn":
            knn = KNNClassifier(use, label, id_col, **spec.params)
            test = df.filter(F.col(split_col) == "test")
            sc = knn.fit(df.filter(F.col(split_col) == "train")).transform(test).select(id_col, F.col("knn_score").alias("y_score"))
            return sc.join(test.select(id_col, F.col(label).cast("int").alias("y_true")), id_col).select(
                keyed, id_col, "y_true", "y_score")
        path = f"{model_dir}/{key}-{spec_key(spec, use, cats)}" if model_dir else None
        if path and path_exists(df.sparkSession, path):
            m = load_model(path)
            return score(m, df.filter(F.col(split_col) == "test"), keep=[id_col, F.col(label).cast("int").alias("y_true")]).select(
                keyed, id_col, "y_true", "y_score")
        own = {*use, *cats}
        at = [i for i, n in enumerate(names) if owner[n] in own]
        cut = VectorSlicer(inputCol="features", outputCol="sliced", indices=at)
        view = cut.transform(vectors)
        train = view.filter(F.col(split_col) == "train")
        if spec.balanced:
            w = F.lit(None).cast("double")
            for cls, k in counts.items():
                w = F.when(F.col(label) == cls, F.lit(sum(counts.values()) / (len(counts) * k))).otherwise(w)
            train = train.withColumn("_w", w)
        clf = _classifier(spec, len(at), sum(counts.values()), label, 42).setFeaturesCol("sliced")
        model = clf.fit(_weighted(train, spec, label))
        if path:
            save_model(PipelineModel(stages=[*stages, asm, cut, model]), path)
        sc = model.transform(view.filter(F.col(split_col) == "test"))
        return sc.select(keyed, id_col, F.col(label).cast("int").alias("y_true"),
                         vector_to_array(F.col("probability"))[1].alias("y_score"))

    if parallel > 1:
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            out = list(pool.map(run, jobs))
    else:
        out = [run(j) for j in jobs]
    return reduce(DataFrame.unionByName, out)


def _owners(names: Sequence[str], numeric: Sequence[str], categorical: Sequence[str]) -> dict[str, str]:
    """Input column of every assembled feature: itself, its indicator, or a level of it."""
    out = {}
    for n in names:
        if n in numeric:
            out[n] = n
        elif n.endswith("_missing") and n[:-8] in numeric:
            out[n] = n[:-8]
        else:
            out[n] = max((c for c in categorical if n.startswith(c + "_")), key=len)
    return out
