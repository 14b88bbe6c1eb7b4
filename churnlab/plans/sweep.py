"""Evaluation sweep (the reference's L2 flow) as Spark jobs.

datasets x models x leave-one-feature-out variants -> fit on the training
split -> score the test split -> scored sets written once, partitioned by
model key (the per-model Parquet files of the reference) -> every variant
evaluated in one grouped job -> result records upserted by (model_key, label).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import parse_key
from ..operators import evaluate as E
from ..operators import models as M
from ..operators import splits as D
from ..sources.files import upsert
from . import members as MB


def evaluation_sweep(spark: SparkSession, data_dir: str, specs: Sequence[M.ModelSpec], datasets: dict,
                     out_dir: str, exclude: Sequence[str | None] = (None,), categorical: Sequence[str] = (),
                     label: str = "planted", threshold: float = 0.5, run_label: str = "sweep") -> DataFrame:
    df = D.stratified_split(MB.with_planted(MB.members(spark, data_dir)), "member_id", label, 0.2, 42)
    scored = M.sweep(specs, df, datasets, "member_id", label, exclude=exclude, categorical=categorical)
    scores_path = f"{out_dir}/scores"
    scored.write.mode("overwrite").partitionBy("model_key").parquet(scores_path)
    scored = spark.read.parquet(scores_path)
    metrics = E.metrics(scored, "y_true", "y_score", threshold, by=["model_key"])
    records = (metrics.withColumn("label", F.lit(run_label))
               .withColumn("k", parse_key("model_key"))
               .select("model_key", "label", F.col("k.model").alias("model"), F.col("k.dataset").alias("dataset"),
                       F.col("k.excluded").alias("excluded_feature"), "threshold", "accuracy", "precision",
                       "recall", "f1", "roc_auc", "pr_auc", "tn", "fp", "fn", "tp", "total",
                       F.concat(F.lit(scores_path + "/model_key="), "model_key").alias("scores_path")))
    return upsert(spark, f"{out_dir}/results", records)
