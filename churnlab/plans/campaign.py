"""Campaign page (the reference's L3 flow) as one plan: scored set ->
threshold metrics -> capacity-bounded candidate list with the model's
campaign figures attached."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import campaign as G
from ..operators import evaluate as E
from ..operators import features as C
from ..session import reuse
from . import members as MB


def campaign_report(spark: SparkSession, data_dir: str, threshold: float = 0.5,
                    capacity: int = 500) -> DataFrame:
    m = MB.members(spark, data_dir)
    m = C.fill_constants(m, {"segment": "UNKNOWN"})
    m = C.date_features(m, "start_date", prefix="start", drop=False)
    s = reuse(MB.scores(m))     # read by the metrics, the border passes and the list
    metrics = E.metrics(s, "y_true", "y_score", threshold, by=["model_key"])
    cands = G.candidates(s, "member_id", "y_score", threshold, capacity, y="y_true", by=["model_key"])
    figures = metrics.select("model_key", "selected", "precision", "recall", "f1", "roc_auc", "pr_auc")
    return cands.join(figures, "model_key").withColumn("threshold", F.lit(float(threshold)))
