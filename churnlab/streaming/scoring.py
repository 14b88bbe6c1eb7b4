"""Scoring members as they arrive (E14 on ``readStream``).

A fitted ``PipelineModel`` of imputer / encoder / assembler / classifier is
row-wise, so ``transform`` works on a streaming DataFrame unchanged; the
scores are appended to a Parquet sink with a checkpoint (exactly-once file
sink).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.models import score_members


def score_stream(model, stream: DataFrame, id_col: str, threshold: float) -> DataFrame:
    """Streaming DataFrame of (id, churn_probability, threshold, churn_decision, risk_grade)."""
    return score_members(model, stream, id_col, threshold)


def start_scoring(spark: SparkSession, model, source_dir: str, schema: T.StructType, sink_dir: str,
                  checkpoint: str, id_col: str, threshold: float, available_now: bool = True,
                  max_files_per_trigger: int = 100):
    """Parquet folder in -> scored Parquet folder out. Returns the StreamingQuery."""
    src = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
           .parquet(source_dir))
    w = (score_stream(model, src, id_col, threshold).writeStream.format("parquet")
         .option("path", sink_dir).option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
