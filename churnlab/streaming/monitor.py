"""Windowed monitoring with watermarks (H10 on a stream).

``event_activity``: per tumbling window and event type, events, distinct
users (approximate, bounded state) and mean value -- the behaviour inputs of
the member table as they drift over time. ``score_drift``: per window, the
number of scored members, their mean score and the share over a threshold.
Both run in append mode: a window is emitted once the watermark passes its
end, and its state is dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def event_activity(events: DataFrame, ts: str = "ts", window: str = "1 day", watermark: str = "1 hour",
                   by: Sequence[str] = ("event_type",), user: str | None = "user_id",
                   value: str = "value") -> DataFrame:
    # event time must be TIMESTAMP (parquet files may carry TIMESTAMP_NTZ)
    aggs = [F.count(F.lit(1)).alias("events")]
    if user:
        aggs.append(F.approx_count_distinct(user).alias("users"))
    aggs += [F.sum(value).alias("sum_value"), F.avg(value).alias("mean_value")]
    return (events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
            .groupBy(F.window(ts, window).alias("window"), *by)
            .agg(*aggs)
            .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                    *by, *[a for a in ("events", "users", "sum_value", "mean_value") if a != "users" or user]))


def run_to_table(stream_df: DataFrame, checkpoint: str, name: str) -> DataFrame:
    """Drain a streaming aggregate (append mode, ``availableNow``) into an
    in-memory table and return it as a batch DataFrame. The checkpoint goes to
    the given (shared) folder."""
    q = (stream_df.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return stream_df.sparkSession.table(name)


def drain_partials(events: DataFrame, path: str, checkpoint: str, ts: str = "ts", window: str = "1 day",
                   by: Sequence[str] = ("event_type",), value: str = "value") -> DataFrame:
    """Windowed counts and sums over everything a stream holds, in any order.

    Each micro-batch writes its partial aggregate to its own folder of the
    (shared) ``path``, overwritten when the batch is repeated; the result adds
    the partials up. No event is late, and windows still open at the end of the
    input are part of the result. State does not grow with the stream: a batch
    leaves a row for each of its windows and groups.
    """
    rows = events.withColumn(ts, F.col(ts).cast("timestamp")).select(
        F.window(ts, window).alias("window"), *by, F.col(value).alias("_v"))
    aggregated = rows.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *by, "_v")

    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.groupBy("window_start", "window_end", *by).agg(F.count(F.lit(1)).alias("events"), F.sum("_v").alias("sum_value"))
         .write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}"))

    q = (aggregated.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    parts = events.sparkSession.read.parquet(path)
    return parts.groupBy("window_start", "window_end", *by).agg(
        F.sum("events").alias("events"), F.sum("sum_value").alias("sum_value"))


def drain_sketches(rows: DataFrame, lay, path: str, checkpoint: str, by: Sequence[str] = ()) -> DataFrame:
    """Drift sketches (``operators.drift``) of everything a stream holds, by the columns
    ``by``: each micro-batch writes its sketch to a folder of its own below the shared
    ``path``, overwritten when the batch is repeated, and the result adds them up. A run
    that goes on from the checkpoint adds the batches that are new."""
    from ..operators.drift import merge, sketch

    def write(batch: DataFrame, batch_id: int) -> None:
        sketch(batch, lay, by).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    q = (rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return merge(rows.sparkSession.read.parquet(path), by)


def score_drift(scored: DataFrame, ts: str, score: str = "churn_probability", threshold: float = 0.5,
                window: str = "1 day", watermark: str = "1 hour") -> DataFrame:
    return (scored.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
            .groupBy(F.window(ts, window).alias("window"))
            .agg(F.count(F.lit(1)).alias("members"), F.avg(score).alias("mean_score"),
                 F.avg((F.col(score) >= threshold).cast("double")).alias("share_over_threshold"))
            .select(F.col("window.start").alias("window_start"), "members", "mean_score",
                    "share_over_threshold"))
