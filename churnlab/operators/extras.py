"""Operators the reference's guide describes but does not code (H*)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_audit(stages: dict[str, DataFrame], key: str, value: str) -> DataFrame:
    """Rows, distinct members, duplicate keys and null rate of ``value`` per stage.

    ``stages`` maps a stage name to a frame (before / after a join). One
    aggregate per stage, stacked with ``unionByName``.
    """
    parts = []
    for name, df in stages.items():
        n = F.count(F.lit(1))
        parts.append(df.agg(n.alias("rows"), F.count_distinct(key).alias("members"),
                            (n - F.count_distinct(key)).alias("duplicates"),
                            ((n - F.count(value)) / n).alias("null_rate"))
                     .select(F.lit(name).alias("stage"), "*"))
    return reduce(DataFrame.unionByName, parts)


def psi_table(base: DataFrame, current: DataFrame, col: str, bins: int = 10,
              eps: float = 1e-6) -> DataFrame:
    """Population stability per base-decile bucket of ``col``.

    Cut points are exact quantiles of the base table (one bounded array,
    evaluated as a scalar subquery); a value falls in bucket = number of cut
    points strictly below it. ``(bucket, base_share, current_share, psi)``
    with shares floored at ``eps``.
    """
    from .ordered import exact_quantiles
    probs = [i / bins for i in range(1, bins)]
    q = exact_quantiles(base, [col], probs)
    cuts = q.agg(F.transform(F.array_sort(F.collect_list(F.struct("prob", "value"))),
                             lambda e: e["value"])).scalar()

    def dist(df, name):
        t = df.select(F.col(col).cast("double").alias("_v")).filter(F.col("_v").isNotNull()).withColumn("_c", cuts)
        b = t.select(F.size(F.filter("_c", lambda c: c < F.col("_v"))).alias("bucket"))
        per = b.groupBy("bucket").agg(F.count(F.lit(1)).alias("_k"))
        total = b.agg(F.count(F.lit(1))).scalar()
        return per.select("bucket", (F.col("_k") / total).alias(name))

    j = dist(base, "base_share").join(dist(current, "current_share"), "bucket", "full_outer").fillna(0.0)
    p = F.greatest(F.col("base_share"), F.lit(eps))
    c = F.greatest(F.col("current_share"), F.lit(eps))
    return j.select("bucket", "base_share", "current_share", ((c - p) * F.log(c / p)).alias("psi"))


def psi(base: DataFrame, current: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Total population stability index of ``col``: ``(feature, psi)``."""
    return psi_table(base, current, col, bins).agg(F.sum("psi").alias("psi")).select(
        F.lit(col).alias("feature"), "psi")
