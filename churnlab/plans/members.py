"""Member table built from order history (guide: observation window -> label).

``observe`` turns the order / line / event tables into one row per member:
behaviour aggregated over the observation window (orders before ``cutoff``)
and a churn label from the outcome window (no order on or after ``cutoff``).

Plan shape at scale:
* orders are scanned once for all order-level aggregates and the label
  (conditional aggregates), with the cutoff pushed into the parquet scan for
  the line-level branch;
* lines are pre-aggregated per (member, part) before the per-member
  aggregate, which also yields the distinct part count without an Expand; the
  line-level shuffles have a number of tasks that follows the size of the line table;
* the preferred event type is a ``min(struct(-count, type))`` aggregate, so
  no window over a member's events;
* all member-level sides are hash-partitioned on the member key, so the
  final left joins reuse that partitioning; nation / region are dimension
  tables and their join strategy is left to the planner's size check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shuffle_partitions
from ..sources.tables import tables

OBS_CUTOFF = "2001-02-01"
PREF_EVENTS = ("click", "view", "purchase")


def observe(customer: DataFrame, nation: DataFrame, region: DataFrame,
            orders: DataFrame, lineitem: DataFrame, events: DataFrame,
            cutoff: str = OBS_CUTOFF, pref_events=PREF_EVENTS, partitions: int | None = None) -> DataFrame:
    """``partitions`` deals the line-level steps over that many tasks instead of the
    session's number of shuffle partitions (see ``line_partitions``)."""
    cut = F.lit(cutoff).cast("timestamp")
    in_obs = F.col("o_orderdate") < cut

    order_agg = (orders
                 .select("o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority")
                 .groupBy("o_custkey")
                 .agg(F.min(F.when(in_obs, F.col("o_orderdate"))).cast("date").alias("start_date"),
                      F.count(F.when(in_obs, F.lit(1))).alias("visits"),
                      F.avg(F.when(in_obs, F.col("o_totalprice"))).alias("avg_value"),
                      F.count(F.when(in_obs & (F.col("o_orderpriority") == "1-URGENT"), F.lit(1))).alias("urgent"),
                      F.max(F.when(~in_obs, F.lit(1))).alias("_later"))
                 .withColumnRenamed("o_custkey", "_ok"))

    obs_orders = orders.filter(in_obs).select("o_orderkey", "o_custkey", "o_orderdate")
    lines = lineitem.select("l_orderkey", "l_partkey", "l_returnflag", "l_shipdate")
    if partitions:
        lines = lines.repartition(partitions, "l_orderkey")
        obs_orders = obs_orders.repartition(partitions, "o_orderkey")
    bought = (lines.join(obs_orders, lines.l_orderkey == obs_orders.o_orderkey)
              .select("o_custkey", "l_partkey", F.when(F.col("l_returnflag") == "R", F.lit(1)).alias("_back"),
                      F.datediff(F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date")).alias("_wait")))
    if partitions:
        bought = bought.repartition(partitions, "o_custkey", "l_partkey")
    per_part = (bought.groupBy("o_custkey", "l_partkey")
                .agg(F.count("_back").alias("_r"), F.sum(F.col("_wait").cast("long")).alias("_d"),
                     F.count(F.lit(1)).alias("_n")))
    line_agg = (per_part.groupBy("o_custkey")
                .agg(F.sum("_r").alias("returns"),
                     F.count(F.lit(1)).alias("parts"),
                     (F.sum("_d") / F.sum("_n")).alias("wait_days"))
                .withColumnRenamed("o_custkey", "_lk"))

    ev = (events.filter(F.col("event_type").isin(*pref_events))
          .groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("_k"))
          .groupBy("user_id")
          .agg(F.min(F.struct((-F.col("_k")).alias("_nk"), F.col("event_type"))).alias("_m"))
          .select("user_id", F.col("_m.event_type").alias("pref")))

    geo = (nation.select("n_nationkey", "n_regionkey")
           .join(region.select("r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey"))
           .select("n_nationkey", "r_name"))
    cust = (customer.select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
            .join(geo, F.col("c_nationkey") == F.col("n_nationkey")))

    m = (cust
         .join(order_agg, F.col("c_custkey") == F.col("_ok"), "left")
         .join(line_agg, F.col("c_custkey") == F.col("_lk"), "left")
         .join(ev, F.col("c_custkey") == F.col("user_id"), "left"))
    return m.select(
        F.col("c_custkey").alias("member_id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("r_name").alias("region"),
        F.col("c_acctbal").alias("fee"),
        F.col("start_date"),
        F.coalesce(F.col("visits"), F.lit(0).cast("long")).alias("visits"),
        F.col("avg_value"),
        F.coalesce(F.col("urgent"), F.lit(0).cast("long")).alias("urgent"),
        F.col("returns"),
        F.col("parts"),
        F.col("wait_days"),
        F.col("pref"),
        F.when(F.col("_later") == 1, F.lit(0)).otherwise(F.lit(1)).alias("churn"))


#: tasks of a line-level step for each part in which the line table is scanned (128 MB at most)
TASKS_PER_SCAN_PART = 8


def line_partitions(lineitem: DataFrame) -> int | None:
    """Tasks for the line-level steps, in proportion to the size of the scanned line table,
    so that what one task sorts and counts is bounded at any size; None where the
    session's shuffle partitions are enough."""
    n = TASKS_PER_SCAN_PART * lineitem.rdd.getNumPartitions()
    return n if n > shuffle_partitions(lineitem.sparkSession) else None


def members(spark: SparkSession, data_dir: str, cutoff: str = OBS_CUTOFF) -> DataFrame:
    t = tables(spark, data_dir, ("customer", "nation", "region", "orders", "lineitem", "events"))
    return observe(t["customer"], t["nation"], t["region"], t["orders"], t["lineitem"],
                   t["events"], cutoff, partitions=line_partitions(t["lineitem"]))


# --- deterministic score and planted label ---------------------------------

def _logit(m: DataFrame, extra=None, drop_returns: bool = False):
    z = (-0.20 * (F.col("visits") - 9)
         + 0.3 * F.when(F.col("pref").isNull(), 1).otherwise(0))
    if not drop_returns:
        z = z + 0.25 * (F.coalesce(F.col("returns"), F.lit(0)) - 12)
    if extra is not None:
        z = z + extra
    return z


def _sigmoid(z):
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def hash_unit(col, salt: str):
    """Uniform [0,1) value from the first 8 hex digits of md5(id|salt)."""
    return (F.conv(F.substring(F.md5(F.concat(F.col(col).cast("string"), F.lit(f"|{salt}"))), 1, 8), 16, 10)
            .cast("double") / 4294967296.0)


def with_planted(m: DataFrame) -> DataFrame:
    """Add ``score`` (rounded logistic of a fixed linear rule) and ``planted``."""
    z = _logit(m)
    return (m.withColumn("score", F.round(_sigmoid(z), 6))
            .withColumn("planted",
                        F.when(hash_unit("member_id", "label") < _sigmoid(z), 1).otherwise(0)))


MODEL_KEYS = ("rule_full", "rule_50", "rule_full_without_returns")


def scores(m: DataFrame) -> DataFrame:
    """Scored set ``(member_id, model_key, y_true, y_score)`` for three rule models.

    ``rule_full``: rounded score with many ties; ``rule_50``: near-unique score
    (fee term); ``rule_full_without_returns``: the rule without its returns
    term (a leave-one-feature-out variant).
    """
    p = with_planted(m)
    base = p.select("member_id", F.col("planted").alias("y_true"), "visits", "returns", "pref", "fee")
    a = base.select("member_id", F.lit(MODEL_KEYS[0]).alias("model_key"), "y_true",
                    F.round(_sigmoid(_logit(base)), 6).alias("y_score"))
    b = base.select("member_id", F.lit(MODEL_KEYS[1]).alias("model_key"), "y_true",
                    F.round(_sigmoid(_logit(base, 0.00002 * F.col("fee"))), 6).alias("y_score"))
    c = base.select("member_id", F.lit(MODEL_KEYS[2]).alias("model_key"), "y_true",
                    F.round(_sigmoid(_logit(base, drop_returns=True)), 6).alias("y_score"))
    return a.unionByName(b).unionByName(c)
