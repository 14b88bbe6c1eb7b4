"""Ranking and campaign targeting (G*).

Candidate lists are capacity-bounded top-k lists. ``orderBy().limit(cap)``
would merge ``cap`` rows from every partition in one task; ``rank_cut``
finds the border score from the score histogram instead, so a capacity of
millions costs the same as one of a hundred.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import risk_grade
from .ordered import rank_cut, top_n
from .selection import rank_borders, within

# Business-score weight presets of the model comparison page.
WEIGHT_PRESETS = {
    "detect_churn_first": {"recall": 0.40, "f1": 0.25, "pr_auc": 0.20, "precision": 0.10, "roc_auc": 0.05},
    "balanced": {"recall": 0.25, "f1": 0.25, "pr_auc": 0.20, "precision": 0.15, "roc_auc": 0.15},
    "campaign_cost_first": {"precision": 0.40, "f1": 0.25, "pr_auc": 0.20, "recall": 0.10, "roc_auc": 0.05},
}

# Retention rules (column, comparison, bound, action) in the
# reference's order, and the action when no rule fires.
DEFAULT_RULES = (
    ("Late_Payment_Count", ">=", 4, "payment_support"),
    ("Monthly_Visits", "<=", 6, "visit_activation"),
    ("PT_Session_Count", "==", 0, "pt_trial"),
    ("Group_Class_Attendance", "<=", 2, "group_class"),
    ("Avg_Equipment_Wait_Time_Min", ">=", 18, "crowding_relief"),
    ("Avg_Workout_Duration_Min", "<=", 40, "workout_routine"),
)
DEFAULT_ACTION = "relationship_care"

# Operational meaning of the confusion cells.
IMPACT = (("tp", "churners found", "campaign priority"),
          ("fp", "retained members selected", "unneeded campaign cost"),
          ("fn", "churners missed", "lost retention chance"),
          ("tn", "retained members excluded", "no campaign"))

RISK_COLORS = ("green", "orange", "red")


def weights_table(spark: SparkSession, presets: dict = WEIGHT_PRESETS) -> DataFrame:
    rows = [(p, m, float(w)) for p, ws in presets.items() for m, w in ws.items()]
    return spark.createDataFrame(rows, "preset string, metric string, weight double")


def business_score(results: DataFrame, weights: DataFrame, key: str = "model_key") -> DataFrame:
    """Weighted sum of metric columns per (preset, model): ``(preset, key, score)``."""
    metrics = [r["metric"] for r in weights.select("metric").distinct().collect()]   # weight names: tiny
    items = ", ".join(f"'{m}', cast(`{m}` as double)" for m in metrics)
    long = results.select(key, F.expr(f"stack({len(metrics)}, {items}) as (metric, value)"))
    return (long.join(weights, "metric")
            .groupBy("preset", key).agg(F.sum(F.col("value") * F.col("weight")).alias("business_score")))


def rank_models(scored: DataFrame, key: str = "model_key", score: str = "business_score",
                by: Sequence[str] = ("preset",)) -> DataFrame:
    """Rank models per preset (score desc, key asc); ``winner`` flags rank 1.

    One row per model per preset: the window holds the model list only.
    """
    w = Window.partitionBy(*by).orderBy(F.desc(score), F.asc(key))
    return (scored.withColumn("rank", F.row_number().over(w))
            .withColumn("winner", F.col("rank") == 1))


def candidates(df: DataFrame, id_col: str, s: str, t: float, capacity: int,
               y: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Members with ``score >= t``, the ``capacity`` riskiest (ties by id).

    Output: id, ``churn_probability``, ``risk_grade`` and, when ``y`` is given,
    ``actual_churn_for_evaluation``.
    """
    above = df.filter(F.col(s) >= F.lit(float(t)))
    top = top_n(above, s, id_col, capacity, by=by)
    cols = [*by, id_col, F.col(s).alias("churn_probability")]
    if y:
        cols.append(F.col(y).alias("actual_churn_for_evaluation"))
    return top.select(*cols, risk_grade(s).alias("risk_grade"))


def campaign_status(df: DataFrame, id_col: str, s: str, t: float, capacity: int,
                    by: Sequence[str] = ()) -> DataFrame:
    """Every member over the threshold flagged ``selected`` or ``waitlist``.

    The selected set is the exact top-``capacity`` list (``ordered.rank_cut``).
    """
    above = df.filter(F.col(s) >= F.lit(float(t)))
    return (rank_cut(above, s, id_col, capacity, by=by)
            .withColumn("status", F.when(F.col("_in_top"), "selected").otherwise("waitlist")).drop("_in_top"))


def waitlist(df: DataFrame, id_col: str, s: str, t: float, capacity: int,
             by: Sequence[str] = ()) -> DataFrame:
    """Counts: over the threshold, selected within capacity, wait-listed."""
    n = F.count(F.when(F.col(s) >= F.lit(float(t)), 1))
    return (df.groupBy(*by).agg(n.alias("threshold_count"))
            .withColumn("capacity", F.lit(int(capacity)).cast("long"))
            .withColumn("selected", F.least(F.col("threshold_count"), F.col("capacity")))
            .withColumn("waitlist", F.greatest(F.col("threshold_count") - F.col("capacity"), F.lit(0)))
            .withColumn("over_capacity", F.col("threshold_count") > F.col("capacity")))


def impact_table(metrics: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Confusion cells as rows with their operational meaning."""
    items = ", ".join(f"'{k}', '{label}', '{meaning}', cast({k} as long)" for k, label, meaning in IMPACT)
    return metrics.select(*by, F.expr(f"stack({len(IMPACT)}, {items}) as (outcome, label, meaning, members)"))


def risk_level(df: DataFrame, s: str) -> DataFrame:
    """Risk level and display colour for a probability column."""
    colour = risk_grade(s, labels=RISK_COLORS)
    return df.withColumn("risk_level", risk_grade(s)).withColumn("risk_colour", colour)


def churn_decision(df: DataFrame, s: str, threshold: float | str) -> DataFrame:
    """``p >= threshold`` plus the risk grade (G8). ``threshold`` may be a column."""
    t = F.col(threshold) if isinstance(threshold, str) else F.lit(float(threshold))
    return (df.withColumn("churn_decision", (F.col(s) >= t).cast("int"))
            .withColumn("risk_grade", risk_grade(s)))


def _rule_expr(col: str, op: str, bound):
    c = F.col(col)
    return {">=": c >= bound, "<=": c <= bound, "==": c == bound, ">": c > bound, "<": c < bound}[op]


def retention_actions(df: DataFrame, id_col: str, rules=DEFAULT_RULES,
                      default: str = DEFAULT_ACTION, columns: dict | None = None) -> DataFrame:
    """One row per (member, action) in rule order; ``default`` when none fires.

    ``columns`` maps the rule column names onto the table's own columns.
    """
    columns = columns or {}
    fired = F.array_compact(F.array(*[
        F.when(_rule_expr(columns.get(c, c), op, b), F.lit(action)) for c, op, b, action in rules]))
    acts = F.when(F.size(fired) > 0, fired).otherwise(F.array(F.lit(default)))
    return df.select(id_col, F.posexplode(acts).alias("position", "action"))


def scale_counts(metrics: DataFrame, per: int = 1000, by: Sequence[str] = ()) -> DataFrame:
    """Selected share and confusion counts per ``per`` members."""
    tot = F.col("total")
    return metrics.select(*by, (F.col("selected") / tot).alias("selected_share"),
                          *[(F.col(c) / tot * per).alias(f"{c}_per_{per}") for c in ("selected", "tp", "fp", "fn", "tn")])


def lift_table(df: DataFrame, id_col: str, y: str, s: str, n: int = 10,
               by: Sequence[str] = ()) -> DataFrame:
    """Risk deciles (``ntile`` over score desc, id asc): size, churners, rate,
    cumulative capture and lift per decile (H1).

    The decile borders (score, id) of each group are found by counting digits
    (``selection.rank_borders``); a row's decile is the number of borders before
    it. Rows without a score are left out; ids are numbers.
    """
    by = list(by)
    scored = df.filter(F.col(s).isNotNull()).select(*by, id_col, F.col(y).cast("long").alias("c"), F.col(s).cast("double").alias("_score"))
    # ntile: the first m % n deciles have one row more
    m = F.col("m")
    ends = [F.floor(m / n) * j + F.least(m % n, F.lit(j)) for j in range(1, n)]
    keyed = rank_borders(scored, "_score", id_col, by, F.array_distinct(F.array(*[e.cast("long") - 1 for e in ends])))
    after = F.aggregate("_borders", F.lit(0).cast("long"),
                        lambda at, b: F.when(within(b), at).otherwise(b["r"] + 1))
    after = F.coalesce(after, F.lit(0).cast("long"))
    # a row that comes after r + 1 rows at least is in the decile of rank r + 2
    sizes = keyed.withColumn("_after", after).groupBy(*by, "_after").agg(
        F.count(F.lit(1)).alias("members"), F.sum("c").alias("churners"), F.min("_score").alias("min_score"))
    whole = Window.partitionBy(*by)
    order = whole.orderBy("_after")
    per = sizes.select(*by, F.row_number().over(order).cast("int").alias("decile"), "members", "churners", "min_score",
                       F.sum("members").over(whole).alias("_n"), F.sum("churners").over(whole).cast("double").alias("_pos"))
    cum = Window.partitionBy(*by).orderBy("decile").rowsBetween(Window.unboundedPreceding, 0)
    rate = F.col("churners") / F.col("members")
    return per.select(*by, "decile", "members", "churners", "min_score", rate.alias("churn_rate"),
                      F.try_divide(F.sum("churners").over(cum), F.col("_pos")).alias("cum_capture"),
                      F.try_divide(rate, F.col("_pos") / F.col("_n")).alias("lift"))


def exclude(df: DataFrame, id_col: str, *blocklists: DataFrame) -> DataFrame:
    """Drop members present in any block list (left anti joins)."""
    return reduce(lambda acc, b: acc.join(b.select(id_col).distinct(), id_col, "left_anti"), blocklists, df)


def assign_arm(df: DataFrame, id_col: str, control_share: float = 0.1, seed=42,
               name: str = "arm") -> DataFrame:
    """Random (hash-based, reproducible) control hold-out."""
    from ..functions.columns import hash_unit
    return df.withColumn(name, F.when(hash_unit(F.col(id_col), f"{seed}|arm") < control_share, "control")
                         .otherwise("treatment"))


def compare_arms(df: DataFrame, arm: str, outcome: str, by: Sequence[str] = ()) -> DataFrame:
    """Members and outcome rate per arm (and group)."""
    return df.groupBy(*by, arm).agg(F.count(F.lit(1)).alias("members"),
                               F.avg(F.col(outcome).cast("double")).alias("rate"))
