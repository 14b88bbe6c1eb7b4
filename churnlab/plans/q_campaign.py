"""Registered queries: ranking and campaign targeting (G*), H1, H7, H8, H10."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import campaign as G
from ..operators import drift as DR
from ..operators import evaluate as E
from ..operators import extras as X
from ..operators import splits as D
from ..session import materialize
from .common import CAT, ID, NUM, Y, members, scores
from .q_evaluate import _BUNDLE
from .registry import register

K = ["model_key"]
T, CAP = 0.4, 150

_WEIGHTS_SQL = "w(preset, metric, weight) AS (VALUES " + ", ".join(
    f"('{p}', '{m}', {w}::DOUBLE)" for p, ws in G.WEIGHT_PRESETS.items() for m, w in ws.items()) + ")"

_SCORED = f"""b AS (WITH {_BUNDLE}),
{_WEIGHTS_SQL},
lm AS (SELECT model_key, 'recall' AS metric, recall AS value FROM b UNION ALL
       SELECT model_key, 'precision', precision FROM b UNION ALL SELECT model_key, 'f1', f1 FROM b UNION ALL
       SELECT model_key, 'roc_auc', roc_auc FROM b UNION ALL SELECT model_key, 'pr_auc', pr_auc FROM b),
bs AS (SELECT preset, model_key, sum(value * weight) AS business_score FROM lm JOIN w ON lm.metric = w.metric
       GROUP BY preset, model_key)"""


def _metrics(spark, sf):
    return E.metrics(scores(spark, sf), "y_true", "y_score", 0.5, K)


@register("g1_business_score", _SCORED + "\nSELECT * FROM bs")
def g1_business_score(spark, sf):
    return G.business_score(_metrics(spark, sf), G.weights_table(spark))


@register("g2_rank_models", _SCORED + """
SELECT *, CAST(row_number() OVER (PARTITION BY preset ORDER BY business_score DESC, model_key) AS INTEGER) AS rank,
       row_number() OVER (PARTITION BY preset ORDER BY business_score DESC, model_key) = 1 AS winner FROM bs""")
def g2_rank_models(spark, sf):
    return G.rank_models(G.business_score(_metrics(spark, sf), G.weights_table(spark)))


_GRADE = "CASE WHEN y_score >= 0.7 THEN 'high_risk' WHEN y_score >= 0.4 THEN 'caution' ELSE 'retain' END"
_RANKED = f"""r AS (SELECT *, row_number() OVER (PARTITION BY model_key ORDER BY y_score DESC, member_id) AS rk
       FROM scores WHERE y_score >= {T})"""


@register("g3_candidates", _RANKED + f"""
SELECT model_key, member_id, y_score AS churn_probability, y_true AS actual_churn_for_evaluation,
       {_GRADE} AS risk_grade FROM r WHERE rk <= {CAP}""")
def g3_candidates(spark, sf):
    return G.candidates(scores(spark, sf), ID, "y_score", T, CAP, y="y_true", by=K)


@register("a10_campaign_export", _RANKED + f"""
SELECT model_key, member_id, y_score AS churn_probability, {_GRADE} AS risk_grade FROM r WHERE rk <= {CAP}""")
def a10_campaign_export(spark, sf):
    c = G.candidates(scores(spark, sf), ID, "y_score", T, CAP, y="y_true", by=K)
    return c.drop("actual_churn_for_evaluation")


@register("g4_campaign_status", _RANKED + f"""
SELECT member_id, model_key, y_true, y_score, CASE WHEN rk <= {CAP} THEN 'selected' ELSE 'waitlist' END AS status
FROM r""")
def g4_campaign_status(spark, sf):
    return G.campaign_status(scores(spark, sf), ID, "y_score", T, CAP, by=K)


@register("g4_waitlist", f"""
c AS (SELECT model_key, count(*) FILTER (WHERE y_score >= {T}) AS threshold_count FROM scores GROUP BY model_key)
SELECT model_key, threshold_count, {CAP}::BIGINT AS capacity, least(threshold_count, {CAP}) AS selected,
       greatest(threshold_count - {CAP}, 0) AS waitlist, threshold_count > {CAP} AS over_capacity FROM c""")
def g4_waitlist(spark, sf):
    return G.waitlist(scores(spark, sf), ID, "y_score", T, CAP, by=K)


@register("g5_impact_table", f"""b AS (WITH {_BUNDLE})
""" + "\nUNION ALL\n".join(
    f"SELECT model_key, '{k}' AS outcome, '{label}' AS label, '{meaning}' AS meaning, {k} AS members FROM b"
    for k, label, meaning in G.IMPACT))
def g5_impact_table(spark, sf):
    return G.impact_table(_metrics(spark, sf), by=K)


@register("g6_risk_level", f"""
SELECT member_id, model_key, y_true, y_score, {_GRADE} AS risk_level,
       CASE WHEN y_score >= 0.7 THEN 'red' WHEN y_score >= 0.4 THEN 'orange' ELSE 'green' END AS risk_colour
FROM scores""")
def g6_risk_level(spark, sf):
    return G.risk_level(scores(spark, sf), "y_score")


_RULE_COLUMNS = {"Late_Payment_Count": "returns", "Monthly_Visits": "visits", "PT_Session_Count": "urgent",
                 "Group_Class_Attendance": "parts", "Avg_Equipment_Wait_Time_Min": "wait_days",
                 "Avg_Workout_Duration_Min": "fee"}


def _rule_sql():
    parts = []
    for c, op, b, action in G.DEFAULT_RULES:
        op = "=" if op == "==" else op
        parts.append(f"CASE WHEN {_RULE_COLUMNS[c]} {op} {b} THEN '{action}' END")
    return "list_filter([" + ", ".join(parts) + "], lambda x: x IS NOT NULL)"


@register("g7_retention_actions", f"""
a AS (SELECT member_id, {_rule_sql()} AS fired FROM members),
b AS (SELECT member_id, CASE WHEN len(fired) > 0 THEN fired ELSE ['{G.DEFAULT_ACTION}'] END AS acts FROM a)
SELECT member_id, CAST(generate_subscripts(acts, 1) - 1 AS INTEGER) AS position, unnest(acts) AS action FROM b""")
def g7_retention_actions(spark, sf):
    return G.retention_actions(members(spark, sf), ID, columns=_RULE_COLUMNS)


@register("g8_churn_decision", """
h AS (SELECT model_key, y_score AS score, count(*) FILTER (WHERE y_true = 1) AS pos,
             count(*) FILTER (WHERE y_true <> 1) AS neg FROM scores GROUP BY model_key, y_score),
cum AS (SELECT *, sum(pos) OVER (PARTITION BY model_key ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
               sum(neg) OVER (PARTITION BY model_key ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp,
               sum(pos) OVER (PARTITION BY model_key) AS P FROM h),
f AS (SELECT model_key, score, 2 * p * r / (p + r + 1e-12) AS f1 FROM
      (SELECT model_key, score, tp / (tp + fp) AS p, CASE WHEN P > 0 THEN tp / P ELSE 1.0 END AS r FROM cum) t),
bt AS (SELECT model_key, score AS threshold FROM
       (SELECT *, row_number() OVER (PARTITION BY model_key ORDER BY f1 DESC, score) AS rn FROM f) t WHERE rn = 1)
SELECT s.member_id, s.model_key, s.y_score, bt.threshold, CAST(s.y_score >= bt.threshold AS INTEGER) AS churn_decision,
       CASE WHEN s.y_score >= 0.7 THEN 'high_risk' WHEN s.y_score >= 0.4 THEN 'caution' ELSE 'retain' END AS risk_grade
FROM scores s JOIN bt ON s.model_key = bt.model_key""")
def g8_churn_decision(spark, sf):
    s = scores(spark, sf)
    best = E.best_f1_threshold(s, "y_true", "y_score", K).select("model_key", "threshold")
    return G.churn_decision(s.join(best, "model_key").select(ID, "model_key", "y_score", "threshold"),
                            "y_score", "threshold")


@register("g10_scale_counts", f"""b AS (WITH {_BUNDLE})
SELECT model_key, selected / total AS selected_share, selected / total * 1000 AS selected_per_1000,
       tp / total * 1000 AS tp_per_1000, fp / total * 1000 AS fp_per_1000, fn / total * 1000 AS fn_per_1000,
       tn / total * 1000 AS tn_per_1000 FROM b""")
def g10_scale_counts(spark, sf):
    return G.scale_counts(_metrics(spark, sf), by=K)


# --- H1, H7, H8, H10 ---------------------------------------------------------------

@register("h1_lift_table", """
d AS (SELECT *, ntile(10) OVER (PARTITION BY model_key ORDER BY y_score DESC, member_id) AS decile,
             count(*) OVER (PARTITION BY model_key) AS n, sum(y_true) OVER (PARTITION BY model_key) AS pos FROM scores),
p AS (SELECT model_key, CAST(decile AS INTEGER) AS decile, count(*) AS members, CAST(sum(y_true) AS BIGINT) AS churners,
             min(y_score) AS min_score, max(n) AS n, max(pos) AS pos FROM d GROUP BY model_key, decile)
SELECT model_key, decile, members, churners, min_score, churners / members AS churn_rate,
       sum(churners) OVER (PARTITION BY model_key ORDER BY decile ROWS UNBOUNDED PRECEDING) / pos AS cum_capture,
       (churners / members) / (pos / n) AS lift FROM p""")
def h1_lift_table(spark, sf):
    return G.lift_table(scores(spark, sf), ID, "y_true", "y_score", 10, by=K)


def _crm(m):
    # CRM flags derived from the member id (no CRM table exists in the data)
    return m.select(ID, (F.col(ID) % 11 == 0).alias("left_flag"),
                    F.date_add(F.col("start_date"), (F.col(ID) % 30).cast("int")).alias("last_contact"),
                    (F.col(ID) % 7 != 0).alias("consent"))


@register("h7_exclusions", f"""
blocked AS (SELECT member_id FROM members WHERE member_id % 11 = 0 OR member_id % 7 = 0
  OR start_date + CAST(member_id % 30 AS INTEGER) >= DATE '1995-01-20'),
r AS (SELECT *, row_number() OVER (PARTITION BY model_key ORDER BY y_score DESC, member_id) AS rk FROM scores
      WHERE y_score >= {T} AND member_id NOT IN (SELECT member_id FROM blocked))
SELECT model_key, member_id, y_score AS churn_probability, y_true AS actual_churn_for_evaluation,
       {_GRADE} AS risk_grade FROM r WHERE rk <= {CAP}""")
def h7_exclusions(spark, sf):
    # excluded members free their places: the capacity is filled after the exclusions
    crm = _crm(members(spark, sf))
    left = crm.filter("left_flag")
    no_consent = crm.filter(~F.col("consent"))
    recent = crm.filter(F.col("last_contact") >= F.lit("1995-01-20").cast("date"))
    allowed = G.exclude(scores(spark, sf), ID, left, no_consent, recent)
    return G.candidates(allowed, ID, "y_score", T, CAP, y="y_true", by=K)


@register("h8_control_arms", f"""
a AS (SELECT *, CASE WHEN CAST(('0x' || substr(md5(CAST(member_id AS VARCHAR) || '|42|arm'), 1, 8)) AS BIGINT)::DOUBLE
                     / 4294967296.0 < 0.3 THEN 'control' ELSE 'treatment' END AS arm
      FROM scores WHERE model_key = 'rule_full' AND y_score >= {T})
SELECT arm, count(*) AS members, avg(y_true::DOUBLE) AS rate FROM a GROUP BY arm""")
def h8_control_arms(spark, sf):
    s = scores(spark, sf).filter((F.col("model_key") == "rule_full") & (F.col("y_score") >= T))
    return G.compare_arms(G.assign_arm(s, ID, 0.3, 42), "arm", "y_true")


@register("h8_control_arms_by_model", f"""
a AS (SELECT *, CASE WHEN CAST(('0x' || substr(md5(CAST(member_id AS VARCHAR) || '|42|arm'), 1, 8)) AS BIGINT)::DOUBLE
                     / 4294967296.0 < 0.3 THEN 'control' ELSE 'treatment' END AS arm FROM scores WHERE y_score >= {T})
SELECT model_key, arm, count(*) AS members, avg(y_true::DOUBLE) AS rate FROM a GROUP BY model_key, arm""")
def h8_control_arms_by_model(spark, sf):
    s = scores(spark, sf).filter(F.col("y_score") >= T)
    return G.compare_arms(G.assign_arm(s, ID, 0.3, 42), "arm", "y_true", K)


@register("a10_campaign_csv", _RANKED + f"""
SELECT member_id, y_score AS churn_probability, {_GRADE} AS risk_grade FROM r WHERE rk <= {CAP} AND model_key = 'rule_50'""")
def a10_campaign_csv(spark, sf):
    # the list of the deployed model as a CSV file with header, without the evaluation label, read back
    from ..session import scratch_path
    from ..sources import files as A
    s = scores(spark, sf).filter("model_key = 'rule_50'")
    c = G.candidates(s, ID, "y_score", T, CAP, y="y_true")
    path = A.write_table(c, scratch_path(spark, "campaign"), "csv", order_by=[F.desc("churn_probability"), ID],
                         drop=["actual_churn_for_evaluation"])
    return A.read_members(spark, path, schema=c.drop("actual_churn_for_evaluation").schema)


_SPLIT_SQL = ("sp AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY churn ORDER BY "
              "md5(CAST(member_id AS VARCHAR) || '|42'), member_id) <= round(count(*) OVER (PARTITION BY churn) * 0.2) "
              "THEN 'test' ELSE 'train' END AS split FROM members)")


@register("h10_psi", _SPLIT_SQL + """,
cuts AS (SELECT quantile_cont(visits::DOUBLE, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS c
         FROM sp WHERE split = 'train'),
bk AS (SELECT split, len(list_filter(c, lambda x: x < visits::DOUBLE)) AS bucket FROM sp, cuts WHERE visits IS NOT NULL),
sh AS (SELECT split, bucket, count(*) / sum(count(*)) OVER (PARTITION BY split) AS share FROM bk GROUP BY split, bucket),
j AS (SELECT coalesce(b.bucket, c.bucket) AS bucket, coalesce(b.share, 0.0) AS base_share,
             coalesce(c.share, 0.0) AS current_share
      FROM (SELECT * FROM sh WHERE split = 'train') b FULL OUTER JOIN (SELECT * FROM sh WHERE split = 'test') c
      ON b.bucket = c.bucket)
SELECT CAST(bucket AS INTEGER) AS bucket, base_share, current_share,
       (greatest(current_share, 1e-6) - greatest(base_share, 1e-6))
       * ln(greatest(current_share, 1e-6) / greatest(base_share, 1e-6)) AS psi FROM j""")
def h10_psi(spark, sf):
    sp = D.stratified_split(members(spark, sf), ID, Y)
    return X.psi_table(sp.filter("split = 'train'"), sp.filter("split = 'test'"), "visits")


def _psi_all_sql() -> str:
    """One feature after the other: bins of both parts, shares, index."""
    bins = [f"SELECT split, '{c}' AS feature, CASE WHEN {c} IS NULL THEN '<null>' ELSE len(list_filter((SELECT "
            f"quantile_cont({c}::DOUBLE, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) FROM sp WHERE split = 'train'), "
            f"lambda x: x < {c}::DOUBLE))::VARCHAR END AS bin FROM sp" for c in NUM]
    bins += [f"SELECT split, '{c}', CASE WHEN {c} IS NULL THEN '<null>' WHEN {c} IN (SELECT {c} FROM sp WHERE split = 'train') "
             f"THEN {c} ELSE '<other>' END FROM sp" for c in CAT]
    return _SPLIT_SQL + f""",
b AS ({' UNION ALL '.join(bins)}),
sh AS (SELECT split, feature, bin, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY split, feature) AS share
       FROM b GROUP BY split, feature, bin),
j AS (SELECT coalesce(b.feature, c.feature) AS feature, coalesce(b.share, 0) AS p, coalesce(c.share, 0) AS q, coalesce(c.n, 0) AS n
      FROM (SELECT * FROM sh WHERE split = 'train') b FULL OUTER JOIN (SELECT * FROM sh WHERE split = 'test') c
      ON b.feature = c.feature AND b.bin = c.bin)
SELECT feature, sum(n)::BIGINT AS "rows",
       sum((greatest(q, 1e-6) - greatest(p, 1e-6)) * ln(greatest(q, 1e-6) / greatest(p, 1e-6))) AS psi FROM j GROUP BY feature"""


@register("h10_psi_all_features", _psi_all_sql())
def h10_psi_all_features(spark, sf):
    # every numeric feature and category from two sketches
    sp = D.stratified_split(members(spark, sf), ID, Y)
    base, current = sp.filter("split = 'train'"), sp.filter("split = 'test'")
    lay = DR.layout(base, NUM, CAT)
    # a few counts each, written once: the index reads every sketch twice
    return DR.psi(*[materialize(DR.sketch(part, lay), "sketch") for part in (base, current)])


_BIG = 2000


@register("g3_candidates_large_capacity", f"""
r AS (SELECT *, row_number() OVER (PARTITION BY model_key ORDER BY y_score DESC, member_id) AS rk
      FROM scores WHERE y_score >= 0.2)
SELECT model_key, member_id, y_score AS churn_probability, y_true AS actual_churn_for_evaluation,
       {_GRADE} AS risk_grade FROM r WHERE rk <= {_BIG}""")
def g3_candidates_large_capacity(spark, sf):
    # capacity above the per-task limit path: exercises the histogram cut
    return G.candidates(scores(spark, sf), ID, "y_score", 0.2, _BIG, y="y_true", by=K)
