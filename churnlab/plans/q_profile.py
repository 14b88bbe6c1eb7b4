"""Registered queries: member table (H4, H5) and profiling (B*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile as P
from ..operators import extras as X
from .common import CAT, ID, NUM, Y, members
from .registry import register, union_all

MEMBER_COLS = ["member_id", "segment", "region", "fee", "start_date", "visits", "avg_value",
               "urgent", "returns", "parts", "wait_days", "pref", "churn"]


def _per_col(tmpl: str, cols) -> str:
    return union_all(tmpl.format(c=c) for c in cols)


# --- H4 / H5 ----------------------------------------------------------------

@register("h4_members", "SELECT * FROM members")
def h4_members(spark, sf):
    return members(spark, sf)


@register("h5_join_audit", """
SELECT 'customer' AS stage, count(*) AS rows, count(DISTINCT c_custkey) AS members,
       count(*) - count(DISTINCT c_custkey) AS duplicates,
       (count(*) - count(c_acctbal)) / count(*) AS null_rate
FROM customer
UNION ALL
SELECT 'members', count(*), count(DISTINCT member_id), count(*) - count(DISTINCT member_id),
       (count(*) - count(start_date)) / count(*)
FROM members""")
def h5_join_audit(spark, sf):
    from ..sources.tables import table
    before = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"))
    after = members(spark, sf).select(F.col(ID).alias("k"), F.col("start_date").alias("v"))
    return X.join_audit({"customer": before, "members": after}, "k", "v")


# --- B1 .. B23 --------------------------------------------------------------

@register("b1_shape", "SELECT count(*) AS rows, 13 AS columns FROM members")
def b1_shape(spark, sf):
    return P.shape(members(spark, sf))


@register("b3_missing", _per_col(
    "SELECT '{c}' AS feature, count(*) - count({c}) AS missing, "
    "(count(*) - count({c})) / count(*) AS ratio FROM members", MEMBER_COLS))
def b3_missing(spark, sf):
    return P.missing(members(spark, sf))


@register("b4_duplicate_keys",
          "SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS duplicates "
          "FROM (SELECT count(*) AS c FROM members GROUP BY member_id) t")
def b4_duplicate_keys(spark, sf):
    return P.duplicate_count(members(spark, sf), [ID])


@register("b5_duplicate_rows",
          "SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS duplicates FROM (SELECT count(*) AS c "
          "FROM members GROUP BY segment, region, fee, start_date, visits, avg_value, urgent, returns, "
          "parts, wait_days, pref, churn) t")
def b5_duplicate_rows(spark, sf):
    return P.duplicate_count(members(spark, sf).drop(ID))


_FENCE_SQL = (
    "q AS (" + union_all(
        f"SELECT '{c}' AS feature, quantile_cont({c}::DOUBLE, 0.25) AS q1, "
        f"quantile_cont({c}::DOUBLE, 0.5) AS median, quantile_cont({c}::DOUBLE, 0.75) AS q3 FROM members"
        for c in NUM) + "),\n"
    "f AS (SELECT feature, q1, median, q3, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q)")


@register("b6_iqr_outliers", _FENCE_SQL + ",\nc AS (" + union_all(
    f"SELECT '{c}' AS feature, count(*) AS n, count(*) FILTER (WHERE {c} < (SELECT lower FROM f WHERE feature = '{c}') "
    f"OR {c} > (SELECT upper FROM f WHERE feature = '{c}')) AS outlier_count FROM members" for c in NUM) + ")\n"
    "SELECT f.feature, q1, q3, lower, upper, outlier_count, round(outlier_count / n * 100, 2) AS outlier_pct "
    "FROM f JOIN c ON f.feature = c.feature")
def b6_iqr_outliers(spark, sf):
    return P.iqr_outliers(members(spark, sf), NUM)


@register("b7_box_stats", _FENCE_SQL + ",\nw AS (" + union_all(
    f"SELECT '{c}' AS feature, "
    f"min({c}::DOUBLE) FILTER (WHERE {c} >= (SELECT lower FROM f WHERE feature = '{c}') AND {c} <= (SELECT upper FROM f WHERE feature = '{c}')) AS whisker_low, "
    f"max({c}::DOUBLE) FILTER (WHERE {c} >= (SELECT lower FROM f WHERE feature = '{c}') AND {c} <= (SELECT upper FROM f WHERE feature = '{c}')) AS whisker_high, "
    f"count(*) FILTER (WHERE {c} < (SELECT lower FROM f WHERE feature = '{c}') OR {c} > (SELECT upper FROM f WHERE feature = '{c}')) AS n_outliers "
    f"FROM members" for c in NUM) + ")\n"
    "SELECT f.feature, q1, median, q3, whisker_low, whisker_high, n_outliers FROM f JOIN w ON f.feature = w.feature")
def b7_box_stats(spark, sf):
    return P.box_stats(members(spark, sf), NUM)


@register("b8_histogram",
          "r AS (" + union_all(f"SELECT '{c}' AS feature, min({c}::DOUBLE) AS mn, max({c}::DOUBLE) AS mx FROM members"
                               for c in NUM) + "),\n"
          "v AS (" + union_all(f"SELECT '{c}' AS feature, {c}::DOUBLE AS x FROM members WHERE {c} IS NOT NULL"
                               for c in NUM) + "),\n"
          "b AS (SELECT v.feature, CAST(CASE WHEN mx = mn THEN 0 ELSE least(floor((x - mn) * 30 / (mx - mn)), 29) END AS INTEGER) AS bin "
          "FROM v JOIN r ON v.feature = r.feature),\n"
          "cnt AS (SELECT feature, bin, count(*) AS n FROM b GROUP BY feature, bin),\n"
          "g AS (SELECT feature, mn, mx, CAST(i AS INTEGER) AS bin FROM r, range(30) t(i))\n"
          "SELECT g.feature, g.bin, mn + g.bin * ((mx - mn) / 30) AS lo, mn + (g.bin + 1) * ((mx - mn) / 30) AS hi, "
          "coalesce(cnt.n, 0) AS n FROM g LEFT JOIN cnt ON g.feature = cnt.feature AND g.bin = cnt.bin")
def b8_histogram(spark, sf):
    return P.histogram(members(spark, sf), NUM, bins=30)


@register("b9_value_counts", _per_col(
    "SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM members "
    "WHERE {c} IS NOT NULL GROUP BY {c}", CAT))
def b9_value_counts(spark, sf):
    return P.value_counts(members(spark, sf), CAT)


@register("b10_distinct_counts", _per_col(
    "SELECT '{c}' AS feature, count(DISTINCT {c}) AS n_distinct FROM members", CAT + ["start_date", "visits"]))
def b10_distinct_counts(spark, sf):
    return P.distinct_counts(members(spark, sf), CAT + ["start_date", "visits"])


@register("b11_non_null_counts", _per_col(
    "SELECT '{c}' AS feature, count({c}) AS non_null FROM members", NUM))
def b11_non_null_counts(spark, sf):
    return P.non_null_counts(members(spark, sf), NUM)


@register("b12_rate_by_category", _per_col(
    "SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, count(*) AS n, avg(churn) AS rate, "
    "round(avg(churn) * 100, 2) AS rate_pct FROM members WHERE {c} IS NOT NULL GROUP BY {c}", CAT))
def b12_rate_by_category(spark, sf):
    return P.rate_by_category(members(spark, sf), CAT, Y)


_STATS_SQL = ("s AS (" + union_all(
    f"SELECT '{c}' AS feature, churn, round(avg({c}::DOUBLE), 2) AS mean, round(quantile_cont({c}::DOUBLE, 0.5), 2) AS median, "
    f"round(stddev_samp({c}::DOUBLE), 2) AS std, round(min({c}::DOUBLE), 2) AS min, round(max({c}::DOUBLE), 2) AS max "
    f"FROM members GROUP BY churn" for c in NUM) + ")")


@register("b13_stats_by_target", _STATS_SQL + "\nSELECT * FROM s")
def b13_stats_by_target(spark, sf):
    return P.stats_by_target(members(spark, sf), NUM, Y)


@register("b14_mean_contrast", _STATS_SQL + """,
w AS (SELECT feature, max(CASE WHEN churn = 0 THEN mean END) AS mean_0,
             max(CASE WHEN churn = 1 THEN mean END) AS mean_1 FROM s GROUP BY feature)
SELECT feature, mean_0, mean_1, round(mean_1 - mean_0, 2) AS diff,
       CASE WHEN mean_0 <> 0 THEN round((mean_1 - mean_0) / mean_0 * 100, 2) END AS diff_pct FROM w""")
def b14_mean_contrast(spark, sf):
    return P.mean_contrast(members(spark, sf), NUM, Y)


@register("b15_corr_with_target", _per_col(
    "SELECT '{c}' AS feature, corr({c}::DOUBLE, churn::DOUBLE) AS corr, "
    "abs(corr({c}::DOUBLE, churn::DOUBLE)) AS abs_corr FROM members", NUM))
def b15_corr_with_target(spark, sf):
    return P.corr_with_target(members(spark, sf), NUM, Y)


_CORR_COLS = ["fee", "visits", "avg_value", "urgent", "returns", "churn"]


@register("b16_corr_matrix", union_all(
    f"SELECT '{a}' AS a, '{b}' AS b, corr({a}::DOUBLE, {b}::DOUBLE) AS r FROM members"
    for a in _CORR_COLS for b in _CORR_COLS))
def b16_corr_matrix(spark, sf):
    return P.corr_matrix(members(spark, sf), _CORR_COLS)


@register("b17_class_balance",
          "SELECT churn, count(*) AS n, round(count(*) / sum(count(*)) OVER () * 100, 2) AS pct "
          "FROM members GROUP BY churn")
def b17_class_balance(spark, sf):
    return P.class_balance(members(spark, sf), Y)


@register("b18_imbalance",
          "SELECT max(n) AS majority, min(n) AS minority, round(max(n) / min(n), 2) AS ratio "
          "FROM (SELECT count(*) AS n FROM members GROUP BY churn) t")
def b18_imbalance(spark, sf):
    return P.imbalance(members(spark, sf), Y)


@register("b19_describe", _per_col(
    "SELECT '{c}' AS feature, count({c}) AS count, avg({c}::DOUBLE) AS mean, stddev_samp({c}::DOUBLE) AS std, "
    "min({c}::DOUBLE) AS min, quantile_cont({c}::DOUBLE, 0.25) AS q25, quantile_cont({c}::DOUBLE, 0.5) AS q50, "
    "quantile_cont({c}::DOUBLE, 0.75) AS q75, max({c}::DOUBLE) AS max FROM members", NUM))
def b19_describe(spark, sf):
    return P.describe(members(spark, sf), NUM)


@register("b20_date_extremes", """
d AS (SELECT start_date, count(*) AS n FROM members WHERE start_date IS NOT NULL GROUP BY start_date)
SELECT (SELECT count(*) FROM d) AS n_distinct,
       (SELECT start_date FROM d ORDER BY n DESC, start_date LIMIT 1) AS top_date,
       (SELECT n FROM d ORDER BY n DESC, start_date LIMIT 1) AS top_n,
       (SELECT start_date FROM d ORDER BY n, start_date LIMIT 1) AS bottom_date,
       (SELECT n FROM d ORDER BY n, start_date LIMIT 1) AS bottom_n""")
def b20_date_extremes(spark, sf):
    return P.date_extremes(members(spark, sf), "start_date")


@register("b21_quantiles", _per_col(
    "SELECT '{c}' AS feature, quantile_cont({c}::DOUBLE, 0.25) AS q25, quantile_cont({c}::DOUBLE, 0.75) AS q75 "
    "FROM members", ["visits", "avg_value", "urgent", "returns", "wait_days"]))
def b21_quantiles(spark, sf):
    return P.quantiles(members(spark, sf), ["visits", "avg_value", "urgent", "returns", "wait_days"])


@register("b22_rate_spread", """
r AS (""" + _per_col("SELECT '{c}' AS feature, avg(churn) AS rate FROM members WHERE {c} IS NOT NULL GROUP BY {c}", CAT) + """)
SELECT feature, min(rate) AS min_rate, max(rate) AS max_rate, max(rate) - min(rate) AS spread
FROM r GROUP BY feature""")
def b22_rate_spread(spark, sf):
    return P.rate_spread(members(spark, sf), CAT, Y)


@register("b23_behaviour_contrast", _STATS_SQL + """
SELECT feature, max(CASE WHEN churn = 0 THEN mean END) AS retained_mean,
       max(CASE WHEN churn = 1 THEN mean END) AS churned_mean FROM s GROUP BY feature""")
def b23_behaviour_contrast(spark, sf):
    return P.class_means(members(spark, sf), NUM, Y)
