"""Registered queries: features (C*) and splits / samples (D*, H2, H3, H6, H9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as FN
from ..operators import features as C
from ..operators import profile as P
from ..operators import splits as D
from .common import ID, NUM, Y, members, scores
from .registry import register

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
PREFS = ["click", "purchase", "view"]

_MD5 = "md5(CAST(member_id AS VARCHAR) || '|{seed}')"


def _split_sql(src: str = "members", seed="42", frac="0.2", name="split", pos="'test'", neg="'train'") -> str:
    return (f"SELECT *, CASE WHEN row_number() OVER (PARTITION BY churn ORDER BY {_MD5.format(seed=seed)}, member_id) "
            f"<= round(count(*) OVER (PARTITION BY churn) * {frac}) THEN {pos} ELSE {neg} END AS {name} FROM {src}")


# --- C1 .. C10 -----------------------------------------------------------------

@register("c1_fill_constants", "SELECT * REPLACE (coalesce(pref, 'none') AS pref) FROM members")
def c1_fill_constants(spark, sf):
    return C.fill_constants(members(spark, sf), {"pref": "none"})


@register("c2_drop_columns", "SELECT * EXCLUDE (fee, region) FROM members")
def c2_drop_columns(spark, sf):
    return C.drop_columns(members(spark, sf), ["fee", "region"])


_DATE_TEXT = "CASE WHEN pref IS NULL THEN 'not a date' ELSE CAST(start_date AS VARCHAR) END"


@register("c3_parse_date", f"""
SELECT member_id, CAST(start_date AS DATE) AS strict_date, TRY_CAST({_DATE_TEXT} AS DATE) AS coerced_date
FROM members""")
def c3_parse_date(spark, sf):
    m = members(spark, sf).withColumn(
        "_txt", F.when(F.col("pref").isNull(), F.lit("not a date")).otherwise(F.col("start_date").cast("string")))
    return m.select(ID, C.parse_date("start_date", strict=True).alias("strict_date"),
                    C.parse_date("_txt", strict=False).alias("coerced_date"))


@register("c4_date_features", """
SELECT member_id, CAST(year(start_date) AS INTEGER) AS start_year, CAST(month(start_date) AS INTEGER) AS start_month,
       CAST(isodow(start_date) - 1 AS INTEGER) AS start_weekday,
       CAST(datediff('day', start_date, (SELECT max(start_date) FROM members)) AS INTEGER) AS start_days
FROM members""")
def c4_date_features(spark, sf):
    out = C.date_features(members(spark, sf), "start_date")
    return out.select(ID, "start_year", "start_month", "start_weekday", "start_days")


@register("c5_days_since_latest_start", """
SELECT member_id, CAST(datediff('day', start_date, (SELECT max(start_date) FROM members)) AS INTEGER) AS start_days
FROM members""")
def c5_days_since_latest_start(spark, sf):
    # the reference date is the table's own latest start, planned as a scalar subquery
    return C.date_features(members(spark, sf), "start_date").select(ID, "start_days")


@register("c6_days_since_stored_date", """
SELECT member_id, CAST(year(start_date) AS INTEGER) AS start_year,
       CAST(CASE WHEN start_date IS NULL THEN NULL
            ELSE greatest(datediff('day', start_date, DATE '1999-06-30'), 0) END AS INTEGER) AS start_days
FROM members""")
def c6_days_since_stored_date(spark, sf):
    out = C.date_features(members(spark, sf), "start_date", reference="1999-06-30", floor=True, strict=False)
    return out.select(ID, "start_year", "start_days")


def _dummies(col, levels, drop_first=True, space=False):
    lv = levels[1:] if drop_first else levels
    return ", ".join(
        f"CAST(coalesce({col} = '{v}', false) AS INTEGER) AS \"{col}_{v.replace(' ', '_') if space else v}\""
        for v in lv)


@register("c7_onehot_first_drop",
          f"SELECT * EXCLUDE (segment, region), {_dummies('segment', SEGMENTS)}, {_dummies('region', REGIONS)} "
          f"FROM members")
def c7_onehot_first_drop(spark, sf):
    m = members(spark, sf)
    return C.OneHotFirstDrop(["segment", "region"]).fit(m).transform(m)


_STORED = ["visits", "returns", "segment_BUILDING", "region_MIDDLE_EAST", "pref_view", "segment_RETAIL"]


@register("c8_encode_like", """
SELECT visits, returns, CAST(coalesce(segment = 'BUILDING', false) AS INTEGER) AS segment_BUILDING,
       CAST(coalesce(region = 'MIDDLE EAST', false) AS INTEGER) AS region_MIDDLE_EAST,
       CAST(coalesce(pref = 'view', false) AS INTEGER) AS pref_view,
       CAST(coalesce(segment = 'RETAIL', false) AS INTEGER) AS segment_RETAIL
FROM members""")
def c8_encode_like(spark, sf):
    return C.encode_like(members(spark, sf), _STORED, ["segment", "region", "pref"], space_suffix=["region"])


@register("c9_flag_encoding", """
SELECT member_id, CAST(coalesce(pref, 'none') = 'none' AS INTEGER) AS pref_none,
       CAST(coalesce(segment = 'BUILDING', false) AS INTEGER) AS segment_BUILDING FROM members""")
def c9_flag_encoding(spark, sf):
    m = C.flag_equals(members(spark, sf), "pref", "none", fill="none")
    m = C.flag_equals(m, "segment", "BUILDING")
    return m.select(ID, "pref_none", "segment_BUILDING")


@register("c9_deployment_features", """
SELECT member_id, TRY_CAST(CAST(visits AS VARCHAR) AS DOUBLE) AS visits, TRY_CAST(CAST(returns AS VARCHAR) AS DOUBLE) AS returns,
       CAST(year(start_date) AS INTEGER) AS start_year,
       CAST(CASE WHEN start_date IS NULL THEN NULL
            ELSE greatest(datediff('day', start_date, DATE '2001-01-31'), 0) END AS INTEGER) AS start_days,
       CAST(coalesce(pref, 'none') = 'none' AS INTEGER) AS pref_none,
       CAST(coalesce(segment, 'UNKNOWN') = 'BUILDING' AS INTEGER) AS segment_BUILDING
FROM members""")
def c9_deployment_features(spark, sf):
    import json
    raw = members(spark, sf).withColumn("visits", F.col("visits").cast("string")) \
        .withColumn("returns", F.col("returns").cast("string"))
    stage = C.DeploymentFeatures(
        numericCols=["visits", "returns"], dateCol="start_date", datePrefix="start", referenceDate="2001-01-31",
        flags=json.dumps([["pref", "none", "none", "pref_none"], ["segment", "UNKNOWN", "BUILDING", "segment_BUILDING"]]),
        outputCols=["visits", "returns", "start_year", "start_days", "pref_none", "segment_BUILDING"],
        keepCols=[ID])
    return stage.transform(raw)


@register("c10_to_numeric", """
SELECT member_id, TRY_CAST(CASE WHEN pref IS NULL THEN 'n/a' ELSE CAST(visits AS VARCHAR) END AS DOUBLE) AS visits_num
FROM members""")
def c10_to_numeric(spark, sf):
    m = members(spark, sf).select(ID, F.when(F.col("pref").isNull(), F.lit("n/a"))
                                  .otherwise(F.col("visits").cast("string")).alias("visits_num"))
    return C.to_numeric(m, ["visits_num"])


# --- C11 .. C14 (fitted on the training split only) ----------------------------

_SPLIT = f"sp AS ({_split_sql()})"
_TRAIN = "split = 'train'"


@register("c11_standard_scaler", _SPLIT + """,
p AS (SELECT avg(fee) AS m1, stddev_pop(fee) AS s1, avg(visits) AS m2, stddev_pop(visits) AS s2,
             avg(avg_value) AS m3, stddev_pop(avg_value) AS s3 FROM sp WHERE split = 'train')
SELECT member_id, split, (fee - m1) / CASE WHEN s1 = 0 THEN 1 ELSE s1 END AS fee,
       (visits - m2) / CASE WHEN s2 = 0 THEN 1 ELSE s2 END AS visits,
       (avg_value - m3) / CASE WHEN s3 = 0 THEN 1 ELSE s3 END AS avg_value
FROM sp, p""")
def c11_standard_scaler(spark, sf):
    sp = D.stratified_split(members(spark, sf), ID, Y).select(ID, "split", "fee", "visits", "avg_value")
    return C.ExactStandardScaler(["fee", "visits", "avg_value"], fitWhere=_TRAIN).fit(sp).transform(sp)


@register("c12_robust_scaler", _SPLIT + """,
p AS (SELECT quantile_cont(urgent::DOUBLE, 0.5) AS m1,
             quantile_cont(urgent::DOUBLE, 0.75) - quantile_cont(urgent::DOUBLE, 0.25) AS i1,
             quantile_cont(returns::DOUBLE, 0.5) AS m2,
             quantile_cont(returns::DOUBLE, 0.75) - quantile_cont(returns::DOUBLE, 0.25) AS i2
      FROM sp WHERE split = 'train')
SELECT member_id, split, (urgent - m1) / CASE WHEN i1 = 0 THEN 1 ELSE i1 END AS urgent,
       (returns - m2) / CASE WHEN i2 = 0 THEN 1 ELSE i2 END AS returns
FROM sp, p""")
def c12_robust_scaler(spark, sf):
    sp = D.stratified_split(members(spark, sf), ID, Y).select(ID, "split", "urgent", "returns")
    return C.ExactRobustScaler(["urgent", "returns"], fitWhere=_TRAIN).fit(sp).transform(sp)


@register("c13_median_imputer", _SPLIT + """,
p AS (SELECT quantile_cont(avg_value, 0.5) AS m1, quantile_cont(returns::DOUBLE, 0.5) AS m2,
             quantile_cont(wait_days, 0.5) AS m3,
             count(*) - count(avg_value) AS n1, count(*) - count(returns) AS n2, count(*) - count(wait_days) AS n3
      FROM sp WHERE split = 'train')
SELECT member_id, split, coalesce(avg_value, m1) AS avg_value, coalesce(returns::DOUBLE, m2) AS returns,
       coalesce(wait_days, m3) AS wait_days,
       CAST(avg_value IS NULL AS INTEGER) AS avg_value_missing,
       CAST(returns IS NULL AS INTEGER) AS returns_missing,
       CAST(wait_days IS NULL AS INTEGER) AS wait_days_missing
FROM sp, p""")
def c13_median_imputer(spark, sf):
    # all three columns have nulls in the training rows, so all three get an indicator
    sp = D.stratified_split(members(spark, sf), ID, Y).select(ID, "split", "avg_value", "returns", "wait_days")
    return C.MedianImputer(["avg_value", "returns", "wait_days"], indicator=True, fitWhere=_TRAIN).fit(sp).transform(sp)


@register("c14_constant_impute_onehot", """
SELECT member_id, CAST(coalesce(pref, 'Missing') = 'Missing' AS INTEGER) AS pref_Missing,
       CAST(coalesce(pref, 'Missing') = 'click' AS INTEGER) AS pref_click,
       CAST(coalesce(pref, 'Missing') = 'purchase' AS INTEGER) AS pref_purchase,
       CAST(coalesce(pref, 'Missing') = 'view' AS INTEGER) AS pref_view
FROM members""")
def c14_constant_impute_onehot(spark, sf):
    m = C.ConstantImputer(inputCols=["pref"], value="Missing").transform(members(spark, sf).select(ID, "pref"))
    return C.OneHotFirstDrop(["pref"], dropFirst=False).fit(m).transform(m)


@register("c16_to_xy", """
SELECT fee, visits, avg_value, urgent, returns, parts, wait_days, churn FROM members""")
def c16_to_xy(spark, sf):
    return C.to_xy(members(spark, sf).select(ID, *NUM, Y), Y, ID)


@register("c20_top_half_features", """
imp AS (""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, abs(corr({c}::DOUBLE, churn::DOUBLE)) AS importance FROM members" for c in NUM) + """),
r AS (SELECT feature, importance, CAST(row_number() OVER (ORDER BY importance DESC, feature) AS INTEGER) AS rank,
             count(*) OVER () AS n FROM imp)
SELECT feature, importance, rank FROM r WHERE rank <= floor(n * 0.5)""")
def c20_top_half_features(spark, sf):
    imp = P.corr_with_target(members(spark, sf), NUM, Y).select("feature", F.col("abs_corr").alias("importance"))
    return C.select_top_fraction(imp, 0.5)


@register("c21_risk_grade", """
SELECT member_id, model_key, y_score,
       CASE WHEN y_score >= 0.7 THEN 'high_risk' WHEN y_score >= 0.4 THEN 'caution' ELSE 'retain' END AS risk_grade
FROM scores""")
def c21_risk_grade(spark, sf):
    return scores(spark, sf).select(ID, "model_key", "y_score", FN.risk_grade("y_score").alias("risk_grade"))


@register("c23_parse_key", """
k AS (SELECT DISTINCT model_key FROM scores),
b AS (SELECT model_key, split_part(model_key, '_without_', 1) AS base FROM k)
SELECT model_key,
       CASE WHEN contains(base, '_') THEN regexp_extract(base, '^(.*)_[^_]*$', 1) ELSE base END AS model,
       CASE WHEN suffix(base, '_50') THEN '50' ELSE 'full' END AS dataset,
       CASE WHEN contains(model_key, '_without_') THEN substr(model_key, strpos(model_key, '_without_') + 9) END AS excluded
FROM b""")
def c23_parse_key(spark, sf):
    k = scores(spark, sf).select("model_key").distinct()
    return k.select("model_key", FN.parse_key("model_key").alias("p")).select(
        "model_key", "p.model", "p.dataset", "p.excluded")


@register("c24_artifact_name", r"""
p AS (SELECT member_id, model_key, CASE WHEN y_true = 1 THEN 'C:\artifacts\' || model_key || '_results.json'
                                        ELSE '/srv/artifacts/' || model_key || '_results.json' END AS path FROM scores)
SELECT member_id, model_key, path, split_part(replace(path, '\', '/'), '/', -1) AS file_name FROM p""")
def c24_artifact_name(spark, sf):
    s = scores(spark, sf)
    path = F.when(F.col("y_true") == 1, F.concat(F.lit("C:\\artifacts\\"), "model_key", F.lit("_results.json"))) \
        .otherwise(F.concat(F.lit("/srv/artifacts/"), "model_key", F.lit("_results.json")))
    return s.select(ID, "model_key", path.alias("path")).withColumn("file_name", FN.artifact_name("path"))


# --- D1 .. D5 ----------------------------------------------------------------

@register("d1_stratified_split", _split_sql())
def d1_stratified_split(spark, sf):
    return D.stratified_split(members(spark, sf), ID, Y, 0.2, 42)


@register("d2_three_way_split", f"""
s1 AS ({_split_sql(name='s1')}),
s2 AS ({_split_sql(src="(SELECT * FROM s1 WHERE s1 = 'train')", seed='42|val', frac='0.25', name='split',
                   pos="'validation'", neg="'train'")})
SELECT * EXCLUDE (s1) FROM s2
UNION ALL
SELECT * EXCLUDE (s1), 'test' AS split FROM s1 WHERE s1 = 'test'""")
def d2_three_way_split(spark, sf):
    return D.three_way_split(members(spark, sf), ID, Y, 0.2, 0.25, 42)


@register("d3_train_subsample", f"""
sp AS ({_split_sql()}),
sub AS (SELECT *, row_number() OVER (PARTITION BY churn ORDER BY {_MD5.format(seed='42|sub')}, member_id) AS rk,
               count(*) OVER (PARTITION BY churn) AS n FROM sp WHERE split = 'train')
SELECT * EXCLUDE (rk, n) FROM sub WHERE rk <= round(n * 0.5)
UNION ALL
SELECT * FROM sp WHERE split <> 'train'""")
def d3_train_subsample(spark, sf):
    sp = D.stratified_split(members(spark, sf), ID, Y)
    return D.stratified_subsample(sp, ID, Y, 0.5, 42, where="split = 'train'")


@register("d4_even_sample", f"""
n AS (SELECT *, row_number() OVER (ORDER BY member_id) AS rn, count(*) OVER () AS total FROM members),
c AS (SELECT *, (rn - 1) // 400 AS chunk FROM n),
q AS (SELECT *, round_even(1000 * least((chunk + 1) * 400, total) / total, 0)
                - round_even(1000 * (chunk * 400) / total, 0) AS quota,
             row_number() OVER (PARTITION BY chunk ORDER BY {_MD5.format(seed='42')}, member_id) AS r FROM c)
SELECT * EXCLUDE (rn, total, chunk, quota, r) FROM q WHERE total <= 1000 OR r <= quota""")
def d4_even_sample(spark, sf):
    return D.even_sample(members(spark, sf), ID, max_rows=1000, chunk=400, seed=42)


@register("d5_head", "SELECT * FROM members ORDER BY member_id LIMIT 100")
def d5_head(spark, sf):
    return D.head(members(spark, sf), ID, 100)


# --- H2, H3, H6, H9 ---------------------------------------------------------------

@register("h2_group_split", """
SELECT member_id, region, CASE WHEN CAST(('0x' || substr(md5(region || '|42|group'), 1, 8)) AS BIGINT)::DOUBLE
       / 4294967296.0 < 0.2 THEN 'test' ELSE 'train' END AS split FROM members""")
def h2_group_split(spark, sf):
    return D.group_split(members(spark, sf).select(ID, "region"), "region", 0.2, 42)


@register("h3_temporal_split", """
SELECT member_id, start_date, CASE WHEN start_date IS NULL THEN NULL WHEN start_date < DATE '1995-03-01' THEN 'train'
       WHEN start_date < DATE '1995-06-01' THEN 'validation' ELSE 'test' END AS split FROM members""")
def h3_temporal_split(spark, sf):
    return D.temporal_split(members(spark, sf).select(ID, "start_date"), "start_date",
                            ["1995-03-01", "1995-06-01"])


@register("h6_stratified_kfold", f"""
SELECT member_id, churn, CAST((row_number() OVER (PARTITION BY churn ORDER BY {_MD5.format(seed='42|fold')}, member_id) - 1) % 5
       AS INTEGER) AS fold FROM members""")
def h6_stratified_kfold(spark, sf):
    return D.kfold(members(spark, sf).select(ID, Y), ID, Y, 5, 42)


@register("h9_undersample", f"""
r AS (SELECT *, row_number() OVER (PARTITION BY churn ORDER BY {_MD5.format(seed='42|under')}, member_id) AS rk FROM members)
SELECT * EXCLUDE (rk) FROM r WHERE rk <= (SELECT min(n) FROM (SELECT count(*) AS n FROM members GROUP BY churn) t)""")
def h9_undersample(spark, sf):
    return D.undersample(members(spark, sf), ID, Y, 42)
