"""Preprocessing batch (the reference's L1 script) as one Spark plan.

read -> fill -> drop -> date parts + days since the latest start -> one-hot
(first level dropped) -> stratified split **column** -> standard / robust
scaling fitted on the training rows -> importance-ranked top half. The split
is a column, not two frames, so the full table is written once and the
top-half table is a projection of it (plus the missing-value marks that rank there).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features as C
from ..operators import models as M
from ..operators import splits as D
from ..session import materialize
from ..sources.files import write_table
from . import members as MB

STANDARD = ["visits", "avg_value", "parts", "wait_days", "start_year", "start_month", "start_weekday",
            "start_days"]
ROBUST = ["urgent", "returns"]


def preprocess(spark: SparkSession, data_dir: str, label: str = "planted", out_dir: str | None = None,
               importance_spec: M.ModelSpec | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Returns ``(full, top_half, importance)``; writes both tables under
    ``out_dir`` when given (``split`` kept as a column)."""
    # written once: level lists, split borders, scalers and the fit all read it
    m = materialize(MB.with_planted(MB.members(spark, data_dir)), "preprocess_members")
    m = C.fill_constants(m, {"pref": "none"})
    m = C.drop_columns(m, ["fee", "score"] + (["churn"] if label != "churn" else ["planted"]))
    m = C.date_features(m, "start_date", prefix="start")
    m = C.OneHotFirstDrop(["segment", "region", "pref"]).fit(m).transform(m)
    m = D.stratified_split(m, MB_ID, label, 0.2, 42)
    train = "split = 'train'"
    m = C.ExactStandardScaler(STANDARD, fitWhere=train).fit(m).transform(m)
    m = C.ExactRobustScaler(ROBUST, fitWhere=train).fit(m).transform(m)
    feats = [c for c in m.columns if c not in (MB_ID, label, "split")]
    spec = importance_spec or M.ModelSpec("importance", "gbt", {"maxIter": 20, "maxDepth": 6, "stepSize": 0.1})
    model = M.fit(spec, m, feats, [], label, fit_where=train)
    importance = M.importances(model)
    top = [r["feature"] for r in C.select_top_fraction(importance, 0.5).collect()]   # <= schema width
    # the model also ranks the missing-value marks that it adds; those of the top half become columns
    have = set(m.columns)
    cols = [F.col(f"`{c}`") if c in have else F.col("`" + c.removesuffix("_missing") + "`").isNull().cast("double").alias(c)
            for c in top]
    top_half = m.select(MB_ID, *cols, label, "split")
    if out_dir:
        write_table(m, f"{out_dir}/full", "parquet")
        write_table(top_half, f"{out_dir}/top_half", "parquet")
    return m, top_half, importance


MB_ID = "member_id"


# The reference preprocessing script on the raw member file --
# constant fills, dropped columns, dummy columns, date feature names and the
# standard / robust scaler column lists.
RAW_FILLS = {"Cardio_Preference": "No Preference", "Supplement_Usage": "No Protein Supplements"}
RAW_DROPS = ["Treadmill_Avg_Speed_Kmh", "Treadmill_Avg_Incline_Pct", "Gender", "Membership_Type",
             "Peak_Hour_Preference", "Monthly_Fee"]
RAW_DUMMIES = ["Cardio_Preference", "Supplement_Usage", "Profile_Type"]
RAW_DATE_NAMES = {"year": "Start_Year", "month": "Start_Month", "weekday": "Start_Weekday",
                  "days": "Membership_Days"}
RAW_STANDARD = ["Age", "Monthly_Visits", "Avg_Workout_Duration_Min", "Group_Class_Attendance",
                "Avg_Equipment_Wait_Time_Min", "Start_Year", "Start_Month", "Start_Weekday", "Membership_Days"]
RAW_ROBUST = ["PT_Session_Count", "Late_Payment_Count"]


def preprocess_member_file(df: DataFrame, id_col: str = "Member_ID", label: str = "Churn",
                           test_fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """The preprocessing script on the raw member schema, as one plan.

    fills -> drops -> date parts and days since the latest start -> dummies
    (first sorted level dropped) -> stratified split column -> scaling fitted
    on the training rows. The id is kept (rows have no position in Spark);
    the remaining columns come out in the script's order.
    """
    out = C.fill_constants(df, RAW_FILLS)
    out = C.drop_columns(out, RAW_DROPS)
    out = C.date_features(out, "Membership_Start_Date", names=RAW_DATE_NAMES)
    out = C.OneHotFirstDrop(RAW_DUMMIES).fit(out).transform(out)
    out = D.stratified_split(out, id_col, label, test_fraction, seed)
    train = "split = 'train'"
    out = C.ExactStandardScaler(RAW_STANDARD, fitWhere=train).fit(out).transform(out)
    return C.ExactRobustScaler(RAW_ROBUST, fitWhere=train).fit(out).transform(out)
