"""Hand-sized literal tables for edge cases, checked against brute force."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from churnlab.functions import columns as FN
from churnlab.operators import campaign as G
from churnlab.operators import evaluate as E
from churnlab.operators import features as C
from churnlab.operators import ordered as O
from churnlab.operators import profile as P


def _scored(spark, y, s, key=None):
    rows = [(i, int(a), float(b)) for i, (a, b) in enumerate(zip(y, s))]
    df = spark.createDataFrame(rows, "id long, y int, s double")
    return df if key is None else df.withColumn("k", F.lit(key))


def brute_auc(y, s):
    y, s = np.asarray(y), np.asarray(s)
    pos, neg = s[y == 1], s[y == 0]
    if len(pos) == 0 or len(neg) == 0:
        return None
    gt = (pos[:, None] > neg[None, :]).sum()
    eq = (pos[:, None] == neg[None, :]).sum()
    return (gt + 0.5 * eq) / (len(pos) * len(neg))


def brute_ap(y, s):
    y, s = np.asarray(y), np.asarray(s)
    P_ = y.sum()
    ap = 0.0
    for t in np.unique(s):
        sel = s >= t
        tp = (y[sel] == 1).sum()
        prec = tp / sel.sum()
        ap += ((y[s == t] == 1).sum() / P_) * prec
    return ap


@pytest.fixture(scope="module")
def random_scores():
    rng = np.random.default_rng(7)
    s = np.round(rng.random(400), 2)           # heavy ties
    y = (rng.random(400) < s).astype(int)
    return y, s


def test_auc_and_ap_match_brute_force(spark, random_scores):
    y, s = random_scores
    df = _scored(spark, y, s)
    got = E.metrics(df, "y", "s", 0.5).first()
    assert got["roc_auc"] == pytest.approx(brute_auc(y, s), abs=1e-12)
    assert got["pr_auc"] == pytest.approx(brute_ap(y, s), abs=1e-12)
    pred = s >= 0.5
    assert got["tp"] == int(((y == 1) & pred).sum()) and got["tn"] == int(((y == 0) & ~pred).sum())


def test_auc_invariant_under_monotone_map(spark, random_scores):
    y, s = random_scores
    a = E.roc_auc(_scored(spark, y, s), "y", "s").first()[0]
    b = E.roc_auc(_scored(spark, y, s ** 3 + 1), "y", "s").first()[0]
    assert a == pytest.approx(b, abs=1e-12)


def test_absent_class_keeps_zero_cells(spark):
    df = _scored(spark, [0, 0, 0], [0.1, 0.6, 0.9])
    m = E.metrics(df, "y", "s", 0.5).first()
    assert m["roc_auc"] is None and m["pr_auc"] is None
    assert (m["tn"], m["fp"], m["fn"], m["tp"]) == (1, 2, 0, 0)
    assert m["precision"] == 0.0 and m["recall"] == 0.0 and m["f1"] == 0.0


def test_trapezoid_of_roc_equals_auc(spark, random_scores, monkeypatch):
    monkeypatch.setattr(O, "GROUP_RANGE_MIN", 10)
    y, s = random_scores
    df = _scored(spark, y, s)
    curve = E.roc_curve(df, "y", "s")
    area = E.trapezoid(curve, "fpr", "tpr", buckets=5).first()[0]
    assert area == pytest.approx(brute_auc(y, s), abs=1e-12)


def test_best_f1_threshold_first_maximum(spark, random_scores):
    y, s = random_scores
    best = E.best_f1_threshold(_scored(spark, y, s), "y", "s").first()
    P_ = y.sum()
    cands = []
    for t in np.unique(s):
        sel = s >= t
        p = (y[sel] == 1).sum() / sel.sum()
        r = (y[sel] == 1).sum() / P_
        cands.append((2 * p * r / (p + r + 1e-12), t))
    f1max = max(c[0] for c in cands)
    tmin = min(t for f, t in cands if f == f1max)
    assert best["threshold"] == pytest.approx(tmin) and best["f1"] == pytest.approx(f1max)


def test_threshold_sweep_matches_each_threshold(spark, random_scores):
    y, s = random_scores
    sw = {round(r["threshold"], 2): r for r in E.threshold_sweep(_scored(spark, y, s), "y", "s").collect()}
    assert len(sw) == 91
    for k in (5, 29, 50, 57, 95):
        t = k / 100.0
        sel = s >= t
        assert sw[round(t, 2)]["tp"] == int(((y == 1) & sel).sum())
        assert sw[round(t, 2)]["selected"] == int(sel.sum())


@pytest.mark.parametrize("group_min", [100_000, 10])
def test_running_totals_multi_bucket(spark, group_min, monkeypatch):
    monkeypatch.setattr(O, "GROUP_RANGE_MIN", group_min)   # 10: every group is cut into ranges
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 300), "k": rng.permutation(300).astype(float),
                        "v": rng.integers(0, 5, 300)})
    df = spark.createDataFrame(pdf)
    got = O.running_totals(df, "k", ["v"], by=["g"], buckets=6).toPandas()
    exp = pdf.sort_values("k").groupby("g")["v"].cumsum()
    merged = pdf.assign(exp=exp).merge(got, on=["g", "k", "v"])
    assert len(merged) == 300 and (merged["exp"] == merged["cum_v"]).all()


@pytest.mark.parametrize("group_min", [100_000, 10])
def test_exact_quantiles_match_numpy(spark, group_min, monkeypatch):
    monkeypatch.setattr(O, "GROUP_RANGE_MIN", group_min)
    rng = np.random.default_rng(5)
    vals = rng.normal(size=201)
    vals[::17] = np.nan
    pdf = pd.DataFrame({"a": vals, "b": rng.integers(0, 4, 201).astype(float)})
    df = spark.createDataFrame(pdf).withColumn("a", F.when(F.isnan("a"), None).otherwise(F.col("a")))
    for many in (False, True):
        q = {(r["feature"], r["prob"]): r["value"]
             for r in O.exact_quantiles(df, ["a", "b"], [0.1, 0.25, 0.5, 0.75, 0.9], buckets=4,
                                        many_groups=many).collect()}
        for c in ("a", "b"):
            x = pdf[c].dropna().to_numpy()
            for p in (0.1, 0.25, 0.5, 0.75, 0.9):
                assert q[(c, p)] == pytest.approx(np.quantile(x, p), abs=1e-12)


@pytest.mark.parametrize("cap", [1, 7, 100, 1000, 5000])
def test_rank_cut_with_a_heavy_tie(spark, cap, monkeypatch):
    monkeypatch.setattr(O, "GROUP_RANGE_MIN", 10)
    rng = np.random.default_rng(11)
    n = 1500
    s = np.where(np.arange(n) % 3 == 0, 0.5, np.round(rng.random(n), 3))   # a third share one score
    pdf = pd.DataFrame({"id": rng.permutation(n).astype("int64"), "s": s})
    df = spark.createDataFrame(pdf)
    got = set(O.rank_cut(df, "s", "id", cap, buckets=4, many_groups=True).filter("_in_top").toPandas()["id"])
    exp = set(pdf.sort_values(["s", "id"], ascending=[False, True]).head(cap)["id"])
    assert got == exp
    got2 = set(O.top_n(df, "s", "id", cap).toPandas()["id"])
    assert got2 == exp
    text = df.withColumn("id", F.format_string("%08d", "id"))      # ids that are not numbers
    assert {int(i) for i in O.top_n(text, "s", "id", cap).toPandas()["id"]} == exp


def test_lift_deciles(spark):
    rng = np.random.default_rng(13)
    n = 257
    pdf = pd.DataFrame({"id": np.arange(n, dtype="int64"), "s": np.round(rng.random(n), 1),
                        "y": rng.integers(0, 2, n)})
    df = spark.createDataFrame(pdf)
    lift = G.lift_table(df, "id", "y", "s", 10).toPandas().sort_values("decile")
    sizes = [26] * 7 + [25] * 3                     # ntile: the first n % 10 deciles get one more
    assert lift["members"].tolist() == sizes
    assert lift["cum_capture"].iloc[-1] == pytest.approx(1.0)
    exp = pdf.sort_values(["s", "id"], ascending=[False, True]).reset_index(drop=True)
    cuts = np.cumsum([0] + sizes)
    assert lift["churners"].tolist() == [int(exp["y"][a:z].sum()) for a, z in zip(cuts, cuts[1:])]
    few = G.lift_table(df.filter("id < 4"), "id", "y", "s", 10).toPandas()     # fewer rows than deciles
    assert few["members"].tolist() == [1] * 4 and few["decile"].tolist() == [1, 2, 3, 4]


def test_robust_scaler_zero_iqr_and_fit_rows_only(spark):
    df = spark.createDataFrame([(i, 3.0, "train" if i < 8 else "test") for i in range(10)],
                               "id long, x double, split string")
    out = C.ExactRobustScaler(["x"], fitWhere="split = 'train'").fit(df).transform(df)
    assert {r["x"] for r in out.collect()} == {0.0}
    changed = df.withColumn("x", F.when(F.col("split") == "test", 1e9).otherwise(F.col("x")))
    m1 = C.ExactStandardScaler(["x"], fitWhere="split = 'train'").fit(df)
    m2 = C.ExactStandardScaler(["x"], fitWhere="split = 'train'").fit(changed)
    assert m1.getOrDefault(m1.state) == m2.getOrDefault(m2.state)


def test_one_hot_first_drop_and_unseen(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), (None,)], "cat string")
    m = C.OneHotFirstDrop(["cat"]).fit(df)
    new = spark.createDataFrame([("a",), ("z",), ("c",)], "cat string")
    rows = m.transform(new).collect()
    assert m.transform(new).columns == ["cat_b", "cat_c"]
    assert [tuple(r) for r in rows] == [(0, 0), (0, 0), (0, 1)]
    enc = C.encode_like(spark.createDataFrame([("No Preference",)], "p string"), ["p_No_Preference"], ["p"],
                        space_suffix=["p"]).first()
    assert enc[0] == 1
    with pytest.raises(ValueError):
        C.encode_like(new, ["nope"], ["cat"])


def test_risk_grade_boundaries_and_keys(spark):
    df = spark.createDataFrame([(0.39999,), (0.4,), (0.69999,), (0.7,), (None,)], "s double")
    got = [r[0] for r in df.select(FN.risk_grade("s")).collect()]
    assert got == ["retain", "caution", "caution", "high_risk", None]
    keys = spark.createDataFrame([("lightgbm_50_without_PT_Session_Count",), ("knn_full",), ("knn",)], "k string")
    parsed = [tuple(r[0]) for r in keys.select(FN.parse_key("k")).collect()]
    assert parsed == [("lightgbm", "50", "PT_Session_Count"), ("knn", "full", None), ("knn", "full", None)]
    paths = spark.createDataFrame([(r"C:\data\results\roc\x.parquet",), ("data/results/y.parquet",)], "p string")
    assert [r[0] for r in paths.select(FN.artifact_name("p")).collect()] == ["x.parquet", "y.parquet"]


def test_retention_actions_default(spark):
    df = spark.createDataFrame([(1, 5, 10, 1, 5, 1.0, 60), (2, 0, 5, 0, 1, 20.0, 30)],
                               "id long, Late_Payment_Count int, Monthly_Visits int, PT_Session_Count int, "
                               "Group_Class_Attendance int, Avg_Equipment_Wait_Time_Min double, "
                               "Avg_Workout_Duration_Min int")
    acts = {(r["id"], r["position"]): r["action"] for r in G.retention_actions(df, "id").collect()}
    assert acts[(1, 0)] == "payment_support" and (1, 1) not in acts
    assert [acts[(2, i)] for i in range(5)] == ["visit_activation", "pt_trial", "group_class",
                                               "crowding_relief", "workout_routine"]
    none = spark.createDataFrame([(3, 0, 10, 1, 5, 1.0, 60)], df.schema)
    assert G.retention_actions(none, "id").first()["action"] == "relationship_care"


# Stored confusion matrices and their metrics (result records of the reference run).
STORED = [
    ([[103217, 19643], [53822, 23318]], 0.632675, 0.5427713507599916, 0.3022815659839253, 0.3883065086885205),
    ([[103555, 19305], [59071, 18069]], 0.60812, 0.4834644405201477, 0.23423645320197045, 0.3155771346734897),
    ([[104320, 18540], [56016, 21124]], 0.62722, 0.5325736183945139, 0.2738397718434016, 0.36169994178281567),
    ([[103269, 19591], [47710, 29430]], 0.663495, 0.6003549499194223, 0.38151413015296864, 0.4665467141192603),
    ([[109090, 13770], [59061, 18079]], 0.635845, 0.5676473358661183, 0.23436608763287528, 0.3317582508326528),
    ([[104002, 18858], [49053, 28087]], 0.660445, 0.5982958781552881, 0.3641042260824475, 0.4527058065036064),
]


@pytest.mark.parametrize("cm,acc,prec,rec,f1", STORED)
def test_metrics_from_stored_matrices(spark, cm, acc, prec, rec, f1):
    (tn, fp), (fn, tp) = cm
    rows = ([(0, 0.0)] * tn + [(0, 1.0)] * fp + [(1, 0.0)] * fn + [(1, 1.0)] * tp)
    df = spark.createDataFrame(rows, "y int, s double")
    m = E.classification_metrics(df, "y", "s", 0.5).first()
    assert (m["tn"], m["fp"], m["fn"], m["tp"]) == (tn, fp, fn, tp)
    assert m["accuracy"] == pytest.approx(acc, abs=1e-9)
    assert m["precision"] == pytest.approx(prec, abs=1e-9)
    assert m["recall"] == pytest.approx(rec, abs=1e-9)
    assert m["f1"] == pytest.approx(f1, abs=1e-9)


def test_profile_edge_values(spark):
    df = spark.createDataFrame([(1, 1.0, "a", 0), (2, 1.0, None, 1), (2, 1.0, "b", 1), (3, 1.0, "a", 0),
                                (4, 100.0, "a", 1), (5, None, "b", 0)],
                               "id long, x double, c string, y int")
    assert P.duplicate_count(df, ["id"]).first()[0] == 1
    miss = {r["feature"]: r["missing"] for r in P.missing(df).collect()}
    assert miss == {"id": 0, "x": 1, "c": 1, "y": 0}
    out = {r["feature"]: r for r in P.iqr_outliers(df, ["x"]).collect()}["x"]   # zero IQR: 100 is out
    assert out["outlier_count"] == 1 and out["outlier_pct"] == 16.67
    h = P.histogram(df, ["x"], bins=3).orderBy("bin").collect()
    assert [r["n"] for r in h] == [4, 0, 1]
    vc = {(r["feature"], r["value"]): r["n"] for r in P.value_counts(df, ["c"]).collect()}
    assert vc == {("c", "a"): 3, ("c", "b"): 2}
    assert math.isclose(P.imbalance(df, "y").first()["ratio"], 1.0)


def test_best_f1_threshold_empty_input_is_half(spark):
    empty = spark.createDataFrame([], "id long, y int, s double")
    r = E.best_f1_threshold(empty, "y", "s").first()
    assert r["threshold"] == 0.5 and r["f1"] is None


def _sklearn_style_roc(y, s):
    """scikit-learn's roc_curve with drop_intermediate, written out with NumPy."""
    order = np.argsort(-s, kind="mergesort")
    ys, ss = y[order], s[order]
    last = np.r_[np.nonzero(np.diff(ss))[0], len(ss) - 1]     # last index of each distinct score
    tps = np.cumsum(ys)[last]
    fps = (last + 1) - tps
    thr = ss[last]
    if len(fps) > 2:
        keep = np.nonzero(np.r_[True, np.logical_or(np.diff(fps, 2), np.diff(tps, 2)), True])[0]
        fps, tps, thr = fps[keep], tps[keep], thr[keep]
    return {(float(t), f / fps[-1], p / tps[-1]) for t, f, p in zip(thr, fps, tps)}


def test_thinned_roc_curve_matches_sklearn_rule(spark, random_scores, monkeypatch):
    monkeypatch.setattr(O, "GROUP_RANGE_MIN", 10)
    y, s = random_scores
    got = {(r["threshold"], r["fpr"], r["tpr"]) for r in
           E.roc_curve(_scored(spark, y, s), "y", "s", drop_intermediate=True).collect()
           if not math.isinf(r["threshold"])}
    exp = _sklearn_style_roc(np.asarray(y), np.asarray(s))
    assert {(round(a, 9), round(b, 9), round(c, 9)) for a, b, c in got} == \
        {(round(a, 9), round(b, 9), round(c, 9)) for a, b, c in exp}
    full = E.roc_curve(_scored(spark, y, s), "y", "s").count()
    assert len(got) < full - 1


def test_thinned_pr_curve_matches_sklearn_rule(spark, random_scores, monkeypatch):
    monkeypatch.setattr(O, "GROUP_RANGE_MIN", 10)
    y, s = np.asarray(random_scores[0]), np.asarray(random_scores[1])
    order = np.argsort(-s, kind="mergesort")
    ys, ss = y[order], s[order]
    last = np.r_[np.nonzero(np.diff(ss))[0], len(ss) - 1]
    tps = np.cumsum(ys)[last]
    fps = (last + 1) - tps
    thr = ss[last]
    keep = np.nonzero(np.r_[True, np.logical_or(np.diff(tps[:-1]), np.diff(tps[1:])), True])[0]
    exp = {(round(float(t), 9), round(p / (p + f), 9), round(p / tps[-1], 9))
           for t, f, p in zip(thr[keep], fps[keep], tps[keep])}
    got = {(round(r["threshold"], 9), round(r["precision"], 9), round(r["recall"], 9))
           for r in E.pr_curve(_scored(spark, y, s), "y", "s", drop_intermediate=True).collect()
           if r["threshold"] is not None}
    assert got == exp
