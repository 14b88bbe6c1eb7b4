"""Properties of splits, sources / sinks, models and streaming."""

import json
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from churnlab.operators import evaluate as E
from churnlab.operators import models as M
from churnlab.operators import splits as D
from churnlab.operators.knn import KNNClassifier
from churnlab.plans import members as MB
from churnlab.sources import files as A
from conftest import SF_MID, SF_SMALL


@pytest.fixture(scope="module")
def planted_mid(spark):
    return MB.with_planted(MB.members(spark, SF_MID)).cache()


def test_split_exact_per_class_and_stable(spark, planted_mid):
    a = D.stratified_split(planted_mid, "member_id", "churn", 0.2, 42)
    b = D.stratified_split(planted_mid.repartition(7), "member_id", "churn", 0.2, 42)
    ja = {r["member_id"]: r["split"] for r in a.select("member_id", "split").collect()}
    jb = {r["member_id"]: r["split"] for r in b.select("member_id", "split").collect()}
    assert ja == jb
    per = a.groupBy("churn").agg(F.count(F.lit(1)).alias("n"),
                                 F.count(F.when(F.col("split") == "test", 1)).alias("t")).collect()
    for r in per:
        assert r["t"] == int(np.floor(r["n"] * 0.2 + 0.5))
    three = D.three_way_split(planted_mid, "member_id", "churn", 0.2, 0.25, 42)
    assert three.count() == planted_mid.count()
    assert {r[0] for r in three.select("split").distinct().collect()} == {"train", "validation", "test"}


def test_even_sample_quota_and_bound(spark, planted_mid):
    s = D.even_sample(planted_mid, "member_id", max_rows=500, chunk=200)
    assert s.count() == 500
    assert D.even_sample(planted_mid, "member_id", max_rows=10_000).count() == planted_mid.count()


def test_kfold_and_undersample(spark, planted_mid):
    folds = D.kfold(planted_mid, "member_id", "churn", 5).groupBy("fold").count().collect()
    sizes = sorted(r["count"] for r in folds)
    assert len(sizes) == 5 and sizes[-1] - sizes[0] <= 2
    u = D.undersample(planted_mid, "member_id", "churn").groupBy("churn").count().collect()
    assert len({r["count"] for r in u}) == 1


def test_csv_reader_nulls_pandas_tokens(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "m.csv")
    with open(path, "w") as f:
        f.write("id,name,score\n1,None,1.5\n2,NA,NA\n3,,2\n4,\"x, y\",3\n")
    df = A.read_members(spark, path, schema="id long, name string, score double")
    rows = {r["id"]: (r["name"], r["score"]) for r in df.collect()}
    assert rows == {1: (None, 1.5), 2: (None, None), 3: (None, 2.0), 4: ("x, y", 3.0)}
    assert A.read_members(spark, path, schema="id long, name string, score double", columns=["id"],
                          limit=2).count() == 2


def test_read_results_heterogeneous_records(spark, tmpdir_path):
    from churnlab.plans.q_sources import write_record_files
    new = {"model_key": "lightgbm_50", "accuracy": 0.66, "pr_auc": 0.57, "auc_score": 0.69,
           "confusion_matrix": [[1, 2], [3, 4]], "experiment": {"dataset": "50", "feature_count": 11}}
    old = {"model_key": "knn", "auc_score": 0.59, "confusion_matrix": [[5, 6], [7, 8]],
           "experiment": {"comparison_axis": "feature_set", "feature_set": "full"}}
    write_record_files(tmpdir_path, [new, old])
    got = {r["model_key"]: r for r in A.read_results(spark, os.path.join(tmpdir_path, "*_results.json")).collect()}
    assert got["knn"]["accuracy"] is None and got["knn"]["pr_auc"] is None
    assert got["lightgbm_50"]["confusion_matrix"][1][1] == 4
    assert got["lightgbm_50"]["experiment"]["feature_count"] == 11


def test_upsert_is_idempotent(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "results")
    new = spark.createDataFrame([("a", "x", 0.1), ("b", "x", 0.2)], "model_key string, label string, f1 double")
    A.upsert(spark, path, new)
    upd = spark.createDataFrame([("a", "x", 0.9), ("a", "y", 0.3)], new.schema)
    A.upsert(spark, path, upd)
    once = sorted(tuple(r) for r in A.upsert(spark, path, upd).collect())
    assert once == sorted([("a", "x", 0.9, 1), ("a", "y", 0.3, 1), ("b", "x", 0.2, 1)])


def test_logistic_on_planted_label_and_reload(spark, planted_mid, tmpdir_path):
    df = D.stratified_split(planted_mid, "member_id", "planted", 0.2, 42)
    spec = M.ModelSpec("logistic", "logistic", {"C": 1.0, "maxIter": 200})
    model = M.fit(spec, df, ["visits", "returns", "urgent", "fee"], ["pref"], "planted", fit_where="split = 'train'")
    test = df.filter("split = 'test'")
    sc = M.score(model, test, keep=["member_id", F.col("planted").alias("y")])
    auc = E.roc_auc(sc, "y", "y_score").first()[0]
    assert auc > 0.65
    path = A.save_model(model, os.path.join(tmpdir_path, "lr"))
    again = M.score(A.load_model(path), test, keep=["member_id"]).withColumnRenamed("y_score", "s2")
    j = sc.join(again, "member_id").agg(F.max(F.abs(F.col("y_score") - F.col("s2")))).first()[0]
    assert j < 1e-12
    imp = M.importances(model, k=3).collect()
    assert len(imp) == 3


def _brute_knn(train, query, feats, k, weights):
    out = {}
    X = train[feats].to_numpy(float)
    for _, q in query.iterrows():
        d = np.sqrt(((X - q[feats].to_numpy(float)) ** 2).sum(axis=1))
        order = np.lexsort((train["id"].to_numpy(), d))[:k]
        y, dd = train["y"].to_numpy(float)[order], d[order]
        if weights == "distance":
            z = dd == 0
            out[q["id"]] = y[z].mean() if z.any() else (y / dd).sum() / (1 / dd).sum()
        else:
            out[q["id"]] = y.mean()
    return out


@pytest.mark.parametrize("weights", ["uniform", "distance"])
def test_knn_blocks_match_brute_force(spark, weights):
    rng = np.random.default_rng(17)
    tr = pd.DataFrame({"id": np.arange(300, dtype="int64"), "a": rng.integers(0, 4, 300).astype(float),
                       "b": rng.integers(0, 3, 300).astype(float), "y": rng.integers(0, 2, 300)})
    qu = pd.DataFrame({"id": np.arange(1000, 1040, dtype="int64"), "a": rng.integers(0, 4, 40).astype(float),
                       "b": rng.integers(0, 3, 40).astype(float)})
    knn = KNNClassifier(["a", "b"], "y", "id", k=7, weights=weights, block_rows=64, query_rows=16)
    got = {r["id"]: r["knn_score"] for r in knn.fit(spark.createDataFrame(tr))
           .transform(spark.createDataFrame(qu)).collect()}
    exp = _brute_knn(tr, qu, ["a", "b"], 7, weights)
    assert set(got) == set(exp)
    for k in exp:
        assert got[k] == pytest.approx(exp[k], abs=1e-12)


def test_streaming_scoring_and_monitor(spark, tmpdir_path, planted_mid):
    from churnlab.streaming.monitor import event_activity
    from churnlab.streaming.scoring import start_scoring
    df = D.stratified_split(planted_mid, "member_id", "planted", 0.2, 42)
    model = M.fit(M.ModelSpec("logistic", "logistic", {"maxIter": 50}), df, ["visits", "returns"], [],
                  "planted", fit_where="split = 'train'")
    src = os.path.join(tmpdir_path, "in")
    df.select("member_id", "visits", "returns").repartition(3).write.parquet(src)
    schema = spark.read.parquet(src).schema
    q = start_scoring(spark, model, src, schema, os.path.join(tmpdir_path, "out"),
                      os.path.join(tmpdir_path, "chk"), "member_id", 0.5)
    q.awaitTermination(120)
    out = spark.read.parquet(os.path.join(tmpdir_path, "out"))
    assert out.count() == df.count()

    ev_schema = spark.read.parquet(f"{SF_SMALL}/events.parquet").schema
    stream = spark.readStream.schema(ev_schema).option("pathGlobFilter", "events.parquet").parquet(SF_SMALL)
    agg = event_activity(stream, window="1 day", watermark="0 seconds")
    mq = (agg.writeStream.format("memory").queryName("activity_t").outputMode("append")
          .trigger(availableNow=True).start())
    mq.awaitTermination(120)
    got = spark.sql("SELECT sum(events) FROM activity_t").first()[0]
    batch = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    last_day = batch.agg(F.max(F.to_date("ts"))).first()[0]
    expected = batch.filter(F.to_date("ts") < F.lit(last_day)).count()
    assert got is not None and got >= expected


def test_evaluation_sweep_writes_scores_and_records(spark, tmpdir_path):
    from churnlab.plans.sweep import evaluation_sweep
    spec = M.ModelSpec("logistic", "logistic", {"maxIter": 50})
    res = evaluation_sweep(spark, SF_SMALL, [spec], {"full": ["visits", "returns", "urgent"]},
                           tmpdir_path, exclude=(None, "returns", "absent_feature"))
    rows = {r["model_key"]: r for r in res.collect()}
    assert set(rows) == {"logistic_full", "logistic_full_without_returns"}
    assert rows["logistic_full"]["excluded_feature"] is None
    assert rows["logistic_full_without_returns"]["excluded_feature"] == "returns"
    assert all(r["total"] == 30 for r in rows.values())          # 20 % of 150 members
    scores = spark.read.parquet(os.path.join(tmpdir_path, "scores"))
    assert scores.count() == 60


def test_sweep_reuses_saved_models_and_runs_in_parallel(spark, tmpdir_path):
    df = D.stratified_split(MB.with_planted(MB.members(spark, SF_SMALL)), "member_id", "planted", 0.2, 42)
    spec = M.ModelSpec("logistic", "logistic", {"maxIter": 30})
    ds = {"full": ["visits", "returns"]}
    a = M.sweep([spec], df, ds, "member_id", "planted", exclude=(None, "returns"),
                model_dir=tmpdir_path, parallel=2)
    first = sorted((r["model_key"], r["member_id"], r["y_score"]) for r in a.collect())
    saved = sorted(os.listdir(tmpdir_path))
    assert len(saved) == 2
    b = M.sweep([spec], df, ds, "member_id", "planted", exclude=(None, "returns"), model_dir=tmpdir_path)
    second = sorted((r["model_key"], r["member_id"], r["y_score"]) for r in b.collect())
    assert first == second and sorted(os.listdir(tmpdir_path)) == saved


def test_score_drift_stream_matches_batch(spark, tmpdir_path, planted_mid):
    from churnlab.streaming.monitor import run_to_table, score_drift
    rows = (planted_mid.filter(F.col("start_date").isNotNull())
            .select("member_id", F.col("score").alias("churn_probability"),
                    F.col("start_date").cast("timestamp").alias("ts")))
    src = os.path.join(tmpdir_path, "scored")
    rows.repartition(4).write.parquet(src)
    # one micro-batch: with files in random time order, later batches would hold events
    # behind the watermark, which Structured Streaming drops as late (by design)
    stream = spark.readStream.schema(rows.schema).parquet(src)
    drift = score_drift(stream, "ts", threshold=0.5, window="30 days", watermark="0 seconds")
    got = run_to_table(drift, os.path.join(tmpdir_path, "chk"), "drift_t")
    # append mode emits every window that closed before the last event
    batch = rows.withColumn("w", F.window("ts", "30 days")).filter(
        F.col("w.end") <= rows.agg(F.max("ts")).first()[0])
    exp = {r["ws"]: (r["n"], r["m"]) for r in batch.groupBy(F.col("w.start").alias("ws")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("churn_probability").alias("m")).collect()}
    out = {r["window_start"]: (r["members"], r["mean_score"]) for r in got.collect()}
    assert set(out) == set(exp)
    for k, (n, m) in exp.items():
        assert out[k][0] == n and out[k][1] == pytest.approx(m)


def test_deployment_features_in_a_saved_pipeline(spark, tmpdir_path, planted_mid):
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from churnlab.operators.features import DeploymentFeatures, MedianImputer
    raw = planted_mid.select("member_id", F.col("visits").cast("string").alias("visits"),
                             F.col("returns").cast("string").alias("returns"), "start_date", "pref",
                             F.col("planted").cast("double").alias("label"))
    feats = ["visits", "returns", "start_year", "start_days", "pref_none"]
    stage = DeploymentFeatures(numericCols=["visits", "returns"], dateCol="start_date",
                               referenceDate="2001-01-31", flags=json.dumps([["pref", "none", "none", "pref_none"]]),
                               outputCols=feats, keepCols=["member_id", "label"])
    # MLlib solvers reject NaN features: impute (the reference's boosting model took NaN natively)
    pipe = Pipeline(stages=[stage, MedianImputer(feats[:4]),
                            VectorAssembler(inputCols=feats, outputCol="features", handleInvalid="keep"),
                            LogisticRegression(maxIter=30)])
    model = pipe.fit(raw)
    path = os.path.join(tmpdir_path, "deploy")
    model.write().overwrite().save(path)
    again = PipelineModel.load(path)
    a = {r["member_id"]: r["probability"][1] for r in model.transform(raw).collect()}
    b = {r["member_id"]: r["probability"][1] for r in again.transform(raw).collect()}
    assert a == b
    with pytest.raises(ValueError):
        again.transform(raw.drop("pref"))


@pytest.mark.parametrize("spec", [
    M.ModelSpec("randomforest", "randomforest", {"numTrees": 15, "maxDepth": 5, "minInstancesPerNode": 20,
                                                  "featureSubsetStrategy": "sqrt"}),
    M.ModelSpec("xgboost", "gbt", {"maxIter": 15, "maxDepth": 3, "stepSize": 0.1, "subsamplingRate": 0.8}),
    M.ModelSpec("mlp", "mlp", {"hidden": [16, 8], "maxIter": 60}),
    M.ModelSpec("knn", "knn", {"k": 15, "weights": "distance"}),
], ids=lambda s: s.name)
def test_models_learn_the_planted_signal(spark, planted_mid, spec):
    from churnlab.operators.features import ExactStandardScaler
    feats = ["visits", "returns", "urgent"]
    df = D.stratified_split(planted_mid.fillna(0, feats), "member_id", "planted", 0.2, 42)
    # models see the standardized feature table, as in the reference (scaler fitted on train rows)
    df = ExactStandardScaler(feats, fitWhere="split = 'train'").fit(df).transform(df)
    sc = M.sweep([spec], df, {"full": feats}, "member_id", "planted")
    auc = E.roc_auc(sc, "y_true", "y_score").first()[0]
    assert sc.count() == df.filter("split = 'test'").count()
    # KNN is the weakest learner here, as in the reference (0.61 vs 0.69 ROC-AUC there);
    # its exactness is checked against brute force and the DuckDB twin
    assert auc > (0.55 if spec.kind == "knn" else 0.6)


# The reference's processed feature layout (22 features, in order).
PROCESSED_FEATURES = [
    "Age", "Monthly_Visits", "Avg_Workout_Duration_Min", "Group_Class_Attendance", "PT_Session_Count",
    "Avg_Equipment_Wait_Time_Min", "Late_Payment_Count", "Start_Year", "Start_Month", "Start_Weekday",
    "Membership_Days", "Cardio_Preference_Elliptical", "Cardio_Preference_No Preference",
    "Cardio_Preference_Rowing", "Cardio_Preference_Treadmill", "Supplement_Usage_Full Stack",
    "Supplement_Usage_No Protein Supplements", "Supplement_Usage_Pre-Workout", "Supplement_Usage_Whey Protein",
    "Profile_Type_Drop-out", "Profile_Type_Hardcore", "Profile_Type_Regular",
]


def _raw_member_csv(path):
    """40 members in the raw 19-column layout, values from a fixed rule; missing
    categories written as the token None, treadmill fields as NA."""
    import datetime as dt
    head = ("Member_ID,Age,Gender,Membership_Type,Membership_Start_Date,Monthly_Fee,Monthly_Visits,"
            "Avg_Workout_Duration_Min,Peak_Hour_Preference,Cardio_Preference,Treadmill_Avg_Speed_Kmh,"
            "Treadmill_Avg_Incline_Pct,Group_Class_Attendance,PT_Session_Count,Supplement_Usage,"
            "Avg_Equipment_Wait_Time_Min,Late_Payment_Count,Profile_Type,Churn")
    cardio = ["None", "Treadmill", "Cycling", "Elliptical", "Rowing"]
    supp = ["None", "Whey Protein", "Pre-Workout", "Creatine", "Full Stack"]
    prof = ["Casual", "Regular", "Drop-out", "Hardcore"]
    lines = [head]
    for i in range(40):
        day = dt.date(2023, 5, 1) + dt.timedelta(days=(i * 13) % 400)
        tread = ("NA", "NA") if cardio[i % 5] != "Treadmill" else (f"{8 + i % 5}.5", f"{i % 7}.0")
        lines.append(",".join(str(v) for v in [
            1000 + i, 16 + (i * 7) % 60, ["Female", "Male"][i % 2], ["Standard", "Gold", "Premium", "VIP"][i % 4],
            day.isoformat(), f"{20.89 + i:.2f}", i % 29, (i * 9) % 121, ["Morning", "Evening"][i % 2],
            cardio[i % 5], *tread, i % 13, (i * 5) % 9 if i % 3 else 0, supp[(i // 2) % 5],
            f"{(i * 3.7) % 25:.1f}", i % 7, prof[i % 4], int(i % 3 == 0)]))
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def test_reference_preprocessing_layout_on_the_raw_schema(spark, tmpdir_path):
    from churnlab.plans.preprocess import RAW_ROBUST, RAW_STANDARD, preprocess_member_file
    path = os.path.join(tmpdir_path, "members.csv")
    _raw_member_csv(path)
    raw = A.read_members(spark, path)
    assert raw.filter(F.col("Cardio_Preference").isNull()).count() == 8     # the None tokens
    out = preprocess_member_file(raw)
    feats = [c for c in out.columns if c not in ("Member_ID", "Churn", "split")]
    assert feats == PROCESSED_FEATURES
    pdf = out.toPandas()
    train = pdf[pdf["split"] == "train"]
    assert len(pdf[pdf["split"] == "test"]) == round(0.2 * 14) + round(0.2 * 26)
    for c in RAW_STANDARD:
        assert abs(train[c].mean()) < 1e-9 and abs(train[c].std(ddof=0) - 1) < 1e-9
    for c in RAW_ROBUST:
        assert abs(train[c].median()) < 1e-12


def test_deployment_stage_on_the_raw_schema(spark, tmpdir_path):
    from churnlab.operators.features import DEPLOYMENT_FEATURES, deployment_stage
    path = os.path.join(tmpdir_path, "members.csv")
    _raw_member_csv(path)
    raw = A.read_members(spark, path, schema=", ".join(
        f"{f.name} string" for f in A.MEMBER_SCHEMA.fields))          # raw text inputs, as a form sends
    raw = raw.withColumn("Age", F.when(F.col("Member_ID") == "1003", F.lit("n/a")).otherwise(F.col("Age")))
    out = deployment_stage("2024-01-01").transform(raw)
    assert out.columns == ["Member_ID", *DEPLOYMENT_FEATURES]
    rows = {r["Member_ID"]: r for r in out.collect()}
    assert rows["1003"]["Age"] is None                                   # bad text -> null
    assert min(r["Membership_Days"] for r in rows.values()) == 0          # dates after the reference floor at 0
    assert rows["1000"]["Cardio_Preference_Rowing"] == 0 and rows["1004"]["Cardio_Preference_Rowing"] == 1
    assert rows["1000"]["Supplement_Usage_No Protein Supplements"] == 1  # missing counts as none


def test_early_stopping_by_patience_repeats_the_trees(spark, planted_mid):
    from churnlab.session import materialize
    feats = ["visits", "returns", "urgent"]
    df = D.three_way_split(planted_mid, "member_id", "planted", 0.2, 0.2, 42)
    spec = M.ModelSpec("xgboost", "gbt", {"maxIter": 25, "maxDepth": 3, "stepSize": 0.3, "subsamplingRate": 0.8})
    model, rounds = M.fit_early_stopped(spec, df, feats, [], "planted",
                                        "split = 'train'", "split = 'validation'", patience=3)
    assert 1 <= rounds <= 25 and len(model.stages[-1].trees) == rounds
    # on the same written input, a shorter fit repeats the first trees of a longer one
    base = materialize(df.filter("split = 'train'").select(*feats, "planted"))
    long_ = M.fit(spec, base, feats, [], "planted", checkpoint=False)
    short = M.fit(M.ModelSpec("x", "gbt", {**spec.params, "maxIter": 7}), base, feats, [], "planted",
                  checkpoint=False)

    def body(t):
        return t.toDebugString.split("\n", 1)[1]
    assert [body(t) for t in long_.stages[-1].trees[:7]] == [body(t) for t in short.stages[-1].trees]
    sc = M.score(model, df.filter("split = 'test'"), keep=[F.col("planted").alias("y")])
    assert E.roc_auc(sc, "y", "y_score").first()[0] > 0.6


def test_knn_even_sample_bounds_the_reference_rows(spark, planted_mid):
    df = D.stratified_split(planted_mid.fillna(0, ["returns"]), "member_id", "planted", 0.2, 42)
    train = df.filter("split = 'train'")
    knn = KNNClassifier(["visits", "returns"], "planted", "member_id", k=5, max_rows=300)
    model = knn.fit(train)
    assert len(model.rows) == 300
    sample_ids = set(model.rows["member_id"])
    expected = {r[0] for r in D.even_sample(train, "member_id", 300).select("member_id").collect()}
    assert sample_ids == expected
    assert model.transform(df.filter("split = 'test'")).count() == df.filter("split = 'test'").count()


def test_knn_fills_nulls_with_the_median(spark):
    train = spark.createDataFrame([(1, 0.0, 0), (2, 2.0, 1), (3, 10.0, 1), (4, None, 1)], "id long, a double, y int")
    query = spark.createDataFrame([(9, None), (10, 0.1)], "id long, a double")
    got = {r.id: r.knn_score for r in KNNClassifier(["a"], "y", "id", k=2).fit(train).transform(query).collect()}
    assert got == {9: 1.0, 10: 0.5}        # the median is 2: rows 2 and 4; then rows 1 and 2


def test_knn_searches_all_rows_beyond_30000(spark):
    # one row in 16 is of class 1; queries lie on such rows, which an even sample of 30,000 mostly drops
    n = 36_000
    train = spark.range(n).select(F.col("id"), F.col("id").cast("double").alias("a"), (F.col("id") % 16 == 0).cast("int").alias("y"))
    query = spark.range(0, n, 160).select((F.col("id") + n).alias("id"), F.col("id").cast("double").alias("a"))
    got = KNNClassifier(["a"], "y", "id", k=1).fit(train).transform(query).collect()
    assert len(got) == n // 160 and all(r.knn_score == 1.0 for r in got)


def test_sweep_knn_searches_all_rows_beyond_30000(spark):
    n = 36_000
    a = F.col("id").cast("double")
    train = spark.range(n).select("id", a.alias("a"), (F.floor(F.col("id") / 10) % 2).cast("int").alias("y"), F.lit("train").alias("split"))
    test = spark.range(0, n, 400).select((F.col("id") + n).alias("id"), (a + 4.5).alias("a"),
                                         (F.floor(F.col("id") / 10) % 2).cast("int").alias("y"), F.lit("test").alias("split"))
    got = M.sweep([M.REFERENCE_SPECS["knn"]], train.unionByName(test), {"full": ["a"]}, "id", "y").collect()
    # the ten nearest rows of a query are its own run of ten rows with one label
    assert len(got) == n // 400 and all(r.y_score == r.y_true for r in got)


@pytest.mark.parametrize("weights", ["uniform", "distance"])
def test_knn_cells_keep_ties_nulls_and_repeated_ids(spark, weights):
    rng = np.random.default_rng(5)
    tr = [(None if i % 97 == 0 else int(i % 700), float(rng.integers(0, 6)), float(rng.integers(0, 6)) if i % 11 else None,
           float(rng.normal()) if i % 3 else 0.0, int(rng.integers(0, 2))) for i in range(900)]
    qu = [(int(i % 150), float(rng.integers(-2, 8)), float(rng.integers(-2, 8)) if i % 7 else None,
           float(rng.normal()) if i % 3 else 0.0) for i in range(200)] + [(900, float("nan"), 1.0, 0.0)]
    fit = KNNClassifier(["a", "b", "c"], "y", "id", k=6, weights=weights, block_rows=50, query_rows=8, task_rows=40).fit(
        spark.createDataFrame(tr, "id long, a double, b double, c double, y int").repartition(5))
    assert fit.cuts.cells > 4
    got = fit.transform(spark.createDataFrame(qu, "id long, a double, b double, c double").repartition(3)).collect()
    mid = float(np.median([r[2] for r in tr if r[2] is not None]))

    def score(q):
        if np.isnan(q[1]):
            near = [(np.inf, r[0] is None, r[0] or 0, r[4]) for r in tr]
        else:
            x = [q[1], mid if q[2] is None else q[2], q[3]]
            near = [((x[0] - r[1]) ** 2 + (x[1] - (mid if r[2] is None else r[2])) ** 2 + (x[2] - r[3]) ** 2,
                     r[0] is None, r[0] or 0, r[4]) for r in tr]
        near = sorted(near)[:6]
        d2, y = np.array([[r[0] for r in near]]), np.array([[float(r[3]) for r in near]])
        if weights == "uniform":
            return y.mean()
        if (d2 == 0).any():
            return y[d2 == 0].mean()
        w = 1 / np.sqrt(d2)
        return (w * y).sum() / w.sum() if w.sum() else np.nan

    expected = sorted((q[0], round(score(q), 9)) for q in qu)
    np.testing.assert_allclose(np.array(sorted((r.id, round(r.knn_score, 9)) for r in got)), np.array(expected), atol=1e-8)


def test_knn_without_training_or_query_rows(spark):
    t = spark.createDataFrame([(1, 1.0, 1)], "id long, a double, y int")
    none = KNNClassifier(["a"], "y", "id", k=2).fit(t.filter("id > 1")).transform(t).collect()
    assert [r.id for r in none] == [1] and np.isnan(none[0].knn_score)
    fit = KNNClassifier(["a"], "y", "id", k=2).fit(t)
    assert fit.transform(t.filter("id > 1")).collect() == []
    assert [tuple(r) for r in fit.transform(t).collect()] == [(1, 1.0)]         # fewer rows than k

def test_stream_query_counts_every_event_of_a_folder(spark, tmpdir_path):
    import __spark_entry__ as entry
    src = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    src.repartition(4).write.parquet(f"{tmpdir_path}/events.parquet")
    run = entry.queries()["h10_stream_event_activity"]
    a, b = (sorted(map(tuple, run(spark, d).collect())) for d in (tmpdir_path, SF_SMALL))
    assert a == b and sum(r[3] for r in a) == src.count()
