"""Versioned result store and result documents."""

import json
import os

import pytest

from churnlab.sources.store import ResultStore, read_documents

SCHEMA = "model_key string, label string, run int, f1 double"


def rows(spark, *xs):
    return spark.createDataFrame(xs, SCHEMA)


def got(df):
    return sorted(((r.model_key, r.label, r.run, r.f1) for r in df.collect()), key=str)


def test_latest_record_wins_whatever_the_order(spark, tmpdir_path):
    st = ResultStore(spark, f"{tmpdir_path}/s", sequence="run")
    assert st.read() is None and st.version == 0
    st.upsert(rows(spark, ("a", "x", 2, 0.2), ("a", "x", 1, 0.9), ("b", "x", None, 0.5), (None, "x", 1, 0.1)))
    out = st.upsert(rows(spark, ("a", "x", 1, 0.8), ("b", "x", 0, 0.4), ("a", "y", 7, 0.3), (None, "x", 2, 0.2)))
    assert got(out) == sorted([("a", "x", 2, 0.2), ("b", "x", 0, 0.4), ("a", "y", 7, 0.3), (None, "x", 2, 0.2)], key=str)
    again = st.upsert(rows(spark, ("a", "x", 2, 0.1)))      # same run again: the later arrival
    assert ("a", "x", 2, 0.1) in got(again) and st.version == 3
    assert ("a", "x", 2, 0.2) in got(st.read(2))


def test_a_reader_sees_old_or_new_at_every_step(spark, tmpdir_path, monkeypatch):
    st = ResultStore(spark, f"{tmpdir_path}/s")
    st.upsert(rows(spark, ("a", "x", 1, 0.1)))
    seen = []
    real = ResultStore._commit

    def watched(self, number, snapshot):
        seen.append(got(ResultStore(spark, st.path).read()))
        ok = real(self, number, snapshot)
        seen.append(got(ResultStore(spark, st.path).read()))
        return ok
    monkeypatch.setattr(ResultStore, "_commit", watched)
    st.upsert(rows(spark, ("a", "x", 2, 0.2)))
    assert seen == [[("a", "x", 1, 0.1)], [("a", "x", 2, 0.2)]]

    def dies(self, number, snapshot):
        raise RuntimeError("lost")
    monkeypatch.setattr(ResultStore, "_commit", dies)
    with pytest.raises(RuntimeError, match="lost"):
        st.upsert(rows(spark, ("a", "x", 3, 0.3)))
    assert got(st.read()) == [("a", "x", 2, 0.2)]
    monkeypatch.setattr(ResultStore, "_commit", real)
    # a commit that its writer has not finished is none yet
    open(f"{st.path}/_commits/000000000003", "w").write('{"snapshot": "snap')
    assert st.version == 2 and got(st.read()) == [("a", "x", 2, 0.2)]


def test_two_writers_lose_nothing(spark, tmpdir_path, monkeypatch):
    a, b = (ResultStore(spark, f"{tmpdir_path}/s") for _ in range(2))
    a.upsert(rows(spark, ("a", "x", 1, 0.1)))
    real, first = ResultStore._commit, []

    def slow(self, number, snapshot):
        if not first:
            first.append(1)
            b.upsert(rows(spark, ("b", "x", 1, 0.2)))       # the other one commits meanwhile
        return real(self, number, snapshot)
    monkeypatch.setattr(ResultStore, "_commit", slow)
    a.upsert(rows(spark, ("c", "x", 1, 0.3)))
    assert [r[0] for r in got(a.read())] == ["a", "b", "c"] and a.version == 3
    assert a.vacuum(1) == 2 and [r[0] for r in got(a.read())] == ["a", "b", "c"]
    with pytest.raises(ValueError, match="version 1"):
        a.read(1)


def test_documents_of_all_shapes(spark, tmpdir_path):
    flat = {"model_key": "knn", "model_name": "KNN", "experiment": {"feature_set": "full"}, "total_samples": 10,
            "confusion_matrix": [[1, 2], [3, 4]], "auc_score": 0.5}
    new = {"model_key": "lgbm", "accuracy": 0.7, "f1_score": 0.4, "avg_latency_ms": 0.01, "confusion_matrix": [[5, 0], [0, 5]],
           "experiment": {"dataset": "50", "excluded_feature": None}, "total_samples": "ten"}
    whole = {"results": {"xgb": {"full": {"model": "XGB", "performance": {"total_samples": 8, "avg_latency_ms": 1.5},
                                          "confusion_matrix": [[2, 2], [2, 2]], "test_metrics": {"accuracy": 0.5, "f1": 0.5}},
                                 "half": {"confusion_matrix": [[1, 1]]}}}, "updated_at": "x"}
    texts = {"a": json.dumps(flat, indent=4), "b": json.dumps(new, indent=1), "c": json.dumps(whole, indent=2), "d": "{broken",
             "e": "[1, 2]", "f": json.dumps({"confusion_matrix": [[1, 1], [1, 1]]}), "g": ""}
    for name, t in texts.items():
        with open(os.path.join(tmpdir_path, f"{name}.json"), "w") as f:
            f.write(t)
    rows = {(r.file.split("/")[-1][0], r.label): r for r in read_documents(spark, f"{tmpdir_path}/*.json").collect()}
    a, b, x, h = rows["a", None], rows["b", None], rows["c", "full"], rows["c", "half"]
    assert (a.model_key, a.dataset, a.tp, a.accuracy, a.roc_auc, a.error) == ("knn", "full", 4, None, 0.5, None)
    assert (b.dataset, b.f1, b.latency_ms, b.total_samples, b.error) == ("50", 0.4, 0.01, None, None)
    assert (x.model_key, x.model_name, x.accuracy, x.latency_ms, x.total_samples) == ("xgb", "XGB", 0.5, 1.5, 8)
    assert h.model_key == "xgb" and h.error == "no confusion matrix of two classes"
    assert rows["d", None].error == "not a JSON document" and rows["e", None].error == rows["f", None].error == "no model_key"
