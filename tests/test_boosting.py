"""Early stopping on average precision against a loop over separate scorings."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from churnlab.operators import boosting as B
from churnlab.operators import evaluate as E
from churnlab.operators import models as M

NUM = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    rnd = np.random.default_rng(3)
    rows = []
    for i in range(900):
        a, b, c = rnd.normal(0, 1, 3)
        y = int(a + 0.5 * b * b + rnd.normal(0, 1.2) > 0.4)
        rows.append((i, float(round(a, 2)), None if i % 11 == 0 else float(round(b, 2)), float(round(c, 1)),
                     ["u", "v", None][i % 3], y, "validation" if i % 4 == 0 else "train"))
    return spark.createDataFrame(rows, "id long, a double, b double, c double, g string, y int, split string").repartition(3).cache()


def brute_ap(y, s):
    order = sorted(set(s), reverse=True)
    P, out, last = sum(y), 0.0, 0.0
    for cut in order:
        tp = sum(1 for a, b in zip(y, s) if b >= cut and a)
        n = sum(1 for b in s if b >= cut)
        out += (tp / P - last) * tp / n
        last = tp / P
    return out


@pytest.fixture(scope="module")
def fitted(data):
    spec = M.ModelSpec("x", "gbt", {"maxIter": 24, "maxDepth": 3, "stepSize": 0.3, "subsamplingRate": 0.8})
    return M.fit(spec, data, NUM, ["g"], "y", fit_where="split = 'train'")


def assembled(model, df):
    for st in model.stages[:-1]:
        df = st.transform(df)
    return df.select("id", "y", "features")


def test_average_precision_of_every_round(data, fitted):
    gbt = fitted.stages[-1]
    valid = assembled(fitted, data.filter("split = 'validation'"))
    got = {r["round"]: r.pr_auc for r in B.round_average_precision(gbt, valid, "y").collect()}
    assert sorted(got) == list(range(1, 25))
    for k in (1, 2, 7, 24):
        rows = B.truncate(gbt, k).transform(valid).select("y", F.round(vector_to_array("probability")[1], 6).alias("s")).collect()
        assert got[k] == pytest.approx(brute_ap([r.y for r in rows], [r.s for r in rows]), abs=1e-9)
    later = {r["round"]: r.pr_auc for r in B.round_average_precision(gbt, valid, "y", first=20).collect()}
    assert later == {k: pytest.approx(v) for k, v in got.items() if k >= 20}


def test_histograms_handed_on_early_are_the_same(data, fitted, monkeypatch):
    valid = assembled(fitted, data.filter("split = 'validation'"))
    whole = set(B.round_histograms(fitted.stages[-1], valid, "y").collect())
    monkeypatch.setattr(B, "HISTOGRAM_ROWS", 10)
    assert set(B.round_histograms(fitted.stages[-1], valid.repartition(5), "y").collect()) == whole
    assert B.round_histograms(fitted.stages[-1], valid.limit(0), "y").collect() == []


def test_patience_rule():
    assert B.patience_rule([.1, .3, .2, .3, .25], 3) == (2, True)
    assert B.patience_rule([.1, .3, .2, .3], 3) == (2, False)
    assert B.patience_rule([.5, .4, .6, .1, .1], 2) == (3, True)
    assert B.patience_rule([], 2) == (0, False)


def test_chosen_round_equals_a_loop(data, fitted):
    from churnlab.session import materialize
    spec = M.ModelSpec("x", "gbt", {"maxIter": 32, "maxDepth": 3, "stepSize": 0.3, "subsamplingRate": 0.8})
    label = F.col("y").cast("double").alias("y")
    train = materialize(assembled(fitted, data.filter("split = 'train'")).select("features", label), "t")
    valid = materialize(assembled(fitted, data.filter("split = 'validation'")), "v")
    clf = M._classifier(spec, 0, 0, "y", 42)
    model, rounds, values = B.fit_by_average_precision(clf, train, valid, "y", patience=4, first=4)
    assert model.getNumTrees == rounds and len(values) in (4, 8, 16, 32)
    whole, aps = clf.fit(train), []      # every prefix of one long fit, scored on its own
    for k in range(1, 33):
        s = B.truncate(whole, k).transform(valid).select("y", F.round(vector_to_array("probability")[1], 6).alias("s"))
        aps.append(round(E.average_precision(s, "y", "s").first().pr_auc, 12))
        if B.patience_rule(aps, 4)[1]:
            break
    assert rounds == B.patience_rule(aps, 4)[0] and values[:len(aps)] == pytest.approx(aps, abs=1e-9)


def test_stopped_pipeline_is_saved_and_scores_alike(data, tmpdir_path):
    from churnlab.sources import files as A
    spec = M.ModelSpec("x", "gbt", {"maxIter": 6, "maxDepth": 3, "stepSize": 0.3, "scale_pos_weight": 3.0})
    model, rounds = M.fit_early_stopped(spec, data, NUM, ["g"], "y", "split = 'train'", "split = 'validation'", patience=3)
    assert model.stages[-1].getNumTrees == rounds <= 6 and model.stages[-1].getWeightCol() == "_w"
    path = A.save_model(model, f"{tmpdir_path}/m")
    a, b = (M.score(m, data, ["id"]).orderBy("id").collect() for m in (model, A.load_model(path)))
    assert a == b and len(M.importances(model).collect()) > 3


def test_histograms_are_written_before_the_running_counts(data, fitted):
    valid = assembled(fitted, data.filter("split = 'validation'"))
    out = B.round_average_precision(fitted.stages[-1], valid, "y")
    assert "MapInArrow" not in out._jdf.queryExecution().optimizedPlan().toString()     # every row is scored once
