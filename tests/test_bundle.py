"""Scoring bundles, the trainer flow and the grid search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlab.operators import bundle as B
from churnlab.operators import evaluate as E
from churnlab.operators import models as M
from churnlab.operators import splits as D
from churnlab.sources import files as A

NUM, CAT = ["a", "b"], ["g"]
SPEC = M.ModelSpec("logistic", "logistic", {"C": 1.0, "maxIter": 100})


@pytest.fixture(scope="module")
def data(spark):
    rnd = np.random.default_rng(2)
    rows = []
    for i in range(600):
        a, b = rnd.normal(0, 1, 2)
        rows.append((i, float(round(a, 3)), None if i % 9 == 0 else float(round(b, 3)), ["u", "v", None][i % 3],
                     int(a - b + rnd.normal() > 0)))
    df = spark.createDataFrame(rows, "id long, a double, b double, g string, y int")
    return D.three_way_split(df, "id", "y", 0.2, 0.25).cache()


def test_trainer_chooses_on_validation_and_judges_on_test(spark, data, tmpdir_path):
    made, record = B.train(SPEC, data, "id", "y", NUM, CAT, reference_date="2024-05-01", model_key="lr_full", standard=["a"], robust=["b"])
    r = record.first()
    loaded = A.load_model(A.save_model(made, f"{tmpdir_path}/bundle"))
    decide = loaded.stages[-1]
    assert (decide.getOrDefault(decide.referenceDate), decide.getOrDefault(decide.modelKey)) == ("2024-05-01", "lr_full")
    assert r.model_key == "lr_full" and decide.getOrDefault(decide.threshold) == pytest.approx(r.threshold)
    valid = B.decide(loaded, data.filter("split = 'validation'"), "id", ["y"])
    assert E.best_f1_threshold(valid, "y", "churn_probability").first().threshold == pytest.approx(r.threshold, abs=1e-9)
    test = B.decide(loaded, data.filter("split = 'test'"), "id", ["y"]).collect()
    assert r.tp == sum(x.y and x.churn_decision for x in test) and r.total == len(test) == 120
    assert sorted(test) == sorted(B.decide(made, data.filter("split = 'test'"), "id", ["y"]).collect())
    # test rows change neither the model nor the threshold
    other = data.withColumn("a", F.when(F.col("split") == "test", -F.col("a")).otherwise(F.col("a")))
    again, _ = B.train(SPEC, other, "id", "y", NUM, CAT, standard=["a"], robust=["b"])
    assert again.stages[-1].getOrDefault("threshold") == pytest.approx(r.threshold, abs=1e-9)


def test_half_of_the_training_rows_has_the_same_test_rows(data):
    half = B.train(SPEC, data, "id", "y", NUM, CAT, fraction=0.5)[1].first()
    assert half.total == 120 and half.label == "fraction 0.5" and 0 <= half.threshold <= 1
    with pytest.raises(ValueError, match="validation"):
        B.train(SPEC, data.filter("split <> 'validation'"), "id", "y", NUM, CAT)


def test_missing_inputs_are_named_and_text_is_read_as_numbers(spark, data):
    made, _ = B.train(SPEC, data, "id", "y", NUM, CAT)
    with pytest.raises(ValueError, match="inputs are missing: b, g"):
        B.decide(made, data.drop("b", "g"), "id")
    text = data.withColumn("a", F.col("a").cast("string"))
    assert sorted(B.decide(made, text, "id").collect()) == sorted(B.decide(made, data, "id").collect())
    bad = text.withColumn("a", F.lit("n/a"))
    null = data.withColumn("a", F.lit(None).cast("double"))
    assert sorted(B.decide(made, bad, "id").collect()) == sorted(B.decide(made, null, "id").collect())


def test_null_scores_have_no_decision(spark):
    df = spark.createDataFrame([(1, 0.45), (2, 0.44), (3, None)], "id long, s double")
    rows = {r.id: r for r in B.Decision(threshold=0.45, scoreCol="s").transform(df).collect()}
    assert [rows[k].churn_decision for k in (1, 2, 3)] == [1, 0, None] and rows[3].risk_grade is None


def test_search_does_not_depend_on_partitions(data):
    train = data.filter("split = 'train'")
    grid = {"regParam": [0.0, 10.0], "elasticNetParam": [0.0, 1.0]}
    best, table = B.search(SPEC, grid, train, "id", "y", NUM, CAT, k=3, standard=NUM)
    rows = table.collect()
    assert len(rows) == 4 and sorted(r["rank"] for r in rows) == [1, 2, 3, 4]
    assert next(r for r in rows if r["rank"] == 1).params.endswith('"regParam": 0.0}')
    assert best.stages[-1].getRegParam() == 0.0
    _, again = B.search(SPEC, grid, train.repartition(7), "id", "y", NUM, CAT, k=3, standard=NUM)
    assert again.collect() == rows
    # by hand: fold by fold
    folds = D.kfold(train, "id", "y", 3, 42)
    aucs = []
    for f in range(3):
        m = M.fit(M.ModelSpec("x", "logistic", {"C": 1e15, "maxIter": 100}), folds.filter(F.col("fold") != f), NUM, CAT, "y", standard=NUM)
        aucs.append(E.average_precision(M.score(m, folds.filter(F.col("fold") == f), ["y"]), "y", "y_score").first().pr_auc)
    # MLlib's area uses trapezoids, average precision uses steps
    assert next(r for r in rows if r["rank"] == 1).mean_metric == pytest.approx(np.mean(aucs), abs=0.02)
    with pytest.raises(ValueError, match="empty"):
        B.search(SPEC, {}, train, "id", "y", NUM, CAT)
