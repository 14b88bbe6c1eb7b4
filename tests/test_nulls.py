"""Null labels, groups and scores: no row is lost or invented."""

import pandas as pd
import pytest

from churnlab.operators import campaign as G
from churnlab.operators import evaluate as E
from churnlab.operators import ordered as O
from churnlab.operators import splits as D


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, None if i % 5 == 0 else i % 2, None if i % 10 == 3 else round((i * 7 % 20) / 20, 2), None if i % 4 == 0 else "ab"[i % 2])
            for i in range(100)]
    return spark.createDataFrame(data, "id long, y int, s double, g string")


def brute_top(rows, n, by):
    pdf = rows.toPandas()
    pdf["_k"] = pdf["s"].fillna(-1.0)
    pdf = pdf.sort_values(["_k", "id"], ascending=[False, True])
    if not by:
        return set(pdf.head(n)["id"])
    return set(pd.concat([x.head(n) for _, x in pdf.groupby(pdf["g"].fillna("?"))])["id"])


@pytest.mark.parametrize("by", [[], ["g"]])
@pytest.mark.parametrize("n", [1, 20, 33, 95, 2000])
def test_top_n_takes_null_scores_last_and_keeps_null_groups(rows, by, n):
    got = [r.id for r in O.top_n(rows, "s", "id", n, by=by, buckets=3).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_top(rows, n, by)


def test_status_flags_every_member_over_the_threshold(rows):
    st = G.campaign_status(rows, "id", "s", 0.3, 5, by=["g"]).toPandas()
    assert len(st) == rows.filter("s >= 0.3").count()
    assert (st[st.status == "selected"].groupby(st["g"].fillna("?")).size() == 5).all()


def test_splits_keep_null_labels_as_a_class(rows):
    s = D.stratified_split(rows, "id", "y", 0.2).toPandas()
    assert len(s) == 100
    assert (s[s.split == "test"].groupby(s["y"].fillna(-1)).size() == 8).sum() == 2     # 40 rows of each label
    assert ((s.split == "test") & s.y.isna()).sum() == 4
    assert D.three_way_split(rows, "id", "y").count() == 100
    assert D.kfold(rows, "id", "y", 5).count() == 100
    assert D.undersample(rows, "id", "y").groupBy("y").count().toPandas()["count"].tolist() == [20, 20, 20]


def test_split_border_inside_equal_hashes(rows, monkeypatch):
    # every id has the same first 60 bits: the whole hash and the id decide
    from pyspark.sql import functions as F
    monkeypatch.setattr(D, "hash_hex", lambda c, seed: F.concat(F.lit("0" * 15), F.format_string("%017d", c % 7)))
    s = D.stratified_split(rows, "id", "y", 0.2).toPandas()
    for _, part in s.groupby(s["y"].fillna(-1)):
        order = sorted(part["id"], key=lambda i: (i % 7, i))
        assert set(part[part.split == "test"]["id"]) == set(order[:round(len(order) * 0.2)])


def test_rows_with_equal_ids_stay_together(spark):
    df = spark.createDataFrame([(k // 3, 1) for k in range(60)], "id long, y int")
    s = D.stratified_split(df, "id", "y", 0.2).toPandas()
    assert (s.groupby("id")["split"].nunique() == 1).all() and 12 <= (s.split == "test").sum() <= 14


def test_metrics_and_lift_keep_the_null_group(rows):
    m = {r.g: r for r in E.metrics(rows, "y", "s", 0.5, by=["g"]).collect()}
    c = {r.g: r for r in E.confusion(rows.filter("s is not null"), "y", "s", 0.5, by=["g"]).collect()}
    assert set(m) == {None, "a", "b"} == set(c)
    for g in m:
        assert (m[g].tn, m[g].fp, m[g].fn, m[g].tp) == (c[g].tn, c[g].fp, c[g].fn, c[g].tp)
    lift = G.lift_table(rows.na.fill(0, ["y"]), "id", "y", "s", 5, by=["g"]).toPandas()
    scored = rows.filter("s is not null").toPandas()
    assert lift.groupby(lift["g"].fillna("?"))["members"].sum().to_dict() == scored.groupby(scored["g"].fillna("?")).size().to_dict()


def test_sweep_selects_no_member_without_a_score(spark):
    df = spark.createDataFrame([(1, 0.9), (0, None), (1, None), (0, 0.1)], "y int, s double")
    sweep = {round(r.threshold, 2): r for r in E.threshold_sweep(df, "y", "s").collect()}
    assert sweep[0.5].selected == 1 == E.metrics(df, "y", "s", 0.5).first().selected
    assert sweep[0.05].selected == 2 and sweep[0.5].tn + sweep[0.5].fn == 1


def test_auc_of_large_counts_does_not_overflow(spark):
    n = 4_000_000_000
    cum = spark.createDataFrame([(0.9, n, 0, n, 0, n, n), (0.1, 0, n, n, n, n, n)],
                                "score double, pos long, neg long, tp long, fp long, P long, N long")
    assert E._auc_ap(cum, []).first().roc_auc == pytest.approx(1.0)
