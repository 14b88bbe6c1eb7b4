"""Radix selection: keys in the order of doubles, ranks, quantiles, borders."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlab.operators import selection as S

EDGES = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.0, 1.0000000000000002, 0.9999999999999999,
         -1.0, 2.0, 1.9999999999999998, 1e308, -1e308, 1.7976931348623157e308, float("inf"), float("-inf"), 0.1, 1 / 3, 3.0, 8.0,
         7.999999999999999, 1e-300, 123456789.123]


def test_keys_follow_the_order_of_doubles_and_turn_back(spark):
    rnd = random.Random(4)
    vals = EDGES + [rnd.uniform(-1, 1) * 10.0 ** rnd.randint(-307, 307) for _ in range(400)]
    vals += [2.0 ** k for k in range(-1074, 1024, 7)] + [math.nextafter(2.0 ** k, 0) for k in range(-1000, 1023, 13)]
    df = spark.createDataFrame([(float(v),) for v in vals] + [(None,), (float("nan"),)], "v double")
    rows = S.sort_key(df, "v", "k").withColumn("back", S.key_value(F.col("k"))).collect()
    known = [r for r in rows if r.v is not None and not math.isnan(r.v)]
    for r in known:
        assert r.back == r.v
        bits = int(np.float64(abs(r.v)).view(np.int64))
        assert r.k == (-bits if r.v < 0 else bits)
    nan = next(r for r in rows if r.v is not None and math.isnan(r.v))
    assert nan.k > max(r.k for r in known) and math.isnan(nan.back)
    assert next(r for r in rows if r.v is None).k is None


@pytest.fixture(scope="module")
def table(spark):
    rnd = np.random.default_rng(8)
    n = 1200
    rows = [(i, ["x", "y", None][i % 3], None if i % 13 == 0 else float(rnd.normal()) * 10 ** (i % 4), float(i % 5),
             0.5 if i % 3 else round(float(rnd.random()), 2), 1e18 if i % 7 else -3.0) for i in range(n)]
    return spark.createDataFrame(rows, "id long, g string, `a.b` double, few double, s double, far double").repartition(5).cache()


@pytest.mark.parametrize("by", [[], ["g"]])
def test_quantiles_equal_numpy(table, by):
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    cols = ["a.b", "few", "far"]
    got = {(r["g"] if by else None, r.feature, r.prob): r.value for r in S.quantiles(table, cols, probs, by).collect()}
    pdf = table.toPandas()
    for g in (["x", "y", None] if by else [None]):
        part = pdf[pdf.g.isna() if g is None else pdf.g == g] if by else pdf
        for c in cols:
            x = part[c].dropna().to_numpy()
            for p in probs:
                assert got[(g, c, p)] == pytest.approx(np.quantile(x, p), rel=1e-12)
    assert len(got) == len(cols) * len(probs) * (3 if by else 1)


def test_quantiles_of_nothing(table):
    assert S.quantiles(table.limit(0), ["few"], [0.5]).collect() == []
    empty = table.withColumn("few", F.lit(None).cast("double"))
    assert S.quantiles(empty, ["few", "s"], [0.5]).select("feature").collect()[0].feature == "s"


@pytest.mark.parametrize("n", [1, 3, 150, 399, 400, 401, 5000])
def test_top_rows_of_every_group_with_heavy_ties(table, n):
    from churnlab.operators import ordered as O
    got = O.rank_cut(table, "s", "id", n, by=["g"]).toPandas()
    assert len(got) == 1200 and list(got.columns) == [*table.columns, "_in_top"]
    for g in ("x", "y", None):
        part = got[got.g.isna() if g is None else got.g == g]
        want = part.sort_values(["s", "id"], ascending=[False, True]).head(n)
        assert set(part[part._in_top].id) == set(want.id)


def test_negative_and_fractional_ids(spark):
    from churnlab.operators import ordered as O
    rows = [(float(k) / 2 - 20, 0.5) for k in range(80)]
    df = spark.createDataFrame(rows, "id double, s double")
    assert sorted(r.id for r in O.top_n(df, "s", "id", 7).collect()) == [-20 + k / 2 for k in range(7)]
    whole = df.withColumn("id", (F.col("id") * 2).cast("long"))
    assert sorted(r.id for r in O.top_n(whole, "s", "id", 7).collect()) == list(range(-40, -33))
    assert O.top_n(df, "s", "id", 0).collect() == []


def test_rows_are_neither_joined_nor_shuffled(table):
    from churnlab.operators import ordered as O
    plan = O.rank_cut(table, "s", "id", 100, by=["g"])._jdf.queryExecution().optimizedPlan().toString()
    for step in ("Join", "Repartition", "Aggregate", "Window", "Sort"):
        assert step not in plan.split("InMemoryRelation")[0]


def test_too_many_groups_are_named(spark, monkeypatch):
    monkeypatch.setattr(S, "MAX_ENTRIES", 5)
    df = spark.range(50).selectExpr("id", "id % 10 as g", "id * 1.5D as v")
    with pytest.raises(Exception, match="group ranks"):
        S.quantiles(df, ["v"], [0.5], ["g"]).collect()
