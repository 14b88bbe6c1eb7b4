"""Column transformer against statistics of the filled columns computed whole."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from churnlab.operators.transformer import ColumnTransformer, ColumnTransformerModel

COLS = ["plain", "holes", "a.b", "flat", "many"]


def frame(n, seed=1):
    rnd = np.random.default_rng(seed)
    pdf = pd.DataFrame({"id": range(n), "plain": rnd.normal(10, 3, n).round(3), "holes": rnd.normal(-1, 50, n).round(2),
                        "a.b": rnd.integers(0, 4, n).astype(float), "flat": 7.0, "many": rnd.exponential(1, n).round(3),
                        "g": rnd.choice(["u", "v w", "x"], n), "b": rnd.random(n) < 0.3,
                        "split": np.where(np.arange(n) % 5 == 0, "test", "train")})
    pdf.loc[pdf.index % 4 == 1, "holes"] = np.nan
    pdf.loc[pdf.index % 3 != 0, "many"] = np.nan        # more nulls than values
    pdf.loc[pdf.index % 7 == 2, "a.b"] = np.nan
    pdf.loc[pdf.index % 9 == 4, "g"] = None
    return pdf


def spark_frame(spark, pdf):
    rows = [tuple(None if isinstance(x, float) and np.isnan(x) else x for x in r) for r in pdf.itertuples(index=False)]
    return spark.createDataFrame([tuple(x.item() if hasattr(x, "item") else x for x in r) for r in rows],
                                 "id long, plain double, holes double, `a.b` double, flat double, many double, g string, "
                                 "b boolean, split string")


def scaled(fit, whole, branch):
    """(column, indicator) by NumPy."""
    median = fit.median()

    def scale(train, x):
        if branch == "standard":
            return (x - train.mean()) / (train.std() or 1.0)
        if branch == "robust":
            q1, q2, q3 = np.quantile(train, [0.25, 0.5, 0.75])
            return (x - q2) / ((q3 - q1) or 1.0)
        return x
    out = [scale(fit.fillna(median).to_numpy(), whole.fillna(median).to_numpy())]
    if fit.isna().any():
        out.append(scale(fit.isna().to_numpy().astype(float), whole.isna().to_numpy().astype(float)))
    return out


@pytest.mark.parametrize("branch", ["standard", "robust", "passthrough"])
@pytest.mark.parametrize("n", [173, 4, 7, 20])
def test_branches_equal_numpy(spark, branch, n):
    pdf = frame(n, n)
    df = spark_frame(spark, pdf)
    model = ColumnTransformer(**{branch: COLS}, fitWhere="split = 'train'").fit(df)
    out = model.transform(df).orderBy("id").toPandas()
    assert set(model.featureNames) <= set(out.columns) and {"id", "g", "b", "split"} <= set(out.columns)
    for c in COLS:
        want = scaled(pdf[pdf.split == "train"][c], pdf[c], branch)
        assert (f"{c}_missing" in out.columns) == (len(want) == 2)
        assert np.allclose(out[c], want[0], atol=1e-9)
        if len(want) == 2:
            assert np.allclose(out[f"{c}_missing"], want[1], atol=1e-9)


def test_levels_booleans_and_unseen_values(spark, tmpdir_path):
    df = spark_frame(spark, frame(60))
    model = ColumnTransformer(passthrough=["b"], categorical=["g"]).fit(df.filter("g is null or g <> 'x'"))
    assert model.featureNames == ["b", "g_Missing", "g_u", "g_v w"]
    rows = model.transform(df).join(df.select("id", F.col("g").alias("was"), F.col("b").alias("flag")), "id").collect()
    for r in rows:
        assert (r["g_Missing"], r["g_u"], r["g_v w"]) == (float(r.was is None), float(r.was == "u"), float(r.was == "v w"))
        assert r["b"] == float(r.flag)
    model.write().overwrite().save(f"{tmpdir_path}/ct")
    again = ColumnTransformerModel.load(f"{tmpdir_path}/ct")
    assert sorted(again.transform(df).collect()) == sorted(model.transform(df).collect())


def test_nothing_to_fit_and_wrong_input(spark):
    df = spark_frame(spark, frame(12))
    none = ColumnTransformer(standard=["plain"], robust=["many"], categorical=["g"], fitWhere="id < 0").fit(df)
    assert none.featureNames == ["plain", "many"]
    empty = df.withColumn("plain", F.lit(None).cast("double"))
    out = ColumnTransformer(standard=["plain"], robust=["flat"]).fit(empty).transform(empty).collect()
    assert {(r.plain, r.plain_missing, r.flat) for r in out} == {(0.0, 0.0, 0.0)}
    model = ColumnTransformer(robust=["plain"]).fit(df)
    with pytest.raises(ValueError, match="plain"):
        model.transform(df.drop("plain"))
    with pytest.raises(ValueError, match="levels"):
        ColumnTransformer(categorical=["g"], maxLevels=2).fit(df)
    with pytest.raises(ValueError, match="taken"):
        ColumnTransformer(standard=["plain"]).fit(df.withColumn("plain_missing", F.lit(1)))
