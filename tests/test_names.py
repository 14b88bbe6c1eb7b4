"""Column names with dots and quotes, level guard, duplicate keys, constant columns."""

import pytest
from pyspark.sql import functions as F

from churnlab.operators import features as C
from churnlab.operators import profile as P
from churnlab.sources import files as A


def test_levels_with_dots_and_quotes_reach_scalers_and_profiles(spark):
    df = spark.createDataFrame([(1, "St. Louis", 1.0), (2, "O'Fallon", 3.0), (3, "Rolla", 8.0)], "id long, c string, `v.w` double")
    enc = C.OneHotFirstDrop(["c"], dropFirst=False).fit(df).transform(df)
    cols = ["c_St. Louis", "c_O'Fallon", "v.w"]
    assert {r.feature: r.missing for r in P.missing(enc, cols).collect()} == dict.fromkeys(cols, 0)
    for scaler in (C.ExactStandardScaler(cols), C.ExactRobustScaler(cols)):
        out = scaler.fit(enc).transform(enc)
        assert out.count() == 3 and set(cols) <= set(out.columns)


def test_levels_are_counted_before_they_are_collected(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError, match="50 levels exceed"):
        C.OneHotFirstDrop(["c"], maxLevels=10).fit(df)


def test_upsert_keeps_one_record_per_key(spark, tmpdir_path):
    def rows(*xs):
        return spark.createDataFrame(xs, "model_key string, label string, f1 double")
    path = f"{tmpdir_path}/results"
    A.upsert(spark, path, rows(("a", "x", 0.1), ("a", "x", 0.3), ("b", "x", 0.5)))
    out = A.upsert(spark, path, rows(("a", "x", 0.2), ("c", "x", 0.9)))
    assert sorted((r.model_key, r.f1) for r in out.collect()) == [("a", 0.2), ("b", 0.5), ("c", 0.9)]


def test_histogram_of_a_constant_column_is_widened(spark):
    h = P.histogram(spark.createDataFrame([(2.0,)] * 4, "v double"), ["v"], bins=4).orderBy("bin").collect()
    assert [(r.lo, r.hi, r.n) for r in h] == [(1.5, 1.75, 0), (1.75, 2.0, 0), (2.0, 2.25, 4), (2.25, 2.5, 0)]
