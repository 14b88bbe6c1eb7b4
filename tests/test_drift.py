"""Drift sketches: bins, merging, index by hand, batches of a stream."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlab.operators import drift as DR
from churnlab.streaming import monitor


@pytest.fixture(scope="module")
def data(spark):
    rnd = np.random.default_rng(7)
    rows = [(i, None if i % 17 == 0 else float(rnd.normal(i // 200, 1)), float(i % 4), ["u", "v", "w", None][int(rnd.integers(0, 3 + i // 300))],
             ["d1", "d2", None][i % 3]) for i in range(600)]
    rows += [(700, 0.0, 0.0, "late", "d1")]
    return spark.createDataFrame(rows, "id long, x double, `a.b` double, g string, day string").cache()


def by_hand(base, cur, eps=1e-6):
    nb, nc = sum(base.values()), sum(cur.values())
    out = 0.0
    for k in base.keys() | cur.keys():
        p, q = max(base[k] / nb, eps), max(cur[k] / nc, eps)
        out += (q - p) * math.log(q / p)
    return out


def test_index_of_every_feature_by_hand(data):
    pdf = data.toPandas()
    base, rest = data.filter("id < 300"), data.filter("id >= 300")
    lay = DR.layout(base, ["x", "a.b"], ["g"], bins=5)
    cuts = {c: np.quantile(pdf[pdf.id < 300][c].dropna(), [.2, .4, .6, .8]) for c in ("x", "a.b")}

    def counts(part, c):
        if c == "g":
            return Counter("<null>" if v is None else v if v in lay.levels["g"] else "<other>" for v in part["g"])
        return Counter("<null>" if np.isnan(v) else str(int((cuts[c] < v).sum())) for v in part[c])
    for by in ([], ["day"]):
        got = DR.psi(DR.sketch(base, lay), DR.sketch(rest, lay, by), by).collect()
        assert len(got) == (3 if not by else 9)
        for r in got:
            part = pdf[pdf.id >= 300]
            if by:
                part = part[part.day.isna()] if r.day is None else part[part.day == r.day]
            assert r.rows == len(part)
            assert r.psi == pytest.approx(by_hand(counts(pdf[pdf.id < 300], r.feature), counts(part, r.feature)), abs=1e-9)


def test_sketches_add_up(data):
    lay = DR.layout(data.filter("id < 300"), ["x"], ["g"])
    parts = DR.sketch(data.filter("id % 2 = 0"), lay).unionByName(DR.sketch(data.filter("id % 2 = 1"), lay))
    assert set(DR.merge(parts).collect()) == set(DR.sketch(data, lay).collect())


def test_levels_are_bounded_and_empty_tables_defined(data):
    lay = DR.layout(data, ["x"], ["g"], max_levels=2)
    assert len(lay.levels["g"]) == 2
    assert "<other>" in {r.bin for r in DR.sketch(data, lay).collect()}
    none = data.limit(0)
    empty = DR.layout(none, ["x"], ["g"])
    assert empty.cuts == {"x": []} and empty.levels == {"g": []}
    assert DR.psi(DR.sketch(data, lay), DR.sketch(none, lay)).collect() == []
    flat = DR.layout(data.withColumn("x", F.lit(2.0)), ["x"], [])
    same = DR.sketch(data.withColumn("x", F.lit(2.0)), flat)
    assert DR.psi(same, same).first().psi == 0.0


def test_a_stream_gives_the_numbers_of_a_batch(spark, data, tmpdir_path):
    src = f"{tmpdir_path}/in"
    data.repartition(4).write.parquet(src)
    lay = DR.layout(data.filter("id < 300"), ["x"], ["g"])

    def drain():
        rows = spark.readStream.schema(data.schema).option("maxFilesPerTrigger", 1).parquet(src)
        return monitor.drain_sketches(rows, lay, f"{tmpdir_path}/out", f"{tmpdir_path}/ckpt", by=["day"])
    assert set(drain().collect()) == set(DR.sketch(data, lay, ["day"]).collect())
    data.withColumn("id", F.col("id") + 1000).coalesce(1).write.mode("append").parquet(src)       # more arrives
    assert {r.n for r in drain().filter("feature = 'g'").collect()} == {2 * r.n for r in DR.sketch(data, lay, ["day"]).filter("feature = 'g'").collect()}
