"""Exact k-means by subvector dictionaries against brute force."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from churnlab.llm import centroids as K

DIMS = 6
SCHEMA = "vec_id long, embedding array<float>, id string, v int, cluster string, `n.codes` int"


def rows():
    rnd = np.random.default_rng(5)
    base = [list(map(float, x)) for x in np.round(rnd.normal(0, 0.2, (60, DIMS)), 3).astype(np.float32)]
    out = [(k, x) for k, x in enumerate(base)]
    out += [(100 + k, base[3]) for k in range(200)]                     # a large group of equal vectors
    out += [(7, base[7]), (7, base[8]), (None, base[9]), (None, base[9]), (300, [0.0] * DIMS), (301, [-0.001] * DIMS)]
    out += [(400, None), (401, []), (402, base[0][:-1]), (403, base[0] + [0.5]), (404, [*base[0][:-1], None]),
            (405, [*base[0][:-1], math.nan]), (406, [*base[0][:-1], math.inf])]
    return out


def brute(data, k, rounds, scale=256):
    keep = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in data
            if v is not None and len(v) == DIMS and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(keep, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cents = [v for _, v in first[:k]]

    def nearest(v):
        d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in cents]
        return d.index(min(d)), min(d)
    for _ in range(rounds):
        at = [nearest(v)[0] for _, v in keep]
        for c in range(len(cents)):
            own = [v for (_, v), a in zip(keep, at) if a == c]
            if own:
                cents[c] = [sum(x) // len(own) for x in zip(*own)]
    last = [nearest(v) for _, v in keep]
    own = Counter()
    for c, d in last:
        own[c] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return Counter((i, c, d, own[c], sum(own.values()), sha[c]) for (i, _), (c, d) in zip(keep, last))


@pytest.fixture(scope="module")
def vectors(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('vec')}/v"
    spark.createDataFrame([(i, v, "x", 1, "c", 2) for i, v in rows()], SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("k,width,group_rows", [(5, 2, 1 << 17), (5, 4, 7), (3, 1, 50), (8, DIMS, 64)])
def test_clusters_equal_brute_force(vectors, k, width, group_rows):
    got = K.cluster(vectors, k=k, dims=DIMS, width=width, group_rows=group_rows)
    assert Counter(tuple(r) for r in got.collect()) == brute(rows(), k, 5)


def test_fewer_vectors_than_centroids_and_none(spark, vectors):
    few = vectors.filter("vec_id in (1, 2, 300)")
    want = brute([r for r in rows() if r[0] in (1, 2, 300)], 40, 5)
    assert Counter(tuple(r) for r in K.cluster(few, dims=DIMS).collect()) == want
    none = K.cluster(vectors.limit(0), dims=DIMS)
    assert none.collect() == [] and none.columns[0] == "vec_id"
    assert K.cluster(vectors.filter("vec_id >= 400"), dims=DIMS).collect() == []


def test_large_components_stay_exact_or_raise(spark):
    near = [(k, [float(k % 7) * 60000.0] * DIMS) for k in range(30)]
    d = spark.createDataFrame(near, "vec_id long, embedding array<double>")
    assert Counter(tuple(r) for r in K.cluster(d, k=3, dims=DIMS).collect()) == brute(near, 3, 5)
    far = spark.createDataFrame([(1, [1e30] * DIMS)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        K.cluster(far, dims=DIMS).collect()


def test_row_groups_lose_nothing(vectors):
    q = K.quantized(K.kept(vectors, dims=DIMS))
    want = Counter((r.id, tuple(r.v)) for r in q.collect())
    blocks = [(0, 4), (4, DIMS)]
    got = Counter()
    for r in K.encode(q, DIMS, 4, 16).collect():
        codes = np.frombuffer(r.codes, np.int16).reshape(2, r.n)
        flat = np.frombuffer(r.entries, np.int16)
        cut = r.sizes[0] * 4
        parts = [flat[:cut].reshape(-1, 4)[codes[0]], flat[cut:].reshape(-1, DIMS - 4)[codes[1]]]
        assert len(blocks) == len(r.sizes) and len({tuple(x) for x in flat[:cut].reshape(-1, 4)}) == r.sizes[0]
        got.update((i, tuple(v)) for i, v in zip(r.ids, np.hstack(parts).tolist()))
    assert got == want
