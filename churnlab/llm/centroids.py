"""Centroid clustering of vectors with subvector dictionaries (exact k-means).

Vectors are turned into integers, cut into blocks of ``width`` dimensions and
dictionary-encoded without loss, one dictionary per block and row group: the
distinct subvectors and, for each vector, the code of its subvector. A row group
holds up to ``group_rows`` vectors of one partition; it is written once, as one
Parquet row, into the shared folder. In a round every row group measures each of
its distinct subvectors against every centroid once, and a vector's squared
distance to a centroid is the sum of its blocks' entries by code. New centroids
come from the dictionaries as well: members are counted per (cluster, code) and
the counts multiply the subvectors.

Dictionaries belong to row groups because one dictionary of all data has no
size bound (components are any doubles): it would have to be broadcast whole or
joined to every block of every vector in every round. This way nothing is
shuffled but one row of sums per row group, cluster and dimension; a task holds
one row group, and a lost executor's row groups are read again from the shared
folder. The driver holds the centroids, nothing else.

All arithmetic is on integers: components are ``floor(scale * x)``, distances
are exact longs, new centroids are floors of exact quotients.

Defined results: vectors of another length, with a null or with a component
that is not finite are left out, null vectors too. Fewer vectors than ``k`` give
as many centroids; no vectors give an empty result. A null id counts as an empty
text in the order of the first centroids; equal ids come in the order of their
components, and repeated rows are clustered each on their own. A tie between
centroids goes to the smaller number. Components beyond ``LARGEST`` in absolute
value would overflow a long distance and raise an error. The length of a vector
is fixed, so there are no very long rows; columns other than id and vector are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: vectors of a row group, and vectors whose sums are held at once
GROUP_ROWS, SLICE_ROWS = 1 << 16, 1 << 13
#: largest integer component: 64 squared differences stay below 2^63
LARGEST = (1 << 27) - 1


def kept(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", dims: int = 64) -> DataFrame:
    """``id, v`` of the vectors with ``dims`` finite components (as doubles)."""
    d = vectors.select(F.col(id_col).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return d.filter((F.size("v") == dims) & ~bad)


def quantized(d: DataFrame, scale: int = 256) -> DataFrame:
    """Components as integers ``floor(scale * x)``."""
    q = F.transform("v", lambda x: F.floor(x * F.lit(float(scale))))
    far = F.exists("v", lambda x: F.abs(x) * scale > float(LARGEST))
    return d.select("id", F.when(far, F.raise_error(F.lit("a component is too large for exact distances")))
                    .otherwise(q).cast("array<long>").alias("v"))


def first_centroids(q: DataFrame, k: int, salt: int = 2) -> list[list[int]]:
    """The ``k`` vectors with the smallest hashes of their ids (a top-k, no sort of all rows)."""
    h = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    return [list(r.v) for r in q.select(h.alias("h"), "v").orderBy("h", "v").limit(k).collect()]


def encode(q: DataFrame, dims: int = 64, width: int = 2, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Row groups: ``ids``, and per block the codes and the dictionary of distinct
    subvectors, blocks one after another, in the narrowest integers that hold them."""
    blocks = [(a, min(a + width, dims)) for a in range(0, dims, width)]
    id_type = q.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts, n = [], [], 0
        for batch in batches:
            lo = 0
            while lo < len(batch):
                take = min(len(batch) - lo, group_rows - n)
                ids.append(batch.column(0).slice(lo, take))
                flat = batch.column(1).slice(lo, take).flatten()
                parts.append(flat.to_numpy(zero_copy_only=False).reshape(take, dims))
                lo, n = lo + take, n + take
                if n == group_rows:
                    yield _row_group(ids, np.concatenate(parts), blocks)
                    ids, parts, n = [], [], 0
        if n:
            yield _row_group(ids, np.concatenate(parts), blocks)

    return q.mapInArrow(run, f"ids array<{id_type}>, n int, codes binary, sizes array<int>, entries binary")


def _row_group(ids: list[pa.Array], m: np.ndarray, blocks: list[tuple[int, int]]) -> pa.RecordBatch:
    codes, sizes, entries = [], [], []
    for a, z in blocks:
        sub = np.ascontiguousarray(m[:, a:z])
        order = np.lexsort(sub.T)
        s = sub[order]
        new = np.ones(len(s), bool)
        new[1:] = (s[1:] != s[:-1]).any(1)
        code = np.empty(len(s), np.int32)
        code[order] = np.cumsum(new) - 1
        codes.append(code)
        entries.append(s[new].reshape(-1))
        sizes.append(int(new.sum()))
    ids_col = pa.concat_arrays(ids)
    flat, code = np.concatenate(entries), np.concatenate(codes)
    return pa.RecordBatch.from_arrays(
        [pa.ListArray.from_arrays(pa.array([0, len(ids_col)], pa.int32()), ids_col), pa.array([len(m)], pa.int32()),
         pa.array([_narrow(code).tobytes()], pa.binary()), pa.array([sizes], pa.list_(pa.int32())),
         pa.array([_narrow(flat).tobytes()], pa.binary())], ["ids", "n", "codes", "sizes", "entries"])


def _narrow(x: np.ndarray) -> np.ndarray:
    """As signed integers of 2, 4 or 8 bytes (the reader takes the size from the length)."""
    most = max(abs(int(x.min())), abs(int(x.max()))) if len(x) else 0
    return x.astype(f"<i{next(b for b in (2, 4, 8) if most < 1 << (8 * b - 1))}")


def _dictionaries(batch: pa.RecordBatch, row: int, blocks: list[tuple[int, int]]):
    """Codes (blocks x vectors) and the dictionaries of one row group."""
    n = batch.column("n")[row].as_py()
    sizes = batch.column("sizes")[row].as_py()
    raw = batch.column("codes")[row].as_buffer()
    codes = np.frombuffer(raw, f"<i{raw.size // (n * len(blocks))}").reshape(len(blocks), n)
    raw = batch.column("entries")[row].as_buffer()
    flat = np.frombuffer(raw, f"<i{raw.size // sum((z - a) * x for (a, z), x in zip(blocks, sizes))}")
    out, at = [], 0
    for (a, z), size in zip(blocks, sizes):
        out.append(flat[at:at + size * (z - a)].reshape(size, z - a))
        at += size * (z - a)
    return codes, out


def _assigned(codes: np.ndarray, entries: list[np.ndarray], blocks: list[tuple[int, int]],
              centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid and squared distance of each vector: every distinct
    subvector is measured once, the vectors add up entries by code."""
    n = codes.shape[1]
    total = np.zeros((n, len(centroids)), np.int64)
    for (a, z), e, c in zip(blocks, entries, codes):    # one block's table at a time
        t = np.zeros((len(e), len(centroids)), np.int64)
        for j in range(z - a):
            t += (e[:, j:j + 1].astype(np.int64) - centroids[None, :, a + j]) ** 2
        for lo in range(0, n, SLICE_ROWS):
            total[lo:lo + SLICE_ROWS] += t[c[lo:lo + SLICE_ROWS]]
    best = total.argmin(1)                              # the first of equal distances
    dist = total[np.arange(n), best]
    return best, dist


def _round(groups: DataFrame, centroids: list[list[int]], width: int) -> dict[int, tuple[int, int, list[int]]]:
    """Members, summed distance and componentwise sums of each cluster that has
    members: 40 x 64 numbers per row group are shuffled, those of all clusters
    reach the driver."""
    cents = np.array(centroids, np.int64)
    dims = cents.shape[1]
    blocks = [(a, min(a + width, dims)) for a in range(0, dims, width)]

    def run(batches):
        for batch in batches:
            for row in range(len(batch)):
                codes, entries = _dictionaries(batch, row, blocks)
                best, dist = _assigned(codes, entries, blocks, cents)
                members = np.bincount(best, minlength=len(cents))
                sums = np.zeros(cents.shape, np.int64)
                for (a, z), e, c in zip(blocks, entries, codes):
                    times = np.bincount(best * len(e) + c.astype(np.int64), minlength=len(cents) * len(e)).reshape(len(cents), -1)
                    sums[:, a:z] = times @ e.astype(np.int64)
                # distances below 2^63 may not add up in a long: high and low halves
                high, low = np.zeros(len(cents), np.int64), np.zeros(len(cents), np.int64)
                np.add.at(high, best, dist >> 32)
                np.add.at(low, best, dist & 0xFFFFFFFF)
                at = np.flatnonzero(members)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at.astype(np.int32)), pa.array(members[at]), pa.array(high[at]), pa.array(low[at]),
                     pa.array(list(sums[at]), pa.list_(pa.int64()))], ["cluster", "n", "high", "low", "s"])

    part = groups.select("n", "codes", "sizes", "entries").mapInArrow(
        run, "cluster int, n long, high long, low long, s array<long>")
    big = "decimal(38,0)"
    totals = part.groupBy("cluster").agg(F.sum(F.col("n").cast(big)).alias("n"), F.sum(F.col("high").cast(big)).alias("high"),
                                         F.sum(F.col("low").cast(big)).alias("low"))
    sums = (part.select("cluster", F.posexplode("s").alias("i", "x")).groupBy("cluster", "i")
            .agg(F.sum(F.col("x").cast(big)).alias("x")))
    out = {r.cluster: (int(r.n), (int(r.high) << 32) + int(r.low), [0] * dims) for r in totals.collect()}
    for r in sums.collect():
        out[r.cluster][2][r.i] = int(r.x)
    return out


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, id_col: str = "vec_id", vector: str = "embedding",
            dims: int = 64, scale: int = 256, width: int = 2, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of
    every kept vector after ``rounds`` rounds and a last assignment. ``width``
    and ``group_rows`` change the work, never the result."""
    q = quantized(kept(vectors, id_col, vector, dims), scale)
    id_type = q.schema["id"].dataType.simpleString()
    cents = first_centroids(q, k)
    if not cents:
        return q.limit(0).select(F.col("id").alias(id_col), F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"),
                                 F.lit(0).cast("long").alias("cluster_inertia"), F.lit(0).cast("long").alias("inertia"),
                                 F.lit("").alias("centroid_sha256"))
    groups = materialize(encode(q, dims, width, group_rows), "row_groups")
    for _ in range(rounds):
        got = _round(groups, cents, width)
        cents = [[x // got[c][0] for x in got[c][2]] if c in got else cents[c] for c in range(len(cents))]
    last = _round(groups, cents, width)
    inertia = {c: v[1] for c, v in last.items()}
    whole = sum(inertia.values())
    if whole >= 1 << 63:
        raise OverflowError("the inertia is larger than a long")
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    blocks = [(a, min(a + width, dims)) for a in range(0, dims, width)]
    arr = np.array(cents, np.int64)
    per = np.array([inertia.get(c, 0) for c in range(len(cents))], np.int64)

    def run(batches):
        sha = pa.array(shas, pa.string())
        for batch in batches:
            for row in range(len(batch)):
                codes, entries = _dictionaries(batch, row, blocks)
                best, dist = _assigned(codes, entries, blocks, arr)
                ids = batch.column("ids")[row].values
                for lo in range(0, len(best), SLICE_ROWS):
                    b = best[lo:lo + SLICE_ROWS]
                    yield pa.RecordBatch.from_arrays(
                        [ids.slice(lo, len(b)), pa.array(b.astype(np.int32)), pa.array(dist[lo:lo + len(b)]), pa.array(per[b]),
                         pa.array(np.full(len(b), whole, np.int64)), sha.take(pa.array(b))],
                        ["id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])

    return groups.mapInArrow(run, f"id {id_type}, cluster int, distance long, cluster_inertia long, inertia long, "
                                  "centroid_sha256 string").withColumnRenamed("id", id_col)
