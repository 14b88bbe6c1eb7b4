"""Exact Jaccard self-join of word shingle sets in their metric space.

The distance of two sets is one minus their Jaccard similarity, a metric; two
documents link at a distance of at most ``r = 1 - threshold``. Equal sets are one
node. Nodes meet in regions:

1. *Pivots.* Crowded groups of nodes that share a pair of minimum hashes elect
   a pivot each, the node with the most copies. The exact distances of all
   documents to the pivots are computed, and a pivot's region holds the
   documents within r; they link to it. The boundary documents, within the
   window of 2 r, are replicated to the region too: by the triangle inequality
   every partner y of a region's x has d(y, p) <= d(x, p) + r.
2. *Recursion.* Crowds out of reach of the pivots become pivots themselves, for
   ``rounds`` rounds within the bounds; all links of a pivot are then known. A
   node of a region is settled when its window holds no documents but the
   region's own and pivots: all its partners are connected to it already. A
   crowd is thus joined by its members' links to pivots, never by all pairs,
   and no pair within a connected group is looked at again.
3. *The far region.* Unrelated texts share no shingle: they are at distance 1 of
   every pivot, where no window can part them. For them single shingles are the
   pivots: a node is replicated to the regions of its first
   ``n - ceil(threshold * n) + 1`` shingles in a fixed global order (rare before
   frequent, then by hash), leaving out those that no other node holds. Linked
   nodes share one of these. The pairs of a
   region are counted; the count bounds a pair's overlap, and the pairs whose
   bound reaches the threshold are compared exactly on their whole sets.

Every step is exact: the pivots, the frequency order, and the bit tables that
skip settled documents change the work, not the links. A text is shingled again
where its set is needed, so sets are never stored or shuffled as a whole table.

Null and empty texts and texts without words have no shingles and link with
nothing; texts with fewer words than a shingle are one shingle. Repeated rows
share a node. Null ids are members that never name a component (a component of
null ids alone has id null). The input is read several times and has to give
the same rows each time, as a table does. An empty table gives an empty result; columns
other than id and text are ignored, ``keep_one`` keeps them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import arrow_rows, bit_table, components, drop_tables, fresh, in_table, materialize, salted_join

SHINGLE, PERCENT = 5, 80
#: nodes that make a group crowded; pivots of a round, and their shingles in all
CROWD, PIVOTS, PIVOT_SHINGLES, ROUNDS = 4, 8192, 2_000_000, 3
#: nodes of a frequent shingle, and the most such shingles that are told to tasks
FREQUENT, MAX_FREQUENT = 40, 1 << 20
#: most bits of a table; bits that it keeps for each set one when it is made smaller
TABLE_BITS, SPARSE = 1 << 27, 64
_EPS = 1e-9


def prefix(n, percent: int = PERCENT):
    """Shingles of which linked sets share one: n - ceil(threshold n) + 1."""
    return n - (percent * n + 99) // 100 + 1


def sets(w: W.Words, k: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document of a slice."""
    g = w.ngrams(k)
    out = []
    for i in range(len(w)):
        a, z = w.first[i], w.first[i + 1]
        if z - a >= k:
            out.append(np.unique(g[a:z - k + 1]))
        else:
            out.append(W.ngrams(w.hash[a:z], int(z - a), seed=5) if z > a else np.zeros(0, np.uint64))
    return out


def _print(u: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums that stand for a set."""
    a = int(W.mix(u).sum())
    b = int(W.mix(u ^ np.uint64(0x5851F42D4C957F2D)).sum())
    return (a + len(u)) & W.MASK, b & W.MASK


def _name(f: tuple[int, int]) -> bytes:
    return f[0].to_bytes(8, "big") + f[1].to_bytes(8, "big")


_SKETCH = W._splitmix(6, 77)


def _nodes(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """One row per document: ``row, id, n, fp`` (name of the set), ``f`` (its first
    64 bits), ``sketch`` (three pairs of minimum hashes) and ``low`` (somewhat
    more shingles than the prefix, by hash)."""
    id_type = docs.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            n, fp, f, sk, low = [], [], [], [], []
            for w in W.split(batch.column("t"), lower=True):
                for u in sets(w, k):
                    p = _print(u)
                    n.append(len(u))
                    fp.append(_name(p))
                    f.append(p[0] - (1 << 64) if p[0] >> 63 else p[0])
                    if len(u):
                        m = [int(W.mix(u ^ s).min()) for s in _SKETCH]
                        sk.append([W.signed(np.array([(m[j] * 3 + m[j + 1]) & W.MASK], np.uint64))[0] for j in (0, 2, 4)])
                    else:
                        sk.append([])
                    low.append(W.signed(u[:prefix(len(u), percent) + len(u) // 20 + 8]))
            size = np.array([len(x) for x in low], np.int64)
            lows = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)),
                                            pa.array(np.concatenate(low) if low else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), pa.array(n, pa.int64()), pa.array(fp, pa.binary()),
                 pa.array(f, pa.int64()), pa.array(sk, pa.list_(pa.int64())), lows], ["row", "id", "n", "fp", "f", "sketch", "low"])

    return docs.select("row", "id", "t").mapInArrow(
        run, f"row long, id {id_type}, n long, fp binary, f long, sketch array<long>, low array<long>")


def _table(keys: DataFrame, key: str, bits: int) -> np.ndarray:
    """``bit_table``, halved while that leaves ``SPARSE`` bits or more for each
    set one: every executor holds and stores each table."""
    table = bit_table(keys, key, bits)
    while len(table) > 1 and 2 * SPARSE * int(np.bitwise_count(table).sum()) <= 64 * len(table):
        half = len(table) // 2
        table = table[:half] | table[half:]
    return table


def _marks(nodes: DataFrame, bits: int) -> np.ndarray:
    """Bit table of the nodes' ids (``hid``, their hashes) and of ids and sets together."""
    return _table(nodes.select(F.explode(F.array(F.col("hid"), F.col("f").bitwiseXOR(F.col("hid")))).alias("key")), "key", bits)


def _marked(batch: pa.RecordBatch, table: np.ndarray, k: int):
    """Names and sets of the documents of a batch that ``_marks`` holds; texts of other ids are not shingled."""
    batch = batch.filter(pa.array(in_table(table, batch.column("hid").to_numpy().view(np.uint64))))
    hid = batch.column("hid").to_numpy().view(np.uint64)
    for w in W.split(batch.column("t"), lower=True):
        for i, u in enumerate(sets(w, k)):
            p = _print(u)
            key = np.array([p[0]], np.uint64) ^ hid[w.base + i:w.base + i + 1]
            if len(u) and in_table(table, key)[0]:
                yield _name(p), u


def _sets(docs: DataFrame, table, k: int) -> DataFrame:
    """``fp, tokens`` of the documents that ``_marks`` holds."""
    def run(batches):
        for batch in batches:
            fps, toks = [], []
            for fp, u in _marked(batch, table.value, k):
                fps.append(fp)
                toks.append(W.signed(u))
            yield pa.RecordBatch.from_arrays([pa.array(fps, pa.binary()), pa.array(toks, pa.list_(pa.int64()))], ["fp", "tokens"])

    return docs.select(F.xxhash64("id").alias("hid"), "t").mapInArrow(run, "fp binary, tokens array<long>")


def _distances(docs: DataFrame, pivots, rep_table, k: int, least: int) -> DataFrame:
    """``fp, n, pivot, shared`` for every document and pivot with a similarity of
    at least ``least`` percent."""
    def run(batches):
        keys, which, names, count = pivots.value
        size = np.bincount(which, minlength=count)
        small = np.zeros(1 << 18, np.uint64)       # a first look before the search
        b = keys & np.uint64((1 << 24) - 1)
        np.bitwise_or.at(small, (b >> np.uint64(6)).astype(np.int64), np.uint64(1) << (b & np.uint64(63)))
        for batch in batches:
            hid = batch.column("hid").to_numpy()
            out = ([], [], [], [])
            for w in W.split(batch.column("t"), lower=True):
                for i, u in enumerate(sets(w, k)):
                    v = u[in_table(small, u)]
                    lo, hi = np.searchsorted(keys, v, "left"), np.searchsorted(keys, v, "right")
                    m = hi - lo
                    if not m.sum():
                        continue
                    at = np.repeat(lo, m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
                    shared = np.bincount(which[at], minlength=count)
                    shared = np.where(100 * shared >= least * (len(u) + size - shared), shared, 0)
                    if not shared.any():
                        continue
                    p = _print(u)
                    key = np.array([p[0]], np.uint64) ^ hid[w.base + i:w.base + i + 1].view(np.uint64)
                    if not in_table(rep_table.value, key)[0]:
                        continue
                    for j in np.flatnonzero(shared):
                        out[0].append(_name(p))
                        out[1].append(len(u))
                        out[2].append(names[j])
                        out[3].append(int(shared[j]))
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.int64()),
                                              pa.array(out[2], pa.binary()), pa.array(out[3], pa.int64())],
                                             ["fp", "n", "pivot", "shared"])

    return docs.select(F.xxhash64("id").alias("hid"), "t").mapInArrow(
        run, "fp binary, n long, pivot binary, shared long")


def _crowds(nodes: DataFrame, crowd: int) -> DataFrame:
    """Nodes by the groups of ``crowd`` nodes or more that share a pair of
    minimum hashes: ``j, s, c`` and the node."""
    each = nodes.select("fp", "id", "f", "n", "copies", F.posexplode("sketch").alias("j", "s"))
    size = each.groupBy("j", "s").agg(F.count("*").alias("c"), F.max(F.struct("copies", "fp", "id", "f", "n")).alias("p"))
    return size.filter(F.col("c") >= crowd)


def _bounded(rows, pivots: int, shingles: int) -> list:
    out, total = [], 0
    for r in rows[:pivots]:
        if total + r.n <= shingles:
            out.append(r)
            total += r.n
    return out


def _centres(nodes: DataFrame, crowd: int, pivots: int, shingles: int) -> list:
    """One node of each crowd, the one with the most copies: the most crowded
    first, within the bounds."""
    rows = (_crowds(nodes, crowd).groupBy("p").agg(F.max("c").alias("c")).orderBy(F.desc("c"), "p").limit(pivots)
            .select("p.*").collect())
    return _bounded(rows, pivots, shingles)


def _members(nodes: DataFrame, crowd: int, pivots: int, shingles: int) -> list:
    """The nodes of all crowds, the most crowded first, within the bounds."""
    groups = _crowds(nodes, crowd).select("j", "s", "c")
    each = nodes.select("fp", "id", "f", "n", F.posexplode("sketch").alias("j", "s"))
    rows = (salted_join(each, groups, ["j", "s"], ["fp"]).groupBy("fp", "id", "f", "n").agg(F.max("c").alias("c"))
            .orderBy(F.desc("c"), "fp").limit(pivots).collect())
    return _bounded(rows, pivots, shingles)


def _measured(docs: DataFrame, chosen: list, schema, rep_table, k: int, percent: int, least: int, bits: int):
    """``fp, pivot, near, d`` of the documents within ``least`` percent of the
    chosen nodes."""
    spark = docs.sparkSession
    own = spark.createDataFrame([(r.f, r.id) for r in chosen], schema)
    table = spark.sparkContext.broadcast(_marks(own.withColumn("hid", F.xxhash64("id")), bits))
    names = {bytes(r.fp) for r in chosen}
    rows = _sets(docs, table, k).toArrow()       # the chosen nodes, and few wrong bits
    got = {fp: t.values.to_numpy().view(np.uint64) for fp, t in zip(rows["fp"].to_pylist(), rows["tokens"]) if fp in names}
    order = sorted(got)
    keys = np.concatenate([got[x] for x in order])
    which = np.repeat(np.arange(len(order), dtype=np.int32), [len(got[x]) for x in order])
    by = np.argsort(keys, kind="stable")
    held = spark.sparkContext.broadcast((keys[by], which[by], order, len(order)))
    sizes = spark.createDataFrame([(bytearray(x), len(got[x])) for x in order], "pivot binary, m long")
    d = _distances(docs, held, rep_table, k, least).join(F.broadcast(sizes), "pivot")       # bounded by ``pivots``
    union = F.col("n") + F.col("m") - F.col("shared")
    return materialize(d.select("fp", "pivot", (100 * F.col("shared") >= percent * union).alias("near"),
                                (1 - F.col("shared") / union).alias("d")).distinct(), "distances")


def _pivot_links(d: DataFrame) -> DataFrame:
    return d.filter("near").filter(F.col("fp") != F.col("pivot")).select(F.col("fp").alias("a"), F.col("pivot").alias("b"))


def _pivots(docs: DataFrame, reps: DataFrame, rep_table, k: int, percent: int, crowd: int, pivots: int, shingles: int,
            rounds: int, bits: int):
    """(links to pivots or None, nodes that need no further comparison)."""
    schema = reps.select("f", "id").schema
    centres = _centres(reps, crowd, pivots, shingles)
    if not centres:
        return None, None
    d = _measured(docs, centres, schema, rep_table, k, percent, 2 * percent - 100, bits)
    links = _pivot_links(d)
    pivot_names = d.select(F.col("pivot").alias("fp")).distinct()
    loose = reps
    for _ in range(rounds):
        reached = links.select(F.col("a").alias("fp")).union(links.select(F.col("b").alias("fp"))).union(pivot_names).distinct()
        loose = materialize(loose.join(reached, "fp", "left_anti"), "loose")
        more = _members(loose, crowd, pivots, shingles)
        if not more:
            break
        e = _measured(docs, more, schema, rep_table, k, percent, percent, bits)
        links = links.union(_pivot_links(e))
        pivot_names = pivot_names.union(e.select(F.col("pivot").alias("fp")).distinct())
    # a pivot's links are all known; so are those of a node near a centre whose window holds only pivots
    r = 1 - percent / 100
    ring = (d.filter(~F.col("near")).join(pivot_names.distinct(), "fp", "left_anti").groupBy("pivot")
            .agg(F.min("d").alias("ring")))
    near = d.filter("near").join(ring, "pivot", "left")       # at most one row per centre: small
    settled = near.filter(F.col("ring").isNull() | (F.col("d") + r < F.col("ring") - _EPS)).select("fp")
    return links, settled.union(pivot_names).distinct()


def _frequent(counts: DataFrame, limit: int, most: int) -> np.ndarray:
    rows = counts.filter(F.col("c") > limit).orderBy(F.desc("c"), "token").limit(most).select("token")
    return np.sort(rows.toArrow()["token"].to_numpy().view(np.uint64))


def _is_in(u: np.ndarray, sorted_keys: np.ndarray) -> np.ndarray:
    if not len(sorted_keys) or not len(u):
        return np.zeros(len(u), bool)
    at = np.minimum(np.searchsorted(sorted_keys, u), len(sorted_keys) - 1)
    return sorted_keys[at] == u


class _Prefixes:
    """Rows of nodes: the tokens of their prefix, its length and end."""

    SCHEMA = "fp binary, n int, p int, last long, tokens array<long>"

    def __init__(self):
        self.tokens, self.fp, self.n, self.p, self.last = [], [], [], [], []

    def add(self, tokens: np.ndarray, late: bool, fp: bytes, n: int, kept=None):
        self.tokens.append(W.signed(tokens if kept is None else tokens[kept]))
        self.fp.append(fp)
        self.n.append(n)
        self.p.append(len(tokens))
        self.last.append(int(tokens[-1] >> np.uint64(2)) | (int(late) << 62))

    def batch(self, *more: tuple[str, pa.Array]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(self.fp, pa.binary()), pa.array(self.n, pa.int32()), pa.array(self.p, pa.int32()),
             pa.array(self.last, pa.int64()), pa.array(self.tokens, pa.list_(pa.int64())), *[x for _, x in more]],
            ["fp", "n", "p", "last", "tokens", *[x for x, _ in more]])


def _regions(nodes: DataFrame, docs: DataFrame, k: int, percent: int, limit: int, most: int, bits: int) -> DataFrame:
    """Replicas of the open nodes: one row per shingle of the prefix that another
    node's prefix may hold too. A shingle that one node alone has pairs nothing,
    so it is counted in the prefix's length but opens no region."""
    spark = docs.sparkSession
    counts = materialize(nodes.select(F.explode("low").alias("token")).groupBy("token").agg(F.count("*").alias("c"))
                         .filter(F.col("c") > min(limit, 1)), "shingles")
    frequent = spark.sparkContext.broadcast(_frequent(counts, limit, most))

    def enough(low, n):
        light = low[~_is_in(low, frequent.value)]
        return light[:prefix(n, percent)] if len(light) >= prefix(n, percent) else None

    def short(batches):
        for batch in batches:
            low, n = batch.column("low"), batch.column("n").to_pylist()
            few = [enough(low[i].values.to_numpy().view(np.uint64), n[i]) is None for i in range(batch.num_rows)]
            yield batch.select(["hid", "f"]).filter(pa.array(few, pa.bool_()))

    table = spark.sparkContext.broadcast(_marks(nodes.select("low", "n", "hid", "f").mapInArrow(short, "hid long, f long"), bits))

    def rescan(batches):
        for batch in batches:
            out = _Prefixes()
            for fp, u in _marked(batch, table.value, k):
                n = len(u)
                late = _is_in(u, frequent.value)
                if n - late.sum() >= prefix(n, percent):
                    low = u[:prefix(n, percent) + n // 20 + 8]
                    if enough(low, n) is not None:
                        continue                # a wrong bit: ``run`` has it
                both = np.concatenate([u[~late], u[late]])[:prefix(n, percent)]
                out.add(both, len(both) > n - late.sum(), fp, n)
            yield out.batch()

    again = docs.select(F.xxhash64("id").alias("hid"), "t").mapInArrow(rescan, _Prefixes.SCHEMA)
    again = materialize(again.join(nodes.select("fp", "g").distinct(), "fp"), "late_prefixes")
    met = counts.filter("c > 1").select("token").union(again.select(F.explode("tokens").alias("token")))
    shared = spark.sparkContext.broadcast(_table(met, "token", bits))

    def run(batches):
        for batch in batches:
            out, at = _Prefixes(), []
            low = batch.column("low")
            n, fp = (batch.column(c).to_pylist() for c in ("n", "fp"))
            for i in range(batch.num_rows):
                u = enough(low[i].values.to_numpy().view(np.uint64), n[i])
                if u is not None:
                    kept = in_table(shared.value, u)
                    if kept.any():
                        out.add(u, False, fp[i], n[i], kept)
                        at.append(i)
            yield out.batch(("g", batch.column("g").take(pa.array(at, pa.int64()))))

    first = nodes.select("low", "n", "fp", "g").mapInArrow(run, _Prefixes.SCHEMA + ", g binary")
    columns = ["fp", "g", "n", "p", "last", F.explode("tokens").alias("token")]
    return first.select(*columns).union(again.select(*columns))


def _candidates(entries: DataFrame, percent: int) -> DataFrame:
    """Pairs of a region that are not connected yet and whose overlap can reach
    the threshold."""
    a = entries.select("token", *[F.col(c).alias(f"a{c}") for c in ("fp", "g", "n", "p", "last")])
    b = entries.select("token", *[F.col(c).alias(f"b{c}") for c in ("fp", "g", "n", "p", "last")])
    j = a.join(b, "token").filter(
        (F.col("afp") < F.col("bfp")) & (F.coalesce("ag", "afp") != F.coalesce("bg", "bfp"))
        & (100 * F.col("an") >= percent * F.col("bn")) & (100 * F.col("bn") >= percent * F.col("an")))
    # shared shingles of the prefix that ends first are all counted; ``room`` is what lies beyond it
    room = F.when(F.col("alast") < F.col("blast"), F.col("an") - F.col("ap")).when(
        F.col("alast") > F.col("blast"), F.col("bn") - F.col("bp")).otherwise(
        F.least(F.col("an") - F.col("ap"), F.col("bn") - F.col("bp")))
    g = j.select("afp", "bfp", room.alias("room"), (F.col("an") + F.col("bn")).alias("both")).groupBy("afp", "bfp").agg(
        F.count("*").alias("c"), F.max("room").alias("room"), F.max("both").alias("both"))
    return g.filter((100 + percent) * (F.col("c") + F.col("room")) >= percent * F.col("both")).select("afp", "bfp")


def _verify(pairs: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets reach the threshold."""
    a = found.select(F.col("fp").alias("afp"), F.col("tokens").alias("at"))
    b = found.select(F.col("fp").alias("bfp"), F.col("tokens").alias("bt"))

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("at"), batch.column("bt")):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("afp").filter(pa.array(keep, pa.bool_())),
                                              batch.column("bfp").filter(pa.array(keep, pa.bool_()))], ["a", "b"])

    return pairs.join(a, "afp").join(b, "bfp").select("afp", "bfp", "at", "bt").mapInArrow(run, "a binary, b binary")


def _open(rows: DataFrame, open_table, comp: DataFrame | None, bits: int) -> DataFrame:
    """The rows whose bit is set in ``open_table``, with the component ``g`` of
    each node, null for a node of its own; only the rows whose bit is set go
    through the join. Written once: four steps read it."""
    spark = rows.sparkSession
    table = None
    if comp is not None:
        key = F.conv(F.hex(F.substring("fp", 2, 7)), 16, 10).cast("long")
        table = spark.sparkContext.broadcast(_table(comp.select(key.alias("key")), "key", bits))

    def side(inside):
        def run(batches):
            for batch in batches:
                f, hid = (batch.column(c).to_numpy().view(np.uint64) for c in ("f", "hid"))
                batch = batch.filter(pa.array(in_table(open_table.value, f ^ hid)))
                if table is not None:
                    key = np.array([int.from_bytes(x[1:8], "big") for x in batch.column("fp").to_pylist()], np.uint64)
                    batch = batch.filter(pa.array(in_table(table.value, key) == inside))
                yield batch
        return run

    part = rows.filter("n > 0").select("n", "fp", "f", "low", F.xxhash64("id").alias("hid"))
    alone = part.mapInArrow(side(False), part.schema).withColumn("g", F.lit(None).cast("binary"))
    if comp is not None:
        some = part.mapInArrow(side(True), part.schema).join(comp, "fp", "left").select(*part.columns, "g")
        alone = alone.unionByName(some)
    return materialize(alone, "open_sets")


def link(docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = SHINGLE, percent: int = PERCENT,
         crowd: int = CROWD, pivots: int = PIVOTS, pivot_shingles: int = PIVOT_SHINGLES, rounds: int = ROUNDS,
         frequent: int = FREQUENT, max_frequent: int = MAX_FREQUENT, bits: int = TABLE_BITS):
    """(membership, nodes, links): ``row, id, n, fp`` per document, ``fp, id`` per
    node with its smallest id, and the links ``a, b`` between nodes: all links to pivots, and all links of the nodes that the
    pivots did not settle. Two nodes are connected by them if and only if
    they are connected by the links of all pairs."""
    spark = docs.sparkSession
    arrow_rows(spark, 500)
    d = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text).alias("t"))
    rows = materialize(_nodes(d, k, percent), "sets")
    reps = materialize(rows.filter("n > 0").groupBy("fp").agg(
        F.min("id").alias("id"), F.first("n").alias("n"), F.first("f").alias("f"), F.first("sketch").alias("sketch"),
        F.count("*").alias("copies")),
        "nodes")
    rep_key = F.col("f").bitwiseXOR(F.xxhash64("id"))
    rep_table = spark.sparkContext.broadcast(_table(reps.select(rep_key.alias("key")), "key", bits))
    links, settled = _pivots(d, reps, rep_table, k, percent, crowd, pivots, pivot_shingles, rounds, bits)
    open_nodes = reps if settled is None else reps.join(settled, "fp", "left_anti")
    open_nodes = materialize(open_nodes, "open")
    open_table = spark.sparkContext.broadcast(_table(open_nodes.select(rep_key.alias("key")), "key", bits))

    comp = None         # nodes that links to pivots connect need no pair among themselves
    if links is not None:
        comp = materialize(components(links).withColumnsRenamed({"id": "fp", "component": "g"}), "components")
    part = _open(rows, open_table, comp, bits)
    pairs = materialize(_candidates(_regions(part, d, k, percent, frequent, max_frequent, bits), percent), "pairs")
    ends = pairs.select(F.col("afp").alias("fp")).union(pairs.select(F.col("bfp").alias("fp"))).distinct()
    table = spark.sparkContext.broadcast(
        _marks(reps.join(ends, "fp", "left_semi").select("f", F.xxhash64("id").alias("hid")), bits))
    found = _sets(d, table, k).dropDuplicates(["fp"])
    exact = _verify(pairs, found, percent)
    links = exact if links is None else links.union(exact)
    return rows.select("row", "id", "n", "fp"), reps.select("fp", "id"), links


def _rooted(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``fp, id, root`` of every node; a component's root is its smallest name."""
    comp = components(links).withColumnRenamed("id", "fp")
    return nodes.join(comp, "fp", "left").select("fp", "id", F.coalesce("component", "fp").alias("root"))


def classes(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``id, n_shingles, component_id`` of every document: the smallest id that
    links reach, its own included."""
    members, nodes, links = link(docs, id_col, **options)
    root = _rooted(nodes, links)
    low = root.groupBy("root").agg(F.min("id").alias("component_id"))
    named = salted_join(root.select("fp", "root"), low, ["root"], ["fp"]).select("fp", "component_id")
    full = salted_join(members.filter("n > 0"), named, ["fp"], ["row"]).select("id", "n", "component_id")
    none = members.filter("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return full.union(none).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` without those of a component but its first (by id,
    rows without an id last, then by row), and all rows without shingles."""
    members, nodes, links = link(docs, id_col, **options)
    root = _rooted(nodes, links).select("fp", "root")
    own = salted_join(members.filter("n > 0"), root, ["fp"], ["row"])
    first = own.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("z"), "id", "row")).alias("m"))
    number, = fresh(docs, "_row")
    kept = first.select(F.col("m.row").alias(number)).union(members.filter("n = 0").select("row"))
    d = docs.withColumn(number, F.monotonically_increasing_id())
    return d.join(kept, number, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
