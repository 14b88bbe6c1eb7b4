"""Deterministic splits and samples (D*, H2, H3, H6, H9).

Rows are ordered inside each class by ``md5(id|seed)`` (then id): the order
does not depend on partitioning, so a split is reproducible after a
re-partition or a lost executor, and DuckDB can compute the same split.

A split needs no ranks, only the border of each class: the hash at the wanted rank
is found by counting digits of the hashes (``selection``: three aggregates over id
and class, a few numbers as result), and every row is compared with the border of
its class. The rows of the table are neither shuffled nor sorted. Rows with equal
ids fall on one side together. Where a rank of every row is wanted (folds),
``hash_rank`` ranks inside (class, hash bucket) and shifts the buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import hash_hex, hash_unit
from .ordered import null_safe_join, running_totals
from .selection import select_ranks, with_own


def hash_rank(df: DataFrame, id_col: str, by: Sequence[str], seed, hex_digits: int = 3,
              name: str = "_rank") -> DataFrame:
    """1-based rank of each row within ``by`` under ``(md5(id|seed), id)``.

    Also adds ``_class_n`` (rows in the group). Rows with a null label form a
    class of their own.
    """
    by = list(by)
    h = hash_hex(F.col(id_col), seed)
    t = (df.withColumn("_h", h)
         .withColumn("_hb", F.conv(F.substring("_h", 1, hex_digits), 16, 10).cast("int")))
    sizes = t.groupBy(*by, "_hb").agg(F.count(F.lit(1)).alias("_bn"))
    before = Window.partitionBy(*by).orderBy("_hb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*by, "_hb",
                           F.coalesce(F.sum("_bn").over(before), F.lit(0)).alias("_off"),
                           F.sum("_bn").over(Window.partitionBy(*by)).alias("_class_n"))
    inner = Window.partitionBy(*by, "_hb").orderBy("_h", id_col)
    return (t.withColumn("_rn", F.row_number().over(inner))
            .transform(lambda d: null_safe_join(d, offsets, by, ["_hb"]))
            .withColumn(name, F.col("_off") + F.col("_rn"))
            .drop("_h", "_hb", "_rn", "_off"))


def _hashed(df: DataFrame, id_col: str, seed) -> DataFrame:
    """Add ``_h``, the hash of the id, and ``_v``, its first 60 bits as a long."""
    return (df.withColumn("_h", hash_hex(F.col(id_col), seed))
            .withColumn("_v", F.conv(F.substring("_h", 1, 15), 16, 10).cast("long")))


def _first(df: DataFrame, rows: DataFrame, id_col: str, by: Sequence[str], seed, quota: Column, name: str) -> DataFrame:
    """Add ``name``: whether a row of ``df`` is at or before place ``quota`` (an expression of
    ``m``, the rows of the class) of its class in the hash order of ``rows``."""
    by = list(by)
    names = {c: f"_g{i}" for i, c in enumerate(by)}
    src = _hashed(rows.select(*[F.col(f"`{c}`").alias(g) for c, g in names.items()], F.col(f"`{id_col}`").alias("_id")), "_id", seed)
    group = [*names.values(), "_one"]
    src = src.withColumn("_one", F.lit(1))
    found = select_ranks(src.select(*group, "_v"), group, F.array(quota.cast("long") - 1))
    per = {}
    for x in found:
        tie = None
        if x["below"] + x["same"] > x["r"] + 1:     # the border parts rows with the same 60 bits
            here = F.col("_v") == x["key"]
            for g in group:
                here = here & F.col(g).eqNullSafe(F.lit(x[g]))
            place = Window.orderBy("_h", "_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
            same = src.filter(here).groupBy("_h", "_id").agg(F.count(F.lit(1)).alias("n"))
            at = (same.withColumn("_c", F.sum("n").over(place)).filter(F.col("_c") > x["r"] - x["below"])
                  .orderBy("_h", "_id").first())
            tie = (at["_h"], at["_id"])
        per[tuple(x[g] for g in names.values())] = [(x["key"], *(tie or (None, None)))]
    id_type = df.schema[id_col].dataType.simpleString()
    out = with_own(_hashed(df, id_col, seed), by, per, {"v": "bigint", "h": "string", "i": id_type}, "_border")
    b = F.get("_border", F.lit(0))
    before = F.struct(F.col("_h"), F.col(f"`{id_col}`")) <= F.struct(b["h"], b["i"])
    inside = (F.col("_v") < b["v"]) | ((F.col("_v") == b["v"]) & (b["h"].isNull() | before))
    return out.withColumn(name, F.coalesce(inside, F.lit(False))).drop("_h", "_v", "_border")


def _share(fraction: float) -> Column:
    return F.round(F.col("m") * F.lit(float(fraction)))


def stratified_split(df: DataFrame, id_col: str, y: str, test_fraction: float = 0.2,
                     seed=42, name: str = "split") -> DataFrame:
    """Add ``split`` = 'test' for exactly round(test_fraction * n_class) rows per class."""
    r = _first(df, df, id_col, [y], seed, _share(test_fraction), "_in")
    return r.withColumn(name, F.when(F.col("_in"), "test").otherwise("train")).drop("_in")


def three_way_split(df: DataFrame, id_col: str, y: str, test_fraction: float = 0.2,
                    val_fraction: float = 0.25, seed=42, name: str = "split") -> DataFrame:
    """Test first, then validation cut from the remainder (per class, exact)."""
    s = _first(df, df, id_col, [y], seed, _share(test_fraction), "_test")
    rest = s.filter(~F.col("_test")).select(id_col, y)
    v = _first(s, rest, id_col, [y], f"{seed}|val", _share(val_fraction), "_val")
    return (v.withColumn(name, F.when(F.col("_test"), "test").when(F.col("_val"), "validation").otherwise("train"))
            .drop("_test", "_val"))


def stratified_subsample(df: DataFrame, id_col: str, y: str, fraction: float, seed=42,
                         where: str | None = None) -> DataFrame:
    """Keep round(fraction * n_class) rows per class of the rows matching
    ``where`` (the training part); other rows are kept unchanged."""
    part = df.filter(F.expr(where)) if where else df
    r = _first(df, part.select(id_col, y), id_col, [y], f"{seed}|sub", _share(fraction), "_in")
    other = F.coalesce(~F.expr(where), F.lit(True)) if where else F.lit(False)
    return r.filter(F.col("_in") | other).drop("_in")


def even_sample(df: DataFrame, id_col: str, max_rows: int, chunk: int = 100_000,
                seed: int = 42) -> DataFrame:
    """At most ``max_rows`` rows spread evenly over the id order.

    Rows are numbered by id; chunk ``c`` (``chunk`` rows) receives
    ``bround(max_rows * seen / total) - selected`` rows, chosen by a hash order
    inside the chunk (a chunk is bounded by ``chunk`` rows). When the table
    has at most ``max_rows`` rows all of them are returned.
    """
    one = df.withColumn("_one", F.lit(1).cast("long"))
    num = running_totals(one, id_col, ["_one"], prefix="_rn")       # _rn_one = 1-based id rank
    total = df.agg(F.count(F.lit(1))).scalar()
    t = (num.withColumn("_total", total)
         .withColumn("_chunk", F.floor((F.col("_rn_one") - 1) / chunk).cast("long")))
    seen = F.least((F.col("_chunk") + 1) * chunk, F.col("_total"))
    prev = F.col("_chunk") * chunk
    cum = F.bround(F.lit(float(max_rows)) * seen / F.col("_total")).cast("long")
    cum_prev = F.bround(F.lit(float(max_rows)) * prev / F.col("_total")).cast("long")
    t = t.withColumn("_quota", cum - cum_prev)
    inner = Window.partitionBy("_chunk").orderBy(hash_hex(F.col(id_col), seed), id_col)
    t = t.withColumn("_r", F.row_number().over(inner))
    keep = (F.col("_total") <= max_rows) | (F.col("_r") <= F.col("_quota"))
    return t.filter(keep).select(*df.columns)


def head(df: DataFrame, id_col: str, n: int) -> DataFrame:
    """First ``n`` rows by id (smoke runs); the limit is the feature."""
    return df.orderBy(id_col).limit(n)


# --- guide extras -----------------------------------------------------------------

def kfold(df: DataFrame, id_col: str, y: str, k: int = 5, seed=42, name: str = "fold") -> DataFrame:
    """Stratified K-fold: fold = (rank within class - 1) mod k."""
    r = hash_rank(df, id_col, [y], f"{seed}|fold")
    return r.withColumn(name, ((F.col("_rank") - 1) % k).cast("int")).drop("_rank", "_class_n")


def undersample(df: DataFrame, id_col: str, y: str, seed=42) -> DataFrame:
    """Every class cut to the minority class size (hash order inside a class)."""
    minority = df.groupBy(y).agg(F.count(F.lit(1)).alias("n")).agg(F.min("n")).first()[0]
    r = _first(df, df, id_col, [y], f"{seed}|under", F.lit(minority), "_in")
    return r.filter("_in").drop("_in")


def group_split(df: DataFrame, group_col: str, test_fraction: float = 0.2, seed=42,
                name: str = "split") -> DataFrame:
    """All rows of a group land on the same side: decided by a hash of the group."""
    return df.withColumn(name, F.when(hash_unit(F.col(group_col), f"{seed}|group") < test_fraction, "test")
                         .otherwise("train"))


def temporal_split(df: DataFrame, ts: str, cuts: Sequence[str], name: str = "split",
                   labels: Sequence[str] = ("train", "validation", "test")) -> DataFrame:
    """Past -> train, later -> validation, newest -> test, by date cut points."""
    if len(labels) != len(cuts) + 1:
        raise ValueError("need one more label than cut points")
    c = F.col(ts)
    expr = F.when(c.isNull(), F.lit(None))
    for cut, label in zip(cuts, labels):
        expr = expr.when(c < F.lit(cut).cast(df.schema[ts].dataType), label)
    return df.withColumn(name, expr.otherwise(labels[-1]))
