"""Input drift of all features from mergeable count sketches.

A sketch counts rows by (feature, bin): a number falls in the bin of the cut points
below it (exact quantiles of the base table), a category in its level, or in
``<other>`` if the base did not have it among its commonest, a null in ``<null>``. Sketches
of days, batches or files add up, so a stream stores one small table a batch and gives
the same numbers as one pass over everything. The stability index of all features is
one join of two sketches.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import exact_quantiles, named, null_safe_join, sql_text

NULL, OTHER = "<null>", "<other>"


@dataclass(frozen=True)
class Layout:
    """Cut points of numeric features and kept levels of categories, from the base table."""
    cuts: dict[str, list[float]]
    levels: dict[str, list[str]]


def layout(base: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (), bins: int = 10,
           max_levels: int = 200) -> Layout:
    """Bins of every feature. At most ``max_levels`` levels of a category are kept, the
    commonest first, ties by name."""
    cuts: dict[str, list[float]] = {c: [] for c in numeric}
    if numeric:
        for r in exact_quantiles(base, list(numeric), [i / bins for i in range(1, bins)]).collect():
            cuts[r["feature"]].append(r["value"])
    levels: dict[str, list[str]] = {}
    for c in categorical:
        top = (base.select(named(c).cast("string").alias("v")).filter("v is not null").groupBy("v").count()
               .orderBy(F.desc("count"), "v").limit(max_levels))
        levels[c] = sorted(r.v for r in top.collect())
    return Layout({c: sorted(v) for c, v in cuts.items()}, levels)


def _bin(lay: Layout, c: str) -> Column:
    if c in lay.cuts:
        x = named(c).cast("double")
        below = sum((F.when(x > F.lit(v), 1).otherwise(0) for v in lay.cuts[c]), F.lit(0))
        return F.when(x.isNull(), NULL).otherwise(below.cast("string"))
    x = named(c).cast("string")
    return F.when(x.isNull(), NULL).when(x.isin(lay.levels[c]), x).otherwise(OTHER)


def sketch(df: DataFrame, lay: Layout, by: Sequence[str] = ()) -> DataFrame:
    """``by..., feature, bin, n``: one pass over the table, combined before the shuffle."""
    names = [*lay.cuts, *lay.levels]
    binned = df.select(*by, *[_bin(lay, c).alias(f"_b{i}") for i, c in enumerate(names)])
    pairs = ", ".join(f"'{sql_text(c)}', `_b{i}`" for i, c in enumerate(names))
    long = binned.select(*by, F.expr(f"stack({len(names)}, {pairs}) as (feature, bin)"))
    return long.groupBy(*by, "feature", "bin").agg(F.count(F.lit(1)).alias("n"))


def merge(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches added up (over everything that is not in ``by``)."""
    return sketches.groupBy(*by, "feature", "bin").agg(F.sum("n").alias("n"))


def psi(base: DataFrame, current: DataFrame, by: Sequence[str] = (), eps: float = 1e-6) -> DataFrame:
    """``by..., feature, rows, psi`` of every feature of ``current`` (a sketch, per group of
    ``by``) against the sketch ``base``. Bins that one side lacks count with share ``eps``."""
    by = list(by)
    b = base.join(base.groupBy("feature").agg(F.sum("n").alias("_t")), "feature").select(
        "feature", "bin", (F.col("n") / F.col("_t")).alias("_p"))
    totals = current.groupBy(*by, "feature").agg(F.sum("n").alias("rows"))
    # every bin of the base for every group, then the bins that only the group has
    seats = totals.join(b, "feature").select(*by, "feature", "bin", "_p", F.lit(0).cast("long").alias("n"))
    rows = seats.unionByName(current.select(*by, "feature", "bin", F.lit(0.0).alias("_p"), "n"))
    rows = rows.groupBy(*by, "feature", "bin").agg(F.max("_p").alias("_p"), F.sum("n").alias("n"))
    j = null_safe_join(rows, totals, [*by, "feature"])
    p = F.greatest(F.col("_p"), F.lit(eps))
    q = F.greatest(F.col("n") / F.col("rows"), F.lit(eps))
    return j.groupBy(*by, "feature").agg(F.max("rows").alias("rows"), F.sum((q - p) * F.log(q / p)).alias("psi"))
