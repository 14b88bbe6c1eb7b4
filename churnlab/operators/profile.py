"""Profiling aggregates (the EDA tables), each one job over all columns.

The reference loops over columns and runs one pandas pass per column. Here
every profile is one wide aggregate (or one ``stack`` + grouped aggregate)
for all columns together. Quantiles are exact and distributed
(``ordered.exact_quantiles``); bounds that a second pass needs (IQR fences,
histogram ranges) are planned as scalar subqueries, so the table is not
joined to anything and nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ordered import exact_quantiles, named, quantile_columns, sql_text

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, _NUMERIC) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def _rnd(c, digits):
    return c if digits is None else F.round(c, digits)


def _stack(cols: Sequence[str], cast: str | None = None, name="feature", value="value"):
    items = ", ".join(f"'{sql_text(c)}', " + (f"cast(`{c}` as {cast})" if cast else f"`{c}`") for c in cols)
    return F.expr(f"stack({len(cols)}, {items}) as ({name}, {value})")


# --- A4 / B1 --------------------------------------------------------------

def shape(df: DataFrame) -> DataFrame:
    """``(rows, columns)``."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


# --- B3, B10, B11 -----------------------------------------------------------

def missing(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Missing count and ratio per column: ``(column, missing, ratio)``."""
    cols = list(cols or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("_n"),
                  *[F.sum(named(c).isNull().cast("long")).alias(c) for c in cols])
    long = wide.select("_n", _stack(cols, "long", value="missing"))
    return long.select("feature", "missing", (F.col("missing") / F.col("_n")).alias("ratio"))


def non_null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(column, non_null)``."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count(F.col(c)).alias(c) for c in cols])
    return wide.select(_stack(cols, "long", value="non_null"))


def distinct_counts(df: DataFrame, cols: Sequence[str], approx: bool = False,
                    rsd: float = 0.01) -> DataFrame:
    """Distinct non-null values per column: ``(column, n_distinct)``.

    Exact: one ``stack`` to (column, value) pairs, a distinct with map-side
    combine, then a count per column -- no Expand per column. ``approx``: one
    HyperLogLog++ aggregate per column in a single pass.
    """
    cols = list(cols)
    if approx:
        wide = df.agg(*[F.approx_count_distinct(c, rsd).alias(c) for c in cols])
        return wide.select(_stack(cols, "long", value="n_distinct"))
    long = df.select(_stack(cols, "string")).filter(F.col("value").isNotNull())
    return (long.distinct().groupBy("feature")
            .agg(F.count(F.lit(1)).alias("n_distinct")))


# --- B4, B5 ---------------------------------------------------------------

def duplicate_count(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Rows that repeat an earlier row on ``keys`` (all columns when None)."""
    keys = list(keys or df.columns)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
            .agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0).cast("long")).alias("duplicates")))


# --- B6, B7, B21 ------------------------------------------------------------

def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float] = (0.25, 0.75),
              by: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles, wide: ``(by..., column, q25, q75, ...)``."""
    return quantile_columns(df, cols, probs, by)


def _fences(df: DataFrame, cols: Sequence[str], k: float) -> DataFrame:
    """One row per column; read twice (bounds map, final join), so kept once."""
    from ..session import reuse
    q = quantile_columns(df, cols, (0.25, 0.5, 0.75), names=("q1", "median", "q3"))
    iqr = F.col("q3") - F.col("q1")
    return reuse(q.select("feature", "q1", "median", "q3",
                          (F.col("q1") - k * iqr).alias("lower"), (F.col("q3") + k * iqr).alias("upper")))


def _as_map(fences: DataFrame, fields: Sequence[str]):
    """All per-column bounds as one map value, evaluated once (scalar subquery)."""
    entry = F.struct(F.col("feature"), F.struct(*fields))
    return fences.agg(F.map_from_entries(F.collect_list(entry))).scalar()


def iqr_outliers(df: DataFrame, cols: Sequence[str], k: float = 1.5,
                 digits: int | None = 2) -> DataFrame:
    """IQR outliers per column (strict ``<`` / ``>``), share of **all** rows.

    ``(column, q1, q3, lower, upper, outlier_count, outlier_pct)``.
    """
    cols = list(cols)
    fences = _fences(df, cols, k)
    bounds = _as_map(fences, ["lower", "upper"])
    tagged = df.select(*cols).withColumn("_f", bounds)
    wide = tagged.agg(F.count(F.lit(1)).alias("_n"), *[
        F.count(F.when((F.col(c) < F.col("_f")[c]["lower"]) | (F.col(c) > F.col("_f")[c]["upper"]),
                       F.lit(1))).alias(c) for c in cols])
    counts = wide.select("_n", _stack(cols, "long", value="outlier_count"))
    return (fences.join(counts, "feature")
            .select("feature", "q1", "q3", "lower", "upper", "outlier_count",
                    _rnd(F.col("outlier_count") / F.col("_n") * 100, digits).alias("outlier_pct")))


def box_stats(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """Box-plot statistics: quartiles, whiskers (extreme values inside the fences).

    ``(column, q1, median, q3, whisker_low, whisker_high, n_outliers)``.
    """
    cols = list(cols)
    fences = _fences(df, cols, k)
    bounds = _as_map(fences, ["lower", "upper"])
    tagged = df.select(*cols).withColumn("_f", bounds)
    aggs = []
    for c in cols:
        lo, hi = F.col("_f")[c]["lower"], F.col("_f")[c]["upper"]
        inside = (F.col(c) >= lo) & (F.col(c) <= hi)
        aggs += [F.min(F.when(inside, F.col(c).cast("double"))).alias(f"{c}__lo"),
                 F.max(F.when(inside, F.col(c).cast("double"))).alias(f"{c}__hi"),
                 F.count(F.when(~inside, F.lit(1))).alias(f"{c}__out")]
    wide = tagged.agg(*aggs)
    items = ", ".join(f"'{c}', `{c}__lo`, `{c}__hi`, `{c}__out`" for c in cols)
    long = wide.select(F.expr(f"stack({len(cols)}, {items}) as (feature, whisker_low, whisker_high, n_outliers)"))
    return fences.join(long, "feature").select("feature", "q1", "median", "q3", "whisker_low",
                                              "whisker_high", "n_outliers")


# --- B8 -------------------------------------------------------------------

def histogram(df: DataFrame, cols: Sequence[str], bins: int = 30) -> DataFrame:
    """Equal-width histogram per column, last bin closed, empty bins kept.

    The range of a constant column is widened by 0.5 on both sides.

    ``(column, bin, lo, hi, n)``; bin = least(floor((v-min)*bins/(max-min)), bins-1).
    """
    cols = list(cols)
    from ..session import reuse
    rng = reuse(df.agg(*[F.struct(F.min(F.col(c).cast("double")).alias("mn"),
                                  F.max(F.col(c).cast("double")).alias("mx")).alias(c) for c in cols])
                .select(_stack(cols, None, value="r"))
                .select("feature", F.when(F.col("r.mn") == F.col("r.mx"), F.col("r.mn") - 0.5).otherwise(F.col("r.mn")).alias("mn"),
                        F.when(F.col("r.mn") == F.col("r.mx"), F.col("r.mx") + 0.5).otherwise(F.col("r.mx")).alias("mx")))
    bounds = rng.agg(F.map_from_entries(F.collect_list(F.struct("feature", F.struct("mn", "mx"))))).scalar()
    tagged = df.select(*cols).withColumn("_r", bounds)

    def bin_of(c):
        mn, mx = F.col("_r")[c]["mn"], F.col("_r")[c]["mx"]
        v = F.col(c).cast("double")
        raw = F.floor((v - mn) * bins / (mx - mn))
        return F.when(v.isNull(), F.lit(None)).otherwise(F.least(raw, F.lit(bins - 1))).cast("int")

    items = ", ".join(f"'{c}', `{c}`" for c in cols)
    binned = tagged.select(*[bin_of(c).alias(c) for c in cols])
    counts = (binned.select(F.expr(f"stack({len(cols)}, {items}) as (feature, bin)"))
              .filter(F.col("bin").isNotNull())
              .groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n")))
    grid = rng.select("feature", "mn", "mx", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("mx") - F.col("mn")) / bins
    return (grid.join(counts, ["feature", "bin"], "left")
            .select("feature", "bin",
                    (F.col("mn") + F.col("bin") * width).alias("lo"),
                    (F.col("mn") + (F.col("bin") + 1) * width).alias("hi"),
                    F.coalesce(F.col("n"), F.lit(0).cast("long")).alias("n")))


# --- B9, B20 ----------------------------------------------------------------

def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Category frequency per column, nulls dropped: ``(column, value, n)``."""
    cols = list(cols)
    return (df.select(_stack(cols, "string")).filter(F.col("value").isNotNull())
            .groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")))


def date_extremes(df: DataFrame, col: str) -> DataFrame:
    """Distinct dates and the most / least frequent one (ties: earliest date)."""
    per = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    agg = per.agg(F.count(F.lit(1)).alias("n_distinct"),
                  F.min(F.struct((-F.col("n")).alias("k"), F.col(col).alias("d"))).alias("top"),
                  F.min(F.struct(F.col("n").alias("k"), F.col(col).alias("d"))).alias("bottom"))
    return agg.select("n_distinct", F.col("top.d").alias("top_date"), (-F.col("top.k")).alias("top_n"),
                      F.col("bottom.d").alias("bottom_date"), F.col("bottom.k").alias("bottom_n"))


# --- B12, B22 ---------------------------------------------------------------

def rate_by_category(df: DataFrame, cols: Sequence[str], y: str,
                     digits: int | None = 2) -> DataFrame:
    """Churn rate per category value: ``(column, value, n, rate, rate_pct)``."""
    cols = list(cols)
    long = df.select(F.col(y).alias("_y"), _stack(cols, "string")).filter(F.col("value").isNotNull())
    return (long.groupBy("feature", "value")
            .agg(F.count(F.lit(1)).alias("n"), F.avg("_y").alias("rate"))
            .withColumn("rate_pct", _rnd(F.col("rate") * 100, digits)))


def rate_spread(df: DataFrame, cols: Sequence[str], y: str) -> DataFrame:
    """Influence spread: max minus min churn rate over a column's categories."""
    r = rate_by_category(df, cols, y, digits=None)
    return r.groupBy("feature").agg(F.min("rate").alias("min_rate"), F.max("rate").alias("max_rate"),
                                   (F.max("rate") - F.min("rate")).alias("spread"))


# --- B13, B14, B23 -------------------------------------------------------------

def stats_by_target(df: DataFrame, cols: Sequence[str], y: str,
                    digits: int | None = 2) -> DataFrame:
    """Mean, median, sample std, min, max per column and class.

    ``(column, <y>, mean, median, std, min, max)``.
    """
    cols = list(cols)
    long = df.select(F.col(y), _stack(cols, "double"))
    base = (long.groupBy("feature", y)
            .agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
                 F.min("value").alias("min"), F.max("value").alias("max")))
    med = (exact_quantiles(df, cols, (0.5,), by=[y])
           .select("feature", y, F.col("value").alias("median")))
    out = base.join(med, ["feature", y], "left")
    return out.select("feature", y, *[_rnd(F.col(c), digits).alias(c)
                                     for c in ("mean", "median", "std", "min", "max")])


def class_means(df: DataFrame, cols: Sequence[str], y: str, digits: int | None = 2,
                names: Sequence[str] = ("retained_mean", "churned_mean")) -> DataFrame:
    """``feature`` and the mean of each column among the rows of class 0 and of class 1
    (B23): one aggregate, null where a class has no value."""
    long = df.select(F.col(y).alias("_y"), _stack(list(cols), "double"))
    return long.groupBy("feature").agg(*[
        _rnd(F.avg(F.when(F.col("_y") == k, F.col("value"))), digits).alias(n) for k, n in enumerate(names)])


def mean_contrast(df: DataFrame, cols: Sequence[str], y: str,
                  digits: int | None = 2) -> DataFrame:
    """Retained vs churned mean, their difference and percent difference.

    As in the reference the difference is taken **from the rounded means**;
    the percentage is null when the retained mean is 0.
    """
    w = class_means(df, cols, y, digits, ("mean_0", "mean_1"))
    diff = F.col("mean_1") - F.col("mean_0")
    return w.select("feature", "mean_0", "mean_1", _rnd(diff, digits).alias("diff"),
                    F.when(F.col("mean_0") != 0, _rnd(diff / F.col("mean_0") * 100, digits)).alias("diff_pct"))


# --- B15, B16 ---------------------------------------------------------------

def corr_with_target(df: DataFrame, cols: Sequence[str], y: str) -> DataFrame:
    """Pearson correlation of each column with the target (null pairs dropped).

    ``(column, corr, abs_corr)``; order by ``abs_corr`` desc for the report.
    """
    cols = list(cols)
    wide = df.agg(*[F.corr(F.col(c).cast("double"), F.col(y).cast("double")).alias(c) for c in cols])
    return (wide.select(_stack(cols, "double", value="corr"))
            .withColumn("abs_corr", F.abs("corr")))


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """All-pairs Pearson correlation in one aggregate: ``(a, b, r)`` both orders."""
    cols = list(cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}__{b}")
                    for a, b in pairs])
    items = ", ".join(f"'{a}', '{b}', `{a}__{b}`" for a, b in pairs)
    tri = wide.select(F.expr(f"stack({len(pairs)}, {items}) as (a, b, r)"))
    mirror = tri.filter(F.col("a") != F.col("b")).select(F.col("b").alias("a"), F.col("a").alias("b"), "r")
    return tri.unionByName(mirror)


# --- B17, B18, B19 ----------------------------------------------------------

def class_balance(df: DataFrame, y: str, digits: int | None = 2) -> DataFrame:
    """``(<y>, n, pct)`` -- class counts and share of all rows."""
    per = df.groupBy(y).agg(F.count(F.lit(1)).alias("n"))
    total = Window.partitionBy()  # two rows (one per class): a trivial window
    return per.withColumn("pct", _rnd(F.col("n") / F.sum("n").over(total) * 100, digits))


def imbalance(df: DataFrame, y: str, digits: int | None = 2) -> DataFrame:
    """Majority / minority class ratio."""
    per = df.groupBy(y).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.max("n").alias("majority"), F.min("n").alias("minority"),
                   _rnd(F.max("n") / F.min("n"), digits).alias("ratio"))


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, sample std, min, exact quartiles, max per column."""
    cols = list(cols)
    long = df.select(_stack(cols, "double"))
    base = (long.groupBy("feature")
            .agg(F.count("value").alias("count"), F.avg("value").alias("mean"),
                 F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
                 F.max("value").alias("max")))
    q = quantile_columns(df, cols, (0.25, 0.5, 0.75), names=("q25", "q50", "q75"))
    return base.join(q, "feature", "left").select("feature", "count", "mean", "std", "min",
                                                  "q25", "q50", "q75", "max")
