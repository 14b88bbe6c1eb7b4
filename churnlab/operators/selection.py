"""Rows at given ranks by counting digits (radix selection).

The row at a rank is found without sorting: keys are 64-bit integers, and each of
three passes counts the next digit of the keys that are still in question (20,
22 and 22 bits). A pass is one map-side combined aggregate; at most 2^22 counts of a
group meet in one task, whatever the number of rows, and rows are never shuffled.
All columns, groups and ranks take part in the same passes. What one pass hands to
the next is a few numbers per group and rank; like ``DataFrame.approxQuantile`` the
passes run when the function is called, on an input that the caller keeps or that is
cheap to read again.

Groups are those of a report (labels, models, segments): beyond ``MAX_ENTRIES``
group ranks an error names the limit (``ordered`` has a join form for more).
"""

from __future__ import annotations

import struct
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import compiled_methods

SHIFTS = (44, 22, 0)
MAX_ENTRIES = 1 << 14
MAX_RANGES = 256            # prefixes that are compared one by one


def sort_key(df: DataFrame, value: str, name: str) -> DataFrame:
    """Add ``name``: a long in the order of the double column ``value`` (its IEEE
    bits, built from exact operations), null for null. Both zeros are 0; NaN is
    the largest, as in Spark's order."""
    normal = f"(_sk_a >= double('{2.0 ** -1022!r}') and _sk_a < double('Infinity'))"
    # the logarithm may be rounded across a power of two
    return (df.selectExpr("*", f"abs(`{value}`) as _sk_a")
            .selectExpr("*", f"case when {normal} then greatest(floor(log2(_sk_a)), -1022L) end as _sk_f")
            .selectExpr("*", f"""case when {normal} then _sk_f - cast(_sk_a < power(2D, _sk_f) as bigint)
                                 + cast(_sk_a >= power(2D, _sk_f + 1) as bigint) end as _sk_e""")
            .selectExpr("*", f"""case when isnan(_sk_a) then {0x7FF8 << 48}L when _sk_a = double('Infinity') then {0x7FF << 52}L
                when {normal} then shiftleft(_sk_e + 1023, 52) + cast((_sk_a / power(2D, _sk_e) - 1) * {2.0 ** 52!r}D as bigint)
                else cast(_sk_a * double('{2.0 ** 1000!r}') * double('{2.0 ** 74!r}') as bigint) end as _sk_b""")
            .selectExpr("*", f"case when `{value}` < 0 then -_sk_b else _sk_b end as {name}")
            .drop("_sk_a", "_sk_f", "_sk_e", "_sk_b"))


def key_value(key: Column) -> Column:
    """The double whose ``sort_key`` is ``key``."""
    k = F.abs(key)
    e, m = F.shiftright(k, 52), k.bitwiseAND(F.lit((1 << 52) - 1)).cast("double")
    v = (F.when(e == 2047, F.when(m == 0, float("inf")).otherwise(float("nan")))
         .when(e == 0, m * 2.0 ** -1000 * 2.0 ** -74)
         .otherwise((1 + m / 2.0 ** 52) * F.pow(F.lit(2.0), e - 1023)))
    return F.when(key < 0, -v).otherwise(v)


def _double(key: int) -> float:
    """The double of a key, on the driver."""
    v = struct.unpack("<d", struct.pack("<q", min(abs(key), 0x7FF8 << 48)))[0]
    return -v if key < 0 else v


def _range(known: dict, group: Sequence[str], prev: int | None, exact: bool) -> Column:
    """Rows with a prefix in question, as comparisons of the plain column ``_v`` (they
    reach the scan; the key is built for the rows that pass alone)."""
    def bound(k):
        return f"double('{_double(k)!r}')" if exact else f"{k}L" if -1 << 63 < k else "(-9223372036854775807L - 1L)"
    ranges: dict[tuple, list[str]] = {}
    for e in known.values():
        low = 0 if prev is None else e["p"] << prev
        ranges.setdefault(tuple(e["group"]), []).append(
            "true" if prev is None else f"(_v >= {bound(low)} and _v <= {bound(low + (1 << prev) - 1)})")
    out = F.lit(False)
    for values, parts in ranges.items():
        here = F.expr(" or ".join(sorted(set(parts))))
        for g, v in zip(group, values):
            here = F.col(g).eqNullSafe(F.lit(v)) & here
        out = out | here
    return out


def _counted(src: DataFrame, group: Sequence[str], prev: int | None, shift: int, known: dict | None,
             ranks: Column | None) -> DataFrame:
    """One digit: ``group, p`` (the digits so far), ``n`` rows, ``m`` rows of the group,
    ``ws``: the ranks found there, ``r`` in the group and ``o`` among the rows of ``p``, and
    ``h``, a hash of group and digits. ``known`` holds by that hash what the digits before gave."""
    exact = isinstance(src.schema["_v"].dataType, T.DoubleType)
    rows = src
    if known is not None and len(known) <= MAX_RANGES:
        rows = src.filter(_range(known, group, prev, exact))
    rows = sort_key(rows, "_v", "_k") if exact else rows.withColumn("_k", F.col("_v"))
    digit = F.shiftright("_k", shift).alias("_d")
    if known is None:
        t = rows.groupBy(*group, digit).agg(F.count(F.lit(1)).alias("n"))
        w = Window.partitionBy(*group)
        total = F.sum("n").over(w).alias("m")
        t = t.select("*", total).withColumn("_w", F.transform(ranks, lambda r: F.struct(r.cast("long").alias("r"), r.cast("long").alias("o"))))
    else:
        prefix = F.shiftright("_k", prev) if prev is not None else F.lit(0).cast("long")
        t = rows.groupBy(*group, prefix.alias("_p"), digit).agg(F.count(F.lit(1)).alias("n"))
        w = Window.partitionBy(*group, "_p")
        entries = ", ".join(f"{h}L, named_struct('p', {e['p']}L, 'm', {e['m']}L, 'ws', array(" + ", ".join(
            f"named_struct('r', {r}L, 'o', {o}L)" for r, o in e["ws"]) + "))" for h, e in known.items())
        own = F.expr(f"map({entries})".replace("-9223372036854775808L", "(-9223372036854775807L - 1L)"))
        t = t.select("*", own[F.xxhash64(*group, "_p")].alias("_x")).filter("_x.p = _p").select("*", "_x.m", F.col("_x.ws").alias("_w"))
    run = w.orderBy("_d").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (t.select("*", F.sum("n").over(run).alias("_cum"))
            .selectExpr(*[f"`{g}`" for g in group], "_d as p", "n", "m", """transform(filter(_w, x -> x.o >= _cum - n and x.o < _cum),
                x -> named_struct('r', x.r, 'o', x.o - (_cum - n))) as ws""")
            .filter("size(ws) > 0").select("*", F.xxhash64(*group, "p").alias("h")))


def _collect(df: DataFrame) -> list:
    """The rows of a pass: a few per group, checked."""
    with compiled_methods(df.sparkSession):
        rows = df.limit(MAX_ENTRIES + 1).collect()
    if len(rows) > MAX_ENTRIES:
        raise ValueError(f"more than {MAX_ENTRIES} group ranks in one selection")
    return rows


def select_ranks(src: DataFrame, group: Sequence[str], ranks: Column | None = None,
                 start: dict | None = None) -> list[dict]:
    """For each wanted 0-based rank ``r`` of a group: ``m``, rows of the group, ``key`` (of column
    ``_v``, a double, or a long that is its own key) found there, rows ``below`` with a smaller key and with the ``same`` key.
    ``ranks`` is an array expression that may use ``m``; ranks that no row has give none.
    ``start`` gives what is ``known`` before the first digit instead."""
    group = list(group)
    prev, known, rows = None, start, []
    for shift in SHIFTS:
        rows = _collect(_counted(src, group, prev, shift, known, ranks))
        if not rows:
            return []
        prev, known = shift, {x.h: {"group": [x[g] for g in group], "p": x.p, "m": x.m, "ws": [(w.r, w.o) for w in x.ws]} for x in rows}
    return [{**{g: x[g] for g in group}, "m": x.m, "r": w.r, "key": x.p, "below": w.r - w.o, "same": x.n}
            for x in rows for w in x.ws]


def _local(df: DataFrame, rows: list[dict], types: dict[str, str]) -> DataFrame:
    """A few rows as a table, built from literals."""
    spark = df.sparkSession
    if not rows:
        return spark.createDataFrame([], ", ".join(f"`{c}` {t}" for c, t in types.items()))
    every = F.array(*[F.struct(*[F.lit(r[c]).cast(t).alias(c) for c, t in types.items()]) for r in rows])
    return spark.range(0, 1, 1, 1).select(F.inline(every))


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (),
              name_col: str = "feature") -> DataFrame:
    """Exact quantiles with linear interpolation of all columns, ``(by...,
    feature, prob, value)``, nulls ignored."""
    from .ordered import sql_text
    by, cols = list(by), list(cols)
    pairs = ", ".join(f"'{sql_text(c)}', cast(`{c.replace('`', '``')}` as double)" for c in cols)
    renamed = {c: f"_g{i}" for i, c in enumerate(by)}
    groups = [F.col("`" + c.replace("`", "``") + "`").alias(g) for c, g in renamed.items()]
    long = df.select(*groups, F.expr(f"stack({len(cols)}, {pairs}) as (_f, _v)")).filter("_v is not null")
    group = [*renamed.values(), "_f"]
    at = [F.lit(float(p)) * (F.col("m") - 1) for p in probs]
    ranks = F.array_distinct(F.array(*[f(x).cast("long") for x in at for f in (F.floor, F.ceil)]))
    found = select_ranks(long, group, ranks)
    types = {**{g: long.schema[g].dataType.simpleString() for g in group}, "m": "bigint", "r": "bigint", "key": "bigint"}
    got = _local(df, found, types)
    one = got.groupBy(*group).agg(F.max("m").alias("m"), F.map_from_entries(
        F.collect_list(F.struct("r", key_value(F.col("key"))))).alias("v"))
    out = one.select(*group, "m", "v", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob"))
    pos = F.col("prob") * (F.col("m") - 1)
    low, high = F.col("v")[F.floor(pos).cast("long")], F.col("v")[F.ceil(pos).cast("long")]
    value = F.when(F.floor(pos) == F.ceil(pos), low).otherwise(low + (high - low) * (pos - F.floor(pos)))
    return out.select(*[F.col(g).alias(c) for c, g in renamed.items()], F.col("_f").alias(name_col), "prob", value.alias("value"))


def numeric_id(df: DataFrame, id_col: str) -> bool:
    return isinstance(df.schema[id_col].dataType, T.NumericType)


def _keyed(df: DataFrame, key: str, id_col: str) -> DataFrame:
    """Add ``_s`` (ascending: the largest key first; null and NaN last) and ``_i`` (the id)."""
    whole = isinstance(df.schema[id_col].dataType, T.IntegralType)
    return df.withColumn("_s", F.coalesce(-F.col(key).cast("double"), F.lit(float("nan")))).withColumn(
        "_i", F.col(id_col).cast("long" if whole else "double"))


def rank_borders(df: DataFrame, key: str, id_col: str, by: Sequence[str], ranks: Column) -> DataFrame:
    """The table with ``_s``, ``_i`` and ``_borders`` added: the borders of the row's group, an
    array of ``r, s, i``, one for each wanted rank of ``(key desc, id asc)``; ``within``
    compares a row with one. Ids are put in order only where a border falls inside a
    tied key. Rows with equal key and id stand together."""
    by = list(by)
    names = {c: f"_g{i}" for i, c in enumerate(by)}
    keyed = _keyed(df, key, id_col)
    group = [*names.values(), "_one"]
    src = keyed.select(*[F.col("`" + c.replace("`", "``") + "`").alias(g) for c, g in names.items()], F.lit(1).alias("_one"), "_s", "_i")
    first = select_ranks(src.withColumnRenamed("_s", "_v"), group, ranks)
    borders = {(*[x[g] for g in group], x["r"]): [x["r"], x["key"], None] for x in first}
    cut: dict[tuple, dict] = {}
    for x in first:
        if x["below"] + x["same"] > x["r"] + 1:
            at = (*[x[g] for g in group], x["key"])
            cut.setdefault(at, {"group": [*at[:-1], _double(at[-1])], "p": 0, "m": x["m"], "ws": []})["ws"].append((x["r"], x["r"] - x["below"]))
    if cut:
        inner = [*group, "_t"]
        types = {**{g: src.schema[g].dataType.simpleString() for g in group}, "_t": "double"}
        keys = list(cut)
        hashed = _local(df, [dict(zip([*inner, "at"], (*cut[k]["group"], i))) for i, k in enumerate(keys)], {**types, "at": "int"}).select(
            "at", F.xxhash64(*inner, F.lit(0).cast("long")).alias("h")).collect()
        # 0.0 and -0.0 are one score but hash apart
        tied = src.select(*group, (F.col("_s") + 0.0).alias("_t"), F.col("_i").alias("_v"))
        for x in select_ranks(tied, inner, start={y.h: cut[keys[y["at"]]] for y in hashed}):
            borders[(*[x[g] for g in group], x["r"])][2] = x["key"]
    per: dict[tuple, list] = {}
    whole = not isinstance(keyed.schema["_i"].dataType, T.DoubleType)
    for at, (r, k, i) in sorted(borders.items(), key=lambda z: z[1][0]):
        per.setdefault(at[:-2], []).append((r, _double(k), i if whole or i is None else _double(i)))
    return with_own(keyed, names, per, {"r": "bigint", "s": "double", "i": "bigint" if whole else "double"}, "_borders")


def with_own(df: DataFrame, names: Sequence[str], per: dict[tuple, list], fields: dict[str, str], name: str) -> DataFrame:
    """Add to every row the list of ``fields`` that ``per`` has for the row's values of the
    columns ``names``, as literals; null where it has none."""
    out = F.lit(None).cast("array<struct<" + ",".join(f"{f}:{t}" for f, t in fields.items()) + ">>")
    for values, rows in per.items():
        here = F.lit(True)
        for c, v in zip(names, values):
            here = here & F.col("`" + c.replace("`", "``") + "`").eqNullSafe(F.lit(v).cast(df.schema[c].dataType))
        own = F.array(*[F.struct(*[F.lit(x).cast(t).alias(f) for x, (f, t) in zip(r, fields.items())]) for r in rows])
        out = F.when(here, own).otherwise(out)
    return df.withColumn(name, out)


def within(b: Column) -> Column:
    """Whether a row of ``rank_borders`` is at or before border ``b``."""
    return (F.col("_s") < b["s"]) | ((F.col("_s") == b["s"]) & (b["i"].isNull() | (F.col("_i") <= b["i"])))
