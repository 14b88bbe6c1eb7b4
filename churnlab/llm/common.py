"""Helpers shared by the operators: tables, scratch tables, salted joins,
connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, scratch_path

__all__ = ["table", "materialize", "scratch_path", "salted_join", "components", "drop_tables", "arrow_rows", "fresh"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened by underscores until they differ from every column of the table."""
    used, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in used:
            n += "_"
        used.add(n.lower())
        out.append(n)
    return out


def drop_tables(*tables: DataFrame) -> None:
    """Delete written intermediate tables that no later step reads."""
    for df in tables:
        spark = df.sparkSession
        jvm = spark._jvm
        for f in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(f)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def salted_join(big: DataFrame, small: DataFrame, keys: list[str], by: list[str], how: str = "inner",
                salts: int = 16) -> DataFrame:
    """Equi-join whose big side may hold a key with a large part of all rows.

    ``small`` has one row per key; it is repeated once per salt, and the rows
    of a key on the big side spread over the salts by a hash of the ``by``
    columns, so that a hot key is dealt over ``salts`` tasks.
    """
    b = big.withColumn("_salt", F.pmod(F.xxhash64(*by), F.lit(salts)).cast("int"))
    s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return b.join(s, [*keys, "_salt"], how).drop("_salt")


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """Connected components of an edge table: ``(id, component)`` with the
    smallest id of each component, for every id that has an edge.

    Alternating large-star and small-star steps: each step is a grouped
    minimum (combined before the shuffle) and a salted join back, so a vertex
    with a large part of all edges does not gather them in one task. Each
    round is written to the shared folder; the loop ends when a round leaves
    the edge set as it was. Every round moves ids towards smaller ones, and
    the number of rounds grows with the logarithm of the longest path.
    """
    e = materialize(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                    .filter("u > v").distinct(), "edges")
    mark = _mark(e)
    for _ in range(rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (salted_join(both, low, ["u"], ["v"]).filter("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = materialize(large, "edges")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (salted_join(large, low, ["u"], ["v"])
                 .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                           F.struct(F.col("u"), F.col("m").alias("v")))).alias("x"))
                 .select("x.u", "x.v").filter("u > v").distinct())
        new = materialize(small, "edges")
        now = _mark(new)
        drop_tables(e, large)
        e = new
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)


def _mark(e: DataFrame):
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def arrow_rows(spark: SparkSession, rows: int) -> None:
    """Rows per Arrow batch handed to Python tasks: whole texts are large, so
    batches are kept to a few hundred documents."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def bit_table(keys: DataFrame, key: str, bits: int):
    """Bit table of a long column as a NumPy array of ``bits / 64`` words: the
    bit ``key & (bits - 1)`` is set for every key. ``bits`` is a power of two, so
    at most ``bits / 64`` rows reach the driver whatever the number of keys. A
    key that is not in the column may find its bit set; one that is always does."""
    import numpy as np
    cells = keys.groupBy(F.shiftright(F.col(key).bitwiseAND(F.lit(bits - 1)), 6).alias("i")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast({key} & 63 as int))")).alias("w"))
    got = cells.toArrow()       # columns: as rows, millions of cells fill the driver
    table = np.zeros(bits // 64, np.uint64)
    table[got["i"].to_numpy()] = got["w"].to_numpy().view(np.uint64)
    return table


def in_table(table, key):
    """Whether the bits of unsigned 64-bit keys are set."""
    import numpy as np
    b = key & np.uint64(len(table) * 64 - 1)
    return (table[(b >> np.uint64(6)).astype(np.int64)] >> (b & np.uint64(63))) & np.uint64(1) != 0
