"""Sharding by a hierarchical weighted hash tree.

A tree of regions, racks and shards; each node weighs as much as the shards
below it. A document descends from the root: at each level every child draws
``-ln(u) / weight`` with ``u`` hashed from the document's key and the child's
path, and the smallest draw wins. A child's draw depends on no other child, so
a changed weight moves documents only into or out of the subtree that has it,
and a new subtree only takes documents into itself.

Rows without an id are placed by the empty key; repeated rows go to the same
shard and get slots of their own; an empty table gives an empty result. Other
columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

#: 13 hexadecimal digits of an MD5 sum: numbers below 2 ** 52, exact as doubles
DIGITS, RANGE = 13, float(1 << 52)
#: rows that one slot-numbering range should hold
ROWS_PER_RANGE = 200_000


@dataclass(frozen=True)
class Node:
    name: str
    weight: float
    children: tuple["Node", ...] = ()
    shard: int | None = None


def leaf(shard: int, weight: float = 1.0) -> Node:
    return Node(f"s{shard}", weight, (), shard)


def inner(name: str, children) -> Node:
    children = tuple(children)
    return Node(name, sum(c.weight for c in children), children)


def tree(regions: int = 5, racks: int = 2, shards: int = 4) -> Node:
    """A tree of equal shards, numbered from 0 through regions and racks."""
    return inner("root", [
        inner(f"g{g}", [inner(f"k{k}", [leaf((g * racks + k) * shards + s) for s in range(shards)])
                        for k in range(racks)]) for g in range(regions)])


def grow(root: Node, shard: int, weight: float = 1.0) -> Node:
    """The tree with one more shard. New capacity comes as a region of its own,
    so that no weight within an older region changes and documents move only
    into the new shard."""
    n = len(root.children)
    return inner(root.name, [*root.children, inner(f"g{n}", [inner("k0", [leaf(shard, weight)])])])


def uniform(key: Column, path: str) -> Column:
    """Number in (0, 1) hashed from the key and a node's path."""
    h = F.conv(F.substring(F.md5(F.concat(key, F.lit(f"|{path}"))), 1, DIGITS), 16, 10).cast("double")
    return (h + F.lit(0.5)) / F.lit(RANGE)


def place(key: Column, root: Node) -> Column:
    """Shard of a key (a string column): the descent as one expression."""
    return _descend(key, root, "")


def _descend(key: Column, node: Node, path: str) -> Column:
    if node.shard is not None:
        return F.lit(node.shard)
    kids = list(node.children)
    if len(kids) == 1:
        return _descend(key, kids[0], f"{path}/{kids[0].name}")
    draws = [F.struct((-F.ln(uniform(key, f"{path}/{c.name}")) / F.lit(float(c.weight))).alias("d"),
                      F.lit(i).alias("i")) for i, c in enumerate(kids)]
    won = F.least(*draws)["i"]
    if all(c.shard is not None for c in kids):
        return F.element_at(F.array(*[F.lit(c.shard) for c in kids]), won + 1)
    return _switch(won, [_descend(key, c, f"{path}/{c.name}") for c in kids])


def _switch(index: Column, branches: list[Column]) -> Column:
    """The branch of an index; only that branch is evaluated."""
    out = branches[-1]
    for i in range(len(branches) - 2, -1, -1):
        out = F.when(index == i, branches[i]).otherwise(out)
    return out


def assign(docs: DataFrame, root: Node, grown: Node | None = None, id_col: str = "doc_id",
           text: str = "text") -> DataFrame:
    """Shard and slot of every row: ``id, size, text_crc32, shard, slot,
    grown_shard``. ``size`` is the text's UTF-8 bytes plus 16.

    Slots run without gaps from 0 in each shard, in the order of a hash of the
    id (ties by id, checksum and size). They are numbered in hash ranges, whose
    counts give each range its first slot; the number of ranges follows the
    number of rows, and the slots do not depend on it.
    """
    d = docs.select(F.col(id_col).alias("id"), F.col(text).alias("t"))
    key = F.coalesce(F.col("id").cast("string"), F.lit(""))
    d = d.select("id", F.coalesce(F.octet_length("t"), F.lit(0)).cast("long").alias("n"),
                 F.crc32(F.coalesce(F.col("t"), F.lit("")).cast("binary")).alias("crc"),
                 place(key, root).alias("shard"),
                 (place(key, grown) if grown else F.lit(None).cast("int")).alias("grown"),
                 F.conv(F.substring(F.md5(F.concat(key, F.lit("|slot"))), 1, DIGITS), 16, 10)
                 .cast("long").alias("h"))
    ranges = max(1, docs.count() // (ROWS_PER_RANGE * _leaves(root)) + 1)
    d = d.withColumn("r", F.floor(F.col("h") / F.lit(RANGE) * ranges).cast("int"))
    counts = d.groupBy("shard", "r").agg(F.count("*").alias("c"))
    before = counts.select("shard", "r", (F.sum("c").over(
        W.partitionBy("shard").orderBy("r").rowsBetween(W.unboundedPreceding, W.currentRow))
        - F.col("c")).alias("before"))
    rank = F.row_number().over(W.partitionBy("shard", "r").orderBy("h", "id", "crc", "n"))
    out = d.withColumn("k", rank).join(before, ["shard", "r"])
    return out.select(F.col("id").alias(id_col), (F.col("n") + 16).alias("size"), F.col("crc").alias("text_crc32"),
                      "shard", (F.col("before") + F.col("k") - 1).cast("long").alias("slot"),
                      F.col("grown").alias("grown_shard"))


def label(docs: DataFrame, root: Node, id_col: str = "doc_id", out: str = "shard") -> DataFrame:
    """The rows of ``docs`` with their shard; a column of that name is replaced."""
    return docs.withColumn(out, place(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), root))


def _leaves(node: Node) -> int:
    return 1 if node.shard is not None else sum(map(_leaves, node.children))


def leaves(node: Node, path: str = "") -> list[tuple[str, float, int | None]]:
    """(path, weight, shard or None) of every node below the root, for reports."""
    out = []
    for c in node.children:
        p = f"{path}/{c.name}"
        out += [(p, c.weight, c.shard), *leaves(c, p)]
    return out
