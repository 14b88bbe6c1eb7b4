"""Source divergence audit: how far the word use of each source is from that of
the other sources of its language, and which words set it apart.

A group is a (language, source). Every term of a language's vocabulary (terms in
at least ``min_docs`` of its documents) has a smoothed share in every group, zero
counts included. The distance of two groups is the sum of the absolute
differences of their shares over the vocabulary; a share depends on the count
alone, so the sum needs only the joint cells: how many terms have count a in one
group and count b in the other.

Method: terms are dealt into segments of one language and one band of total
counts. A segment stores one bitset of its term numbers per (group, count), and
one per total count of the language. For two groups, AND and popcount of each
pair of their bitsets gives the joint cells; cells of a count of zero follow by
complement. Each cell is multiplied by the difference of its two shares. The
telling terms of a group come from the cells of its bitsets with those of the
language: cells are opened from the largest difference down, until the top terms
are found.

Work: terms are counted inside the tasks first (flushed at a bounded number of
entries) and shuffled once by (language, term). Segments are cut from a range
partitioning, streamed in sorted order; a word held by all documents is one row
per group. Pairs of groups are dealt by (language, segment, pair of blocks of
groups), so a task holds the bitsets of at most two blocks in one segment,
whatever the number of terms, groups or documents. Frequent terms, whose counts
all differ, have short segments, so that few bitsets meet. All arithmetic is on
integers. Nothing but two numbers reaches the driver.

Defined results: null texts, languages and sources count as empty ones. Groups
without terms are compared like others (all their counts are zero); a language
without vocabulary gives distance 0. A language with one source has no pairs.
Repeated rows count each. Ties rank by the item in UTF-8 order. Long texts are
read in pieces cut between terms. An empty table gives an empty result. Columns
other than the three named ones are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize

#: terms on their lower-cased UTF-8 bytes: letters of ASCII and everything beyond it
TERM = re.compile(rb"[a-z\x80-\xff]+")
GAP = re.compile(rb"[^A-Za-z\x80-\xff]")
PIECE = 1 << 22             # bytes of a text that are split at once
ENTRIES = 400_000           # counts that a task holds before it hands them on
#: terms of a segment, and of one whose terms occur FREQUENT times or more
SEGMENT, SEGMENT_FREQUENT, FREQUENT = 2048, 64, 1024
BLOCK = 32                  # groups of a block, on average
WORDS_AT_ONCE = 1 << 21     # 64-bit words of one AND


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text in pieces cut between terms."""
    lo = 0
    while lo < len(text):
        hi = lo + PIECE
        if hi < len(text):
            gap = GAP.search(text, hi)
            hi = gap.start() if gap else len(text)
        yield text[lo:hi]
        lo = hi


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents per (language, source, term) of a partition."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def out():
        for (lang, source), (c, d) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(c), pa.string()), pa.array([source] * len(c), pa.string()),
                 pa.array([x.decode() for x in c], pa.string()), pa.array(list(c.values()), pa.int64()),
                 pa.array([d[x] for x in c], pa.int64())], ["lang", "source", "term", "c", "d"])
        held.clear()

    for batch in batches:
        for lang, source, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            c, d = held.setdefault((lang, source), (Counter(), Counter()))
            raw = text.encode()
            if len(raw) <= PIECE:
                found = TERM.findall(raw.lower())
                c.update(found)
                d.update(set(found))
            else:
                own = set()
                for piece in _pieces(raw):
                    found = TERM.findall(piece.lower())
                    c.update(found)
                    own.update(found)
                d.update(own)
        if sum(len(c) for c, _ in held.values()) > ENTRIES:
            yield from out()
    yield from out()


def counts(docs: DataFrame, min_docs: int = 30, text: str = "text", lang: str = "lang",
           source: str = "source") -> DataFrame:
    """``lang, term, source, c, total``: occurrences of every kept term in the
    groups that have it, and in its language."""
    d = docs.select(*[F.coalesce(F.col(x).cast("string"), F.lit("")).alias(a)
                      for x, a in ((lang, "lang"), (source, "source"), (text, "text"))])
    part = d.mapInArrow(_count, "lang string, source string, term string, c long, d long")
    # dealt by (lang, term): the grouping and both sums of a term need no other shuffle
    one = part.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("c").alias("c"), F.sum("d").alias("d"))
    w = W.partitionBy("lang", "term")
    one = one.withColumn("docs", F.sum("d").over(w)).withColumn("total", F.sum("c").over(w))
    return one.filter(F.col("docs") >= min_docs).select("lang", "term", "source", "c", "total")


BITS = "kind int, lang string, seg long, source string, level long, n long, bits binary, terms array<string>"
HEAD, LANG, GROUP = 0, 1, 2
RESULT = [("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())]


def _segment_rows(lang: str, seg: int, totals: dict[int, list[tuple[int, str]]],
                  levels: dict[tuple[str, int], list[int]], n: int) -> pa.RecordBatch:
    size = (n + 63) // 64 * 8

    def bits(at):
        b = np.zeros(size * 8, np.uint8)
        b[at] = 1
        return np.packbits(b, bitorder="little").tobytes()
    rows = [(HEAD, "", 0, n, None, None)]
    rows += [(LANG, "", t, len(x), bits([p for p, _ in x]), [s for _, s in x]) for t, x in totals.items()]
    rows += [(GROUP, s, c, len(x), bits(x), None) for (s, c), x in levels.items()]
    kind, source, level, ns, b, terms = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(kind, pa.int32()), pa.array([lang] * len(rows), pa.string()), pa.array([seg] * len(rows), pa.int64()),
         pa.array(source, pa.string()), pa.array(level, pa.int64()), pa.array(ns, pa.int64()), pa.array(b, pa.binary()),
         pa.array(terms, pa.list_(pa.string()))], ["kind", "lang", "seg", "source", "level", "n", "bits", "terms"])


def bitmaps(kept: DataFrame, segment: int = SEGMENT, segment_frequent: int = SEGMENT_FREQUENT,
            frequent: int = FREQUENT) -> DataFrame:
    """Bitset rows of every segment. Term numbers follow the UTF-8 order of the
    terms inside a segment. A task reads its range in order and holds one segment."""
    band = F.floor(F.log2(F.col("total").cast("double"))).cast("int")
    rows = (kept.withColumn("band", band).repartitionByRange("lang", "band", "term")
            .sortWithinPartitions("lang", "band", "term").select("lang", "band", "term", "source", "c", "total"))

    def run(batches):
        base, k = TaskContext.get().partitionId() << 32, 0
        at, last, n, most = None, None, 0, 0
        totals, levels = {}, {}
        for batch in batches:
            for lang, band, term, source, c, total in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if (lang, band) != at or term != last:
                    if at is not None and ((lang, band) != at or n == most):
                        yield _segment_rows(at[0], base + k, totals, levels, n)
                        totals, levels, n, k = {}, {}, 0, k + 1
                    at, last = (lang, band), term
                    most = segment_frequent if total >= frequent else segment
                    totals.setdefault(total, []).append((n, term))
                    n += 1
                levels.setdefault((source, c), []).append(n - 1)
        if at is not None:
            yield _segment_rows(at[0], base + k, totals, levels, n)

    return rows.mapInArrow(run, BITS)


def _shares(levels: list[int], size: int, vocabulary: int, scale: int, smooth: int) -> np.ndarray:
    """Smoothed share of each count, exact."""
    whole = size + smooth * vocabulary
    return np.array([1 + scale * (c + smooth) // whole for c in levels], np.int64)


class _Side:
    """Bitsets of some groups in one segment, rows ordered by group."""

    def __init__(self, groups: list[tuple[str, int]], rows: dict[str, list[tuple[int, int, bytes]]], vocabulary: int,
                 words: int, scale: int, smooth: int):
        self.names = [s for s, _ in groups]
        lists = [sorted(rows.get(s, [])) for s in self.names]
        self.first = np.cumsum([0, *map(len, lists)])
        raw = b"".join(b for x in lists for _, _, b in x)
        self.bits = np.frombuffer(raw, "<u8").reshape(-1, words)
        self.n = np.array([n for x in lists for _, n, _ in x], np.int64)
        self.share = np.concatenate([_shares([c for c, _, _ in x], size, vocabulary, scale, smooth)
                                     for (_, size), x in zip(groups, lists)] or [np.zeros(0, np.int64)])
        self.none = np.array([_shares([0], size, vocabulary, scale, smooth)[0] for _, size in groups], np.int64)

    def each(self, x: np.ndarray) -> np.ndarray:
        """Sums of the columns of each group."""
        c = np.zeros((*x.shape[:-1], x.shape[-1] + 1), np.int64)
        np.cumsum(x, -1, out=c[..., 1:])
        return c[..., self.first[1:]] - c[..., self.first[:-1]]


def _cells(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Joint cells: popcount of the AND of every row of a with every row of b."""
    out = np.empty((len(a), len(b)), np.int64)
    step = max(1, WORDS_AT_ONCE // max(1, b.size))
    for lo in range(0, len(a), step):
        out[lo:lo + step] = np.bitwise_count(a[lo:lo + step, None, :] & b[None, :, :]).sum(-1)
    return out


def _distances(left: _Side, right: _Side, n: int, same: bool) -> tuple[list, list, list]:
    """Parts of the distances of all groups of two blocks in one segment of n terms."""
    g, h, v = [], [], []
    held = right.each(right.n[None, :])[0]
    for i, name in enumerate(left.names):
        rows = slice(left.first[i], left.first[i + 1])
        p, size, zero = left.share[rows], left.n[rows], left.none[i]
        cells = _cells(left.bits[rows], right.bits)
        value = right.each((cells * np.abs(p[:, None] - right.share[None, :])).sum(0)[None, :])[0]
        own = right.each(cells)                                     # terms of each count that a group has too
        value = value + ((size[:, None] - own) * np.abs(p[:, None] - right.none[None, :])).sum(0)
        value += right.each(((right.n - cells.sum(0)) * np.abs(right.share - zero))[None, :])[0]
        both = own.sum(0)
        value += (n - size.sum() - held + both) * np.abs(right.none - zero)
        for j, other in enumerate(right.names):
            if not same or j > i:
                g.append(name), h.append(other), v.append(int(value[j]))
    return g, h, v


def _telling(side: _Side, lang_bits: np.ndarray, lang_share: np.ndarray, lang_terms: list[list[str]],
             top: int) -> tuple[list, list, list]:
    """Up to ``top`` terms of each group with the largest excess over the
    language, in one segment: cells are opened from the largest excess down."""
    g, terms, v = [], [], []
    for i, name in enumerate(side.names):
        rows = slice(side.first[i], side.first[i + 1])
        if rows.start == rows.stop:
            continue
        excess = side.share[rows][:, None] - lang_share[None, :]
        cells = _cells(side.bits[rows], lang_bits)
        a, b = np.nonzero((cells > 0) & (excess > 0))
        f = excess[a, b]
        order = np.argsort(-f, kind="stable")
        a, b, f = a[order], b[order], f[order]
        reach = np.searchsorted(np.cumsum(cells[a, b]), top)
        if reach < len(f):                                          # with every cell that ties with the last
            stop = int(np.searchsorted(-f, -f[reach], "right"))
            a, b, f = a[:stop], b[:stop], f[:stop]
        found = []
        for x, y, value in zip(a, b, f):
            both = np.unpackbits((side.bits[rows][x] & lang_bits[y]).view(np.uint8), bitorder="little")
            at = np.flatnonzero(np.unpackbits(lang_bits[y].view(np.uint8), bitorder="little"))
            found += [(-int(value), int(p), lang_terms[y][k]) for k, p in enumerate(at) if both[p]]
        for value, _, term in sorted(found)[:top]:
            g.append(name), terms.append(term), v.append(-value)
    return g, terms, v


def audit(docs: DataFrame, min_docs: int = 30, top: int = 50, scale: int = 1_000_000_000, smooth: int = 5,
          text: str = "text", lang: str = "lang", source: str = "source", block: int = BLOCK,
          segment: int = SEGMENT, segment_frequent: int = SEGMENT_FREQUENT, frequent: int = FREQUENT) -> DataFrame:
    """``lang, source, part, item, value, rank``: distances to the other sources
    (part ``pair``, all) and telling terms (part ``term``, ``top`` of each
    group). ``block``, ``segment`` and the following change the work, never the result."""
    kept = materialize(counts(docs, min_docs, text, lang, source), "term_counts")
    sizes = kept.groupBy("lang", "source").agg(F.sum("c").alias("size"))
    words = kept.groupBy("lang", "term").agg(F.sum("c").alias("c")).groupBy("lang").agg(
        F.count("*").alias("vocabulary"), F.sum("c").alias("lang_size"))
    groups = (docs.select(*[F.coalesce(F.col(x).cast("string"), F.lit("")).alias(a)
                            for x, a in ((lang, "lang"), (source, "source"))]).distinct()
              .join(sizes, ["lang", "source"], "left").fillna(0, ["size"]))
    groups = materialize(groups, "groups")
    most = groups.groupBy("lang").count().agg(F.max("count")).first()[0]
    blocks = -(-(most or 1) // block)
    deal = F.pmod(F.xxhash64("source"), F.lit(blocks)).cast("int")

    bits = materialize(bitmaps(kept, segment, segment_frequent, frequent), "bitmaps")
    # every group in every segment of its language, so that zero counts are seen; the size travels as the level
    heads = bits.filter(F.col("kind") == HEAD).select("lang", "seg", "n").join(words, "lang")
    seats = heads.join(groups, "lang").select(
        F.lit(HEAD).alias("kind"), "lang", "seg", "source", F.col("size").alias("level"), "n",
        F.lit(None).cast("binary").alias("bits"), F.lit(None).cast("array<string>").alias("terms"), "vocabulary", "lang_size")
    none = [F.lit(None).cast("long").alias(c) for c in ("vocabulary", "lang_size")]
    rows = seats.unionByName(bits.filter(F.col("kind") != HEAD).select("*", *none)).withColumn("block", deal)
    every = F.sequence(F.lit(0), F.lit(blocks - 1))
    tiles = F.when(F.col("kind") == LANG, F.transform(every, lambda y: F.struct(y.alias("x"), y.alias("y")))).otherwise(
        F.transform(every, lambda y: F.struct(F.least("block", y).alias("x"), F.greatest("block", y).alias("y"))))
    rows = rows.withColumn("tile", F.explode(tiles)).select("*", F.col("tile.x").alias("x"), F.col("tile.y").alias("y")).drop("tile")

    def run(key, t):
        tongue, _, x, y = (k.as_py() for k in key)
        cols = {c: t.column(c).to_pylist() for c in ("kind", "source", "level", "n", "block", "vocabulary", "lang_size", "terms")}
        raw = t.column("bits").to_pylist()
        seat: dict[int, list[tuple[str, int]]] = {x: [], y: []}
        own: dict[str, list[tuple[int, int, bytes]]] = {}
        language, n, vocabulary, lang_size = [], 0, 0, 0
        for i, kind in enumerate(cols["kind"]):
            if kind == HEAD:
                seat[cols["block"][i]].append((cols["source"][i], cols["level"][i]))
                n, vocabulary, lang_size = cols["n"][i], cols["vocabulary"][i], cols["lang_size"][i]
            elif kind == LANG:
                language.append((cols["level"][i], raw[i], cols["terms"][i]))
            else:
                own.setdefault(cols["source"][i], []).append((cols["level"][i], cols["n"][i], raw[i]))
        width = (n + 63) // 64
        if not n:                                                   # blocks without a group of this language
            return pa.table({c: pa.array([], z) for c, z in RESULT})
        sides = {b: _Side(sorted(s), own, vocabulary, width, scale, smooth) for b, s in seat.items()}
        g, h, v = _distances(sides[x], sides[y], n, x == y)
        part = ["pair"] * len(g)
        if x == y:
            lang_bits = np.frombuffer(b"".join(b for _, b, _ in language), "<u8").reshape(-1, width)
            share = _shares([c for c, _, _ in language], lang_size, vocabulary, scale, smooth)
            more = _telling(sides[x], lang_bits, share, [s for _, _, s in language], top)
            g, h, v = g + more[0], h + more[1], v + more[2]
            part += ["term"] * len(more[0])
        return pa.table({c: pa.array(x, z) for (c, z), x in zip(RESULT, ([tongue] * len(g), g, part, h, v))})

    found = materialize(rows.groupBy("lang", "seg", "x", "y").applyInArrow(
        run, "lang string, source string, part string, item string, value long"), "divergence")
    sums = found.filter(F.col("part") == "pair").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    sums = sums.union(sums.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    names = groups.select("lang", "source")
    pairs = (names.join(names.withColumnRenamed("source", "item"), "lang").filter(F.col("source") != F.col("item"))
             .join(sums, ["lang", "source", "item"], "left").fillna(0, ["value"])
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value"))
    w = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = found.filter(F.col("part") == "term").withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(w)).unionByName(terms)
