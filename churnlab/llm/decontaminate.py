"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are folded (lower case, punctuation dropped). The seeds of a test item are
its ``SEED``-word n-grams. One pass counts the documents that hold each seed; an
item's seeds are ranked by that count, and the rare ones open a pair of document
and item. An item needs ``MIN_SEEDS`` seeds, and the share ``MIN_SHARE`` of its
seeds, close together in a document; with n seeds of which s are needed, the
n - s + 1 rarest open, as any s seeds hold one of them. The s - 1 most frequent ones
are looked up only in documents with an open pair, to confirm it: no pair is lost
by rarity, also not if thousands of documents have the same edited copy.

The words around the seeds are a region, and the item is aligned with it
(match +2, other word -1, gap -1). The similarity is the best local score over the
score of a perfect copy; from ``threshold`` the document holds the item. A region
with too few of the item's words to reach the threshold is not aligned.

The test items are read in slabs of at most ``SLAB_CHARS`` characters, so the
index that tasks get and the seed counts that the driver gets stay bounded; each
slab is two more passes over the documents.

Null and empty texts and items hold nothing. Items with under ``MIN_WORDS`` words are
held by exact copies only: of ``SEED`` words or more anywhere in a text, of fewer
words if they are the whole text. Very long texts and items are aligned in windows of
six times the item, with two rows of the table in memory. Of equally good
alignments in a window that of the fewest item words counts, then the first; of
windows the first. Repeated documents and repeated items
give repeated rows of links. Empty tables give an empty result; columns other
than id and text are ignored by the search and kept by ``clean``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import arrow_rows

SEED, MIN_SEEDS, MIN_WORDS = 3, 2, 6
MIN_SHARE = 0.1
THRESHOLD = 0.5
SLAB_CHARS = 4 << 20
MATCH, OTHER, GAP = 2, -1, -1


class Index:
    """Seeds and words of one slab of test items."""

    def __init__(self, ids: list, texts: list[str | None]):
        self.ids, self.items, short = ids, [], {}
        seeds, item, pos = [], [], []
        for w in W.split(pa.array(texts, pa.string()), folded=True):
            g = w.ngrams(SEED)
            for i in range(len(w)):
                a, z = w.first[i], w.first[i + 1]
                self.items.append(w.hash[a:z].copy())
                if z - a >= MIN_WORDS:
                    n = z - a - SEED + 1
                    seeds.append(g[a:a + n])
                    item.append(np.full(n, w.base + i))
                    pos.append(np.arange(n))
                elif z > a:
                    short.setdefault(int(z - a), []).append(w.base + i)
        # per number of words: hashes of the short items in order, and their numbers
        self.short = {}
        for n, found in short.items():
            h = np.concatenate([W.ngrams(self.items[i], n) for i in found])
            order = np.argsort(h, kind="stable")
            self.short[n] = h[order], np.array(found)[order]
        self.seeds, self.item, self.pos = (np.concatenate(x) if x else np.zeros(0, t) for x, t in
                                           ((seeds, np.uint64), (item, np.int64), (pos, np.int64)))
        size = np.bincount(self.item, minlength=len(self.items))
        self.need = np.maximum(MIN_SEEDS, np.ceil(MIN_SHARE * size).astype(np.int64))
        self.keys = np.unique(self.seeds)
        self.rank(np.zeros(len(self.keys), np.int64))

    def rank(self, held: np.ndarray):
        """Order the entries of each seed, those that open pairs first; ``held``
        is the number of documents of each of ``keys``."""
        often = held[np.searchsorted(self.keys, self.seeds)]
        order = np.lexsort((self.pos, often, self.item))
        size = np.bincount(self.item, minlength=len(self.items))
        nth = np.arange(len(order)) - (np.cumsum(size) - size)[self.item[order]]
        opens = np.empty(len(order), bool)
        opens[order] = nth <= (size - self.need)[self.item[order]]
        order = np.lexsort((self.pos, self.item, ~opens, self.seeds))
        self.seeds, self.item, self.pos = self.seeds[order], self.item[order], self.pos[order]
        self.at = np.searchsorted(self.seeds, self.keys)
        self.upto = np.append(self.at[1:], len(order))
        self.mid = self.at + np.add.reduceat(opens[order].astype(np.int64), self.at) if len(order) else self.at

    def look(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions among ``grams`` that are seeds, and the seed's number."""
        if not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        k = np.minimum(np.searchsorted(self.keys, grams), len(self.keys) - 1)
        hit = np.flatnonzero(self.keys[k] == grams)
        return hit, k[hit]


def align(item: np.ndarray, region: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment: (score, start, end) with the region's words
    ``start:end``. Smith-Waterman with linear gaps, a row of the item at a time; a
    cell is score * 2^32 + start, so the start travels with the score."""
    n, one = len(region), 1 << 32
    fresh = np.arange(n + 1)
    ramp = -GAP * one * fresh
    h, best = fresh, (0, 0, 0)
    for w in item:
        row = fresh.copy()
        np.maximum(row[1:], h[:-1] + np.where(region == w, MATCH * one, OTHER * one), out=row[1:])
        np.maximum(row, h + GAP * one, out=row)
        h = np.maximum.accumulate(row + ramp) - ramp            # gaps along the region
        score = h >> 32
        j = int(score.argmax())
        if score[j] > best[0]:
            best = int(score[j]), int(h[j] & (one - 1)), j
    return best


def regions(hit: np.ndarray, pos: np.ndarray, size: int, words: int, need: int) -> list[tuple[int, int]]:
    """Word ranges of a document to align with an item of ``size`` words: seed
    hits no further apart than the item is long lie in one range. Long ranges are cut
    into windows that overlap by three times the item: an alignment with a score has
    fewer than 2 * size gaps along the region, so one window holds it."""
    order = np.argsort(hit, kind="stable")
    hit, pos = hit[order], pos[order]
    cut = np.flatnonzero(np.diff(hit) > size) + 1
    slack, out = max(5, size // 4), []
    for h, p in zip(np.split(hit, cut), np.split(pos, cut)):
        if len(np.unique(p)) >= need:
            a = max(0, int((h - p).min()) - slack)
            z = min(words, int((h + size - p).max()) + slack)
            while z - a > 6 * size:
                out.append((a, a + 6 * size))
                a += 3 * size
            out.append((a, z))
    return out


def _hits(index: Index, w: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """Words of a slice where a seed starts, and the seed's number."""
    at, k = index.look(w.ngrams(SEED))
    live = w.starts(SEED)[at]
    return at[live], k[live]


def _entries(at: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each hit with the index entries ``lo:hi`` of its seed."""
    many = hi - lo
    return np.repeat(at, many), np.repeat(lo - np.cumsum(many) + many, many) + np.arange(many.sum())


def _copies(index: Index, w: W.Words):
    """(document, item, first word, end word) of the short items of a slice, the
    first copy of each pair."""
    size = np.diff(w.first)
    for n, (keys, item) in index.short.items():
        g, seen = w.ngrams(n), set()
        ok = w.starts(n)[:len(g)]
        if n < SEED:                        # the whole text
            ok &= np.repeat(size, size)[:len(g)] == n
        lo, hi = (np.searchsorted(keys, g, x) for x in ("left", "right"))
        hit = np.flatnonzero(ok & (hi > lo))
        for at, e in zip(*_entries(hit, lo[hit], hi[hit])):
            d, i = int(np.searchsorted(w.first, at, "right")) - 1, int(item[e])
            if (d, i) not in seen and np.array_equal(w.hash[at:at + n], index.items[i]):
                seen.add((d, i))
                yield d, i, int(at - w.first[d]), int(at - w.first[d]) + n


def _aligned(index: Index, col, threshold: float):
    """(row, item, similarity, first word, end word, seeds) of the pairs of a
    text column that reach the threshold."""
    for w in W.split(col, folded=True):
        for d, i, x, y in _copies(index, w):
            yield w.base + d, i, 1.0, x, y, max(0, y - x - SEED + 1)
        at, k = _hits(index, w)
        if not len(at):
            continue
        word_doc, n = w.doc, len(index.items)
        at_open, e_open = _entries(at, index.at[k], index.mid[k])
        open_pairs = np.unique(word_doc[at_open] * n + index.item[e_open])
        live = np.isin(word_doc[at], open_pairs // n)
        at, e = _entries(at[live], index.mid[k[live]], index.upto[k[live]])
        confirms = np.isin(word_doc[at] * n + index.item[e], open_pairs)
        at, e = np.append(at_open, at[confirms]), np.append(e_open, e[confirms])
        doc, item, pos = word_doc[at], index.item[e], index.pos[e]
        order = np.argsort(doc * n + item, kind="stable")
        start = np.flatnonzero(np.append(True, np.diff((doc * n + item)[order]) != 0)) if len(order) else order
        upto = np.append(start[1:], len(order))
        for x in np.flatnonzero(upto - start >= index.need[item[order[start]]]):
            own = order[start[x]:upto[x]]
            d, i = int(doc[own[0]]), int(item[own[0]])
            a, z = w.first[d], w.first[d + 1]
            words, size, best = w.hash[a:z], len(index.items[i]), (0, 0, 0)
            for lo, hi in regions(at[own] - a, pos[own], size, len(words), index.need[i]):
                if np.isin(index.items[i], words[lo:hi]).sum() < threshold * size:
                    continue        # the score is at most MATCH for each of these words
                s, x0, y = align(index.items[i], words[lo:hi])
                best = max(best, (s, -(lo + x0), lo + y))
            if best[0] >= threshold * MATCH * size:
                yield w.base + d, i, best[0] / (MATCH * size), -best[1], best[2], len(np.unique(pos[own]))


def _held(docs: DataFrame, index: Index) -> np.ndarray:
    """Number of documents that hold each seed of the slab."""
    def run(batches):
        for batch in batches:
            n = np.zeros(len(index.keys), np.int64)
            for w in W.split(batch.column("t"), folded=True):
                at, k = _hits(index, w)
                n += np.bincount(np.unique(w.doc[at] * len(n) + k) % max(1, len(n)), minlength=len(n))
            k = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(n[k])], ["k", "n"])

    out = np.zeros(len(index.keys), np.int64)
    if len(out):
        for r in docs.mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect():
            out[r.k] = r.n
    return out


def _link(docs: DataFrame, index: Index, threshold: float, id_type: str, item_type: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            r = [list(x) for x in zip(*_aligned(index, batch.column("t"), threshold))] or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(r[0], pa.int64())),
                 pa.array([index.ids[i] for i in r[1]], item_arrow), pa.array(r[2], pa.float64()),
                 *[pa.array(x, pa.int64()) for x in r[3:]]],
                ["id", "item", "similarity", "first_word", "end_word", "n_seeds"])

    item_arrow = pa.int64() if item_type in ("bigint", "long") else pa.string()
    return docs.mapInArrow(run, f"id {id_type}, item {'long' if item_arrow == pa.int64() else 'string'}, "
                                "similarity double, first_word long, end_word long, n_seeds long")


def _indexes(docs: DataFrame, benchmark: DataFrame, text: str, item_col: str, item_text: str, slab_chars: int):
    """The index of each slab of test items, and the type of the item ids."""
    arrow_rows(docs.sparkSession, 500)
    items = benchmark.select(F.col(item_col).alias("i"), F.col(item_text).alias("t"))
    item_type = items.schema["i"].dataType.simpleString()
    if item_type not in ("bigint", "long"):
        items = items.withColumn("i", F.col("i").cast("string"))
    chars = items.agg(F.coalesce(F.sum(F.length("t")), F.lit(0)).alias("n")).first().n
    slabs, out, texts = chars // slab_chars + 1, [], docs.select(F.col(text).alias("t"))
    for s in range(slabs):
        part = items.filter(F.pmod(F.xxhash64("t"), F.lit(slabs)) == s) if slabs > 1 else items
        rows = sorted(part.collect(), key=lambda r: (r.i is None, r.i if r.i is not None else 0, r.t or ""))
        out.append(Index([r.i for r in rows], [r.t for r in rows]))
        out[-1].rank(_held(texts, out[-1]))
    return out, item_type


def find(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text",
         item_col: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD,
         slab_chars: int = SLAB_CHARS) -> DataFrame:
    """Links ``id, item, similarity, first_word, end_word, n_seeds`` between
    documents and the test items they hold: the best alignment of each pair,
    and the range of folded words it covers."""
    indexes, item_type = _indexes(docs, benchmark, text, item_col, item_text, slab_chars)
    d = docs.select(F.col(id_col).alias("id"), F.col(text).alias("t"))
    id_type, out = d.schema["id"].dataType.simpleString(), None
    for index in indexes:
        links = _link(d, index, threshold, id_type, item_type)
        out = links if out is None else out.unionByName(links)
    return out.withColumnsRenamed({"id": id_col, "item": item_col})


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_col: str = "item_id",
          item_text: str = "text", threshold: float = THRESHOLD, slab_chars: int = SLAB_CHARS) -> DataFrame:
    """The rows of ``docs`` that hold no test item, with their columns: each
    slab's pass drops its rows, nothing is shuffled."""
    indexes, _ = _indexes(docs, benchmark, text, item_col, item_text, slab_chars)
    at, names = docs.columns.index(text), docs.columns
    out = docs.toDF(*[f"c{i}" for i in range(len(names))])
    for index in indexes:
        out = out.mapInArrow(_dropper(index, at, threshold), out.schema)
    return out.toDF(*names)


def _dropper(index: Index, at: int, threshold: float):
    def run(batches):
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for r in _aligned(index, batch.column(at), threshold):
                keep[r[0]] = False
            yield batch.filter(pa.array(keep))
    return run
