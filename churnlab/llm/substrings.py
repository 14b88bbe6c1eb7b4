"""Substring de-duplication by repeated-phrase automata.

A window is ``WINDOW`` consecutive words of one document. Its anchor is the
``ANCHOR``-word phrase in it with the smallest hash (the leftmost of equal
ones), so equal windows have equal anchors, and a text has about one anchor in
fourteen words. Four steps:

1. count every anchor occurrence of all documents; anchors seen once cannot lie
   in a recurring window. The rest is marked in a bit table of fixed size; a
   wrong mark only makes a window a candidate that step 2 refutes;
2. confirm: the consecutive windows with one anchor are a run; runs are counted
   by anchor and hash, and all windows of a run found twice or more recur. Where
   an anchor also has a run of its own kind, as at the ends of a passage, its
   windows are counted one by one;
3. compile: the anchors of recurring windows are dealt to shards by their hash;
   each shard's task builds an Aho-Corasick automaton over word numbers;
4. locate: the parts of the documents with candidate windows are streamed
   through the automata of their anchors' shards; a window is removed when its
   anchor is found and the window is among the confirmed ones.

A shard whose anchors occur often is split by a salt, and each of its parts
gets the shard's phrases; a task holds one shard's phrases and one batch of
text. Words are numbered by 48-bit hashes.

Null, empty and short texts have no window and stay whole. Repeated rows are
documents of their own and recur in each other. An empty table gives an empty
result; columns other than id and text are ignored by ``report`` and kept by
``clean``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import arrow_rows, bit_table, in_table, materialize

WINDOW, ANCHOR = 35, 8
#: bits of the table of repeated anchors (16 MB)
TABLE_BITS = 1 << 27
#: anchor occurrences that one part of a shard should stream
PART_ANCHORS = 20_000
_LOW48 = np.uint64((1 << 48) - 1)


def anchors(h: np.ndarray, ok: np.ndarray, window: int = WINDOW, k: int = ANCHOR):
    """For the windows of word numbers ``h`` that ``ok`` lets start: (start,
    position of the anchor, anchor key)."""
    n = len(h) - window + 1
    if n <= 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, np.uint64)
    g = W.ngrams(h, k, seed=31)
    at = np.lib.stride_tricks.sliding_window_view(g, window - k + 1)[:n].argmin(axis=1)
    start = np.flatnonzero(ok[:n])
    pos = start + at[start]
    return start, pos, g[pos]


def _words(w: W.Words) -> np.ndarray:
    return w.hash & _LOW48


def _repeated(docs: DataFrame, bits: int, window: int):
    """Bit table of the anchors that occur twice or more, and the number of
    their occurrences."""
    def run(batches):
        for batch in batches:
            keys = []
            for w in W.split(batch.column(0)):
                _, pos, key = anchors(_words(w), w.starts(window), window)
                keys.append(key[np.unique(pos, return_index=True)[1]])
            k, n = np.unique(np.concatenate(keys) if keys else np.zeros(0, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(W.signed(k)), pa.array(n.astype(np.int64))], ["key", "n"])

    again = (docs.select("t").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
             .filter("n > 1"))
    again = materialize(again, "anchors")
    return bit_table(again, "key", bits), again.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n


def _candidates(docs: DataFrame, table, window: int) -> DataFrame:
    """One row per document: a row number, its words and digest; the text only
    of documents that have candidate windows."""
    id_type = docs.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts, t = batch.column("t").to_pylist(), table.value
            some = np.zeros(len(texts), bool)
            n = np.zeros(len(texts), np.int64)
            for w in W.split(batch.column("t")):
                start, _, key = anchors(_words(w), w.starts(window), window)
                some[w.base + np.unique(w.doc[start[in_table(t, key)]])] = True
                n[w.base:w.base + len(w)] = np.diff(w.first)
            sha = [None if s else digest(x) for s, x in zip(some, texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), pa.array(n), pa.array(sha, pa.string()),
                 pa.array([x if s else None for s, x in zip(some, texts)], pa.string())],
                ["row", "id", "n_words", "sha", "t"])

    return docs.select("row", "id", "t").mapInArrow(
        run, f"row long, id {id_type}, n_words long, sha string, t string")


def digest(text: str | None, removed: np.ndarray | None = None) -> str:
    """SHA-256 of the kept words, joined by one space."""
    return hashlib.sha256(kept(text, removed)).hexdigest()


def kept(text: str | None, removed: np.ndarray | None = None) -> bytes:
    words = (text or "").encode().split()       # splits at exactly the blanks of W.BLANKS
    if removed is not None:
        words = [x for x, gone in zip(words, removed) if not gone]
    return b" ".join(words)


_K = 0xD1342543DE82EF95
_K_INVERSE = pow(_K, -1, 1 << 64)


def _spans(h: np.ndarray, start: np.ndarray, size) -> np.ndarray:
    """Hash of the ``size`` words at each start (sizes may differ)."""
    if not len(start):
        return np.zeros(0, np.uint64)
    up, down = np.full(len(h), _K, np.uint64), np.full(len(h), _K_INVERSE, np.uint64)
    up[0] = down[0] = 1
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(W.mix(h) * np.cumprod(up), dtype=np.uint64)])
    size = np.broadcast_to(np.asarray(size, np.int64), start.shape)
    out = (total[start + size] - total[start]) * np.cumprod(down)[start]
    return W.mix(out + size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _run_ends(start: np.ndarray, pos: np.ndarray):
    """First and last of the windows of each run: equal anchor, next start."""
    if not len(start):
        z = np.zeros(0, np.int64)
        return z, z
    cut = np.flatnonzero(np.append(True, (pos[1:] != pos[:-1]) | (start[1:] != start[:-1] + 1)))
    return cut, np.append(cut[1:], len(start)) - 1


def _live(w: W.Words, table: np.ndarray, window: int):
    h = _words(w)
    start, pos, key = anchors(h, w.starts(window), window)
    c = in_table(table, key)
    return h, start[c], pos[c], key[c]


def _counted(a: list, b: list) -> pa.RecordBatch:
    """Pairs of two lists of keys and how often each occurs."""
    x, y = (np.concatenate(v) if v else np.zeros(0, np.uint64) for v in (a, b))
    order = np.lexsort((y, x))
    x, y = x[order], y[order]
    at = np.flatnonzero(np.append(True, (x[1:] != x[:-1]) | (y[1:] != y[:-1]))[:len(x)])
    n = np.diff(np.append(at, len(x)))
    return pa.RecordBatch.from_arrays([pa.array(W.signed(x[at])), pa.array(W.signed(y[at])), pa.array(n.astype(np.int32))],
                                      ["key", "span", "n"])


def _runs(cand: DataFrame, table, window: int) -> DataFrame:
    """Occurrences of each run: ``key, span, n``."""
    def run(batches):
        for batch in batches:
            a, b = [], []
            for w in W.split(batch.column(0)):
                h, start, pos, key = _live(w, table.value, window)
                i, j = _run_ends(start, pos)
                a.append(key[i])
                b.append(_spans(h, start[i], start[j] - start[i] + window))
            yield _counted(a, b)

    return (cand.select("t").mapInArrow(run, "key long, span long, n int").groupBy("key", "span")
            .agg(F.sum("n").alias("n")))


def _windows(cand: DataFrame, table, mixed, window: int) -> DataFrame:
    """Recurring windows of the anchors in the ``mixed`` table: ``key, span``."""
    def run(batches):
        for batch in batches:
            a, b = [], []
            for w in W.split(batch.column(0)):
                h, start, _, key = _live(w, table.value, window)
                some = in_table(mixed.value, key)
                a.append(key[some])
                b.append(_spans(h, start[some], window))
            yield _counted(a, b)

    return (cand.select("t").mapInArrow(run, "key long, span long, n int").groupBy("key", "span")
            .agg(F.sum("n").alias("n")).filter("n > 1").select("key", "span"))


def _pack(h: np.ndarray) -> bytes:
    return h.view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack(b: bytes) -> np.ndarray:
    out = np.zeros((len(b) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(b, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel()


def _phrases(cand: DataFrame, table, window: int) -> DataFrame:
    """Words of each candidate anchor: ``key, words``."""
    def run(batches):
        for batch in batches:
            seen = {}
            for w in W.split(batch.column(0)):
                h, _, pos, key = _live(w, table.value, window)
                for k, i in zip(*np.unique(key, return_index=True)):
                    seen.setdefault(int(k), _pack(h[pos[i]:pos[i] + ANCHOR]))
            k = np.array(list(seen), np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(W.signed(k)), pa.array(list(seen.values()), pa.binary())],
                                             ["key", "words"])

    return cand.select("t").mapInArrow(run, "key long, words binary").groupBy("key").agg(F.max("words").alias("words"))


def _segments(cand: DataFrame, table, salts, window: int) -> DataFrame:
    """The parts of each document that a shard has to see: runs of its candidate
    windows, with their words, dealt to one of the shard's parts."""
    def run(batches):
        for batch in batches:
            rows = batch.column("row").to_numpy()
            first, count = salts.value
            out = ([], [], [], [])
            for w in W.split(batch.column("t")):
                h, start, _, key = _live(w, table.value, window)
                if not len(start):
                    continue
                shard = (key % np.uint64(len(count))).astype(np.int64)
                doc = w.doc[start]
                order = np.lexsort((start, shard, doc))
                d, s, a = doc[order], shard[order], start[order]
                cut = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (s[1:] != s[:-1]) | (a[1:] > a[:-1] + window)))
                last = np.append(cut[1:], len(a)) - 1
                for i, j in zip(cut, last):
                    row = int(rows[w.base + d[i]])
                    out[0].append(int(first[s[i]] + (row * 0x9E3779B1 >> 7) % count[s[i]]))
                    out[1].append(row)
                    out[2].append(int(a[i] - w.first[d[i]]))
                    out[3].append(_pack(h[a[i]:a[j] + window]))
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()),
                                              pa.array(out[2], pa.int64()), pa.array(out[3], pa.binary())],
                                             ["part", "row", "start", "words"])

    return cand.select("row", "t").mapInArrow(run, "part int, row long, start long, words binary")


def _pair(key: np.ndarray, span: np.ndarray) -> np.ndarray:
    return W.mix(key * np.uint64(0x9E3779B97F4A7C15) + span)


def _known(known: np.ndarray, key: np.ndarray, span: np.ndarray) -> np.ndarray:
    c = _pair(key, span)
    return known[np.minimum(np.searchsorted(known, c), len(known) - 1)] == c


def _compiled(phrases: list, confirmed: list):
    """Automaton over the word numbers of the phrases, and the sorted hashes of
    the confirmed spans."""
    import ahocorasick
    a = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for words in phrases:
        a.add_word(tuple((_unpack(words) & np.uint64(0xFFFFFFFF)).tolist()), True)
    if len(a):
        a.make_automaton()
    return a, np.sort(np.concatenate(confirmed)) if confirmed else np.zeros(0, np.uint64)


def _locate(window: int):
    """Streams a part's phrases, then its segments: found ranges of words."""
    def run(batches):
        part, automaton, known, phrases, confirmed = None, None, None, [], []
        for batch in batches:
            kind, parts = batch.column("kind").to_numpy(), batch.column("part").to_numpy()
            a, b = (batch.column(c).fill_null(0).to_numpy() for c in ("a", "b"))
            words, out = batch.column("words"), ([], [], [])
            cut = np.flatnonzero(np.append(True, (parts[1:] != parts[:-1]) | (kind[1:] != kind[:-1]))[:len(kind)])
            for i, j in zip(cut, np.append(cut[1:], len(kind))):
                if parts[i] != part:
                    part, automaton, phrases, confirmed = parts[i], None, [], []
                if kind[i] == 0:
                    phrases += words[i:j].to_pylist()
                elif kind[i] == 1:
                    confirmed.append(_pair(a[i:j].view(np.uint64), b[i:j].view(np.uint64)))
                else:
                    if automaton is None:
                        automaton, known = _compiled(phrases, confirmed)
                        phrases, confirmed = [], []
                    if len(automaton) and len(known):
                        which, start, end = _found(automaton, known, words[i:j].to_pylist(), window)
                        out[0].append(a[i:j][which])
                        out[1].append(b[i:j][which] + start)
                        out[2].append(b[i:j][which] + end)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64())
                                              for x in out], ["row", "start", "end"])

    return run


def _found(automaton, known: np.ndarray, segments: list, window: int):
    """(segment, start, end) of the ranges of recurring windows."""
    size = np.array([len(x) // 6 for x in segments], np.int64)
    first = np.concatenate([[0], np.cumsum(size)])
    h = _unpack(b"".join(segments))
    hit = np.zeros(len(h) + 1, bool)        # an anchor of this shard starts here
    for last, _ in automaton.iter(tuple((h & np.uint64(0xFFFFFFFF)).tolist())):
        hit[last + 1 - ANCHOR] = True
    ok = np.arange(len(h)) + window <= np.repeat(first[1:], size)
    start, pos, key = anchors(h, ok, window)
    some = hit[pos]
    start, pos, key = start[some], pos[some], key[some]
    i, j = _run_ends(start, pos)
    here = np.repeat(_known(known, key[i], _spans(h, start[i], start[j] - start[i] + window)), j - i + 1)
    rest = np.flatnonzero(~here)
    here[rest] = _known(known, key[rest], _spans(h, start[rest], window))
    start = start[here]
    which = np.searchsorted(first, start, "right") - 1
    cut = np.flatnonzero(np.append(True, (start[1:] > start[:-1] + window) | (which[1:] != which[:-1]))[:len(start)])
    last = np.append(cut[1:], len(start)) - 1 if len(cut) else cut
    which = which[cut]
    return which, start[cut] - first[which], start[last] - first[which] + window


def mark(docs: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW,
         bits: int = TABLE_BITS, part_anchors: int = PART_ANCHORS) -> DataFrame:
    """One row per document: ``row, id, n_words, sha, t, ranges``. ``ranges``
    holds the word ranges (start, end) that recur; ``sha`` is the digest and
    ``t`` null where a document has no candidate window."""
    spark = docs.sparkSession
    arrow_rows(spark, 500)
    d = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text).alias("t"))
    repeated, seen = _repeated(d, bits, window)
    table = spark.sparkContext.broadcast(repeated)
    whole = materialize(_candidates(d, table, window), "candidates")
    cand = whole.filter(F.col("t").isNotNull())
    runs = materialize(_runs(cand, table, window), "runs")
    mixed = runs.groupBy("key").agg(F.min("n").alias("low"), F.sum("n").alias("n")).filter("low = 1 and n > 1")
    mixed = spark.sparkContext.broadcast(bit_table(mixed, "key", bits))
    confirmed = materialize(runs.filter("n > 1").select("key", "span").union(_windows(cand, table, mixed, window)),
                            "confirmed")
    # shards by the number of anchor occurrences; a frequent shard has several parts
    shards = int(seen // part_anchors + 1)
    shard = F.expr(f"pmod(pmod(key, {shards}) + if(key < 0, pmod(18446744073709551616BD, {shards}), 0), {shards})").cast("int")
    load = runs.groupBy(shard.alias("shard")).agg(F.sum("n").alias("n")).collect()      # a row per shard
    count = np.ones(shards, np.int64)
    for r in load:
        count[r.shard] = r.n // (2 * part_anchors) + 1
    first = np.concatenate([[0], np.cumsum(count)[:-1]])
    salts = spark.sparkContext.broadcast((first, count))
    parts = spark.createDataFrame([(s, int(first[s]), int(count[s])) for s in range(shards)], "shard int, p int, c int")
    phrases = _phrases(cand, table, window).join(confirmed.select("key").distinct(), "key", "left_semi")
    null = F.lit(None)
    rows = (phrases.select(shard.alias("shard"), F.lit(0).alias("kind"), F.col("key").alias("a"),
                           null.cast("long").alias("b"), "words")
            .union(confirmed.select(shard.alias("shard"), F.lit(1).alias("kind"), F.col("key").alias("a"),
                                    F.col("span").alias("b"), null.cast("binary").alias("words"))))
    rows = rows.join(F.broadcast(parts), "shard").select(
        F.explode(F.sequence("p", F.col("p") + F.col("c") - 1)).alias("part"), "kind", "a", "b", "words")
    rows = rows.union(_segments(cand, table, salts, window).select(
        "part", F.lit(2).alias("kind"), F.col("row").alias("a"), F.col("start").alias("b"), "words"))
    found = (rows.repartition("part").sortWithinPartitions("part", "kind")
             .mapInArrow(_locate(window), "row long, start long, end long"))
    ranges = found.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    marked = cand.join(ranges, "row", "left")
    return marked.unionByName(whole.filter(F.col("t").isNull()).withColumn(
        "ranges", F.lit(None).cast("array<struct<start:bigint,end:bigint>>")))


def removed(n: int, ranges) -> np.ndarray:
    gone = np.zeros(n, bool)
    for r in ranges or ():
        gone[r["start"]:r["end"]] = True
    return gone


def _finish(marked: DataFrame, texts: bool) -> DataFrame:
    id_type = marked.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            n, t = batch.column("n_words").to_pylist(), batch.column("t").to_pylist()
            sha, rs = batch.column("sha").to_pylist(), batch.column("ranges").to_pylist()
            out = ([], [], [])
            for i in range(len(n)):
                gone = removed(n[i], rs[i])
                words = kept(t[i], gone) if sha[i] is None or texts else b""
                out[0].append(int(gone.sum()))
                out[1].append(sha[i] or hashlib.sha256(words).hexdigest())
                out[2].append(words.decode() if texts and gone.any() else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n_words"), pa.array(out[0], pa.int64()),
                 pa.array(out[1], pa.string()), pa.array(out[2], pa.string())],
                ["id", "n_words", "n_removed", "kept_sha256", "kept"])

    return marked.select("id", "n_words", "sha", "t", "ranges").mapInArrow(
        run, f"id {id_type}, n_words long, n_removed long, kept_sha256 string, kept string")


def report(docs: DataFrame, id_col: str = "doc_id", texts: bool = False, **options) -> DataFrame:
    """``id, n_words, n_removed, kept_sha256`` of every document, and with
    ``texts`` the kept words of documents that lost some (null for others)."""
    out = _finish(mark(docs, id_col, **options), texts)
    out = out.withColumnRenamed("id", id_col)
    return out if texts else out.drop("kept")
