"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Folding lower-cases, replaces homoglyphs by the letters they look like, and
reads digits and signs inside words as letters. Lexicon entries are whole words
or word stems with weights; both are learned from labelled documents as
smoothed log odds. A hit inside an exception phrase does not count. The
weights' sum and its share of the text's length go through a logistic curve
fitted on the labelled documents, which gives a score from 0 to 1.

Null, empty and wordless texts have no hits and get the curve's value for none.
Repeated rows get equal scores. Without labelled documents of both classes the
lexicon is empty and every score is 0. An empty table gives an empty result;
columns other than id and text are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import arrow_rows

#: labelled documents of each class that lexicon and curve are learned from
FIT_DOCS = 20_000
#: entries of the lexicon, and the candidates it is chosen from
MAX_LEXICON, MAX_CANDIDATES = 2000, 20_000
MIN_DOCS, MIN_SHARE = 3, 0.015     # toxic documents that an entry needs, and their share
STEM = range(4, 8)                  # lengths of stems
THRESHOLD = 0.7

# Letters of other scripts that look like Latin ones.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "н": "h", "і": "i", "ј": "j", "к": "k",
    "ӏ": "l", "м": "m", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ѡ": "w", "х": "x",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
}
# Digits and signs read as letters inside words.
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}
# Phrases in which a listed word is harmless.
EXCEPTIONS = ("clown fish", "trash can", "trash bin", "trash bag", "recycle trash", "pond scum", "scum line")

_GLYPHS = {ord(k): v for k, v in HOMOGLYPHS.items()} | {0xFF21 + i: chr(97 + i) for i in range(26)} | {
    0xFF41 + i: chr(97 + i) for i in range(26)} | {0x200B: None, 0x200C: None, 0x200D: None, 0xAD: None}
_GLYPH = re.compile("[" + "".join(map(chr, _GLYPHS)) + "]")
_SIGN = re.compile(r"[0134578@$!](?=[0134578@$!]*[^\W\d_])")
_TOKEN = re.compile(r"[^\W\d_]+")


def fold(text: str) -> str:
    """Lower case, homoglyphs and digit substitutions undone."""
    t = text.lower()
    if not t.isascii() and _GLYPH.search(t):
        t = t.translate(_GLYPHS)
    return _SIGN.sub(lambda m: SIGNS[m.group()], t)


@dataclass
class Lexicon:
    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = EXCEPTIONS
    curve: tuple[float, float, float] | None = None      # constant, per weight, per share

    def automaton(self):
        import ahocorasick
        a = ahocorasick.Automaton()
        for kind, entries in ((0, self.words), (1, self.stems)):
            for w, v in entries.items():
                a.add_word(w, (*a.get(w, ()), (kind, len(w), v)))
        for p in self.exceptions:
            a.add_word(p, (*a.get(p, ()), (2, len(p), 0.0)))
        if len(a):
            a.make_automaton()
        return a


def hits(automaton, folded: str) -> list[tuple[int, int, float]]:
    """(start, end, weight) of the lexicon hits that no exception phrase covers."""
    found, safe = [], []
    if not len(automaton):
        return found
    for last, entries in automaton.iter(folded):
        for kind, n, v in entries:
            a, z = last + 1 - n, last + 1
            if a and folded[a - 1].isalpha():
                continue
            if kind != 1 and z < len(folded) and folded[z].isalpha():
                continue
            (safe if kind == 2 else found).append((a, z, v))
    if safe:
        found = [h for h in found if not any(a <= h[0] and h[1] <= z for a, z, _ in safe)]
    best: dict[int, tuple[int, int, float]] = {}        # one hit for each word
    for h in found:
        if h[0] not in best or h[2] > best[h[0]][2]:
            best[h[0]] = h
    return [best[a] for a in sorted(best)]


def features(automaton, text: str | None) -> tuple[float, float, int]:
    """Weight of the hits, that weight per root of the words, hits."""
    if not text:
        return 0.0, 0.0, 0
    got = hits(automaton, fold(text))
    total = sum(h[2] for h in got)
    return math.log1p(total), total / math.sqrt(text.count(" ") + text.count("\n") + 10), len(got)


def learn(docs: DataFrame, labels: DataFrame, train: Column | None = None, id_col: str = "doc_id",
          text: str = "text", label: str = "toxic", fit_docs: int = FIT_DOCS) -> Lexicon:
    """Lexicon and curve from at most ``fit_docs`` labelled documents of each
    class (picked by a hash of the id) for which ``train`` holds. Documents
    with the same smallest 5-word shingle count once, so a group of near
    copies does not make its rare words look telling."""
    arrow_rows(docs.sparkSession, 500)
    lab = labels.filter(train) if train is not None else labels
    chosen = None
    for c in (0, 1):
        part = (lab.filter((F.col(label) == c) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
                .agg(F.max(label).alias("y")).orderBy(F.xxhash64("id"), "id").limit(fit_docs))
        chosen = part if chosen is None else chosen.union(part)
    d = docs.select(F.col(id_col).alias("id"), F.col(text).alias("t")).join(F.broadcast(chosen), "id")

    def patterns(batches):
        for batch in batches:
            texts, ys = batch.column("t").to_pylist(), batch.column("y").to_pylist()
            keys, ids = [], batch.column("id").to_pylist()
            for w in W.split(batch.column("t"), lower=True):
                g = w.ngrams(5)
                for i in range(len(w)):
                    z = max(w.first[i], w.first[i + 1] - 4)
                    keys.append(int(W.signed(g[w.first[i]:z]).min()) if z > w.first[i] else
                                int(W.signed(w.hash[w.first[i]:w.first[i + 1]].sum(keepdims=True))[0]))
            rows = {"key": [], "id": [], "y": [], "t": []}
            for k, i, y, t in zip(keys, ids, ys, texts):
                if t:
                    rows["key"].append(k), rows["id"].append(i), rows["y"].append(y), rows["t"].append(t)
            yield pa.RecordBatch.from_pydict({"key": pa.array(rows["key"], pa.int64()),
                                              "id": pa.array(rows["id"], batch.column("id").type),
                                              "y": pa.array(rows["y"], pa.int32()),
                                              "t": pa.array(rows["t"], pa.string())})

    id_type = d.schema["id"].dataType.simpleString()
    keyed = d.select("id", "t", F.col("y").cast("int").alias("y")).mapInArrow(
        patterns, f"key long, id {id_type}, y int, t string")
    one = keyed.groupBy("key", "y").agg(F.min_by("t", F.struct("id", F.xxhash64("t"))).alias("t"))

    def counts(batches):
        for batch in batches:
            n = {0: Counter(), 1: Counter()}
            for y, t in zip(batch.column("y").to_pylist(), batch.column("t").to_pylist()):
                own = set()
                for w in set(_TOKEN.findall(fold(t))):
                    if len(w) >= 3:
                        own.add("w" + w)
                        own.update("s" + w[:k] for k in STEM if k < len(w))
                own.add("n")
                n[y].update(own)
            ks = list(n[0].keys() | n[1].keys())
            yield pa.RecordBatch.from_pydict({"p": pa.array(ks, pa.string()),
                                              "c0": pa.array([n[0][k] for k in ks], pa.int64()),
                                              "c1": pa.array([n[1][k] for k in ks], pa.int64())})

    table = one.select("y", "t").mapInArrow(counts, "p string, c0 long, c1 long").groupBy("p").agg(
        F.sum("c0").alias("c0"), F.sum("c1").alias("c1"))
    table = table.filter((F.col("p") == "n") | (F.col("c1") >= MIN_DOCS) & (F.col("c1") > 2 * F.col("c0")))
    rows = {r.p: (r.c0, r.c1) for r in table.orderBy(F.col("p") != "n", F.desc("c1"), "p").limit(MAX_CANDIDATES).collect()}
    n0, n1 = rows.pop("n", (0, 0))
    if not n0 or not n1:
        return Lexicon()
    lex = Lexicon()
    least = max(MIN_DOCS, MIN_SHARE * n1)
    scored = []
    for p, (c0, c1) in rows.items():
        share = (c1 / n1) / (c1 / n1 + c0 / n0)
        if c1 >= least and share >= (0.98 if p[0] == "w" else 0.99):
            scored.append((len(p), p, math.log((c1 + 0.5) / (n1 + 1) * (n0 + 1) / (c0 + 0.5)), c1))
    for _, p, v, c1 in sorted(scored):
        kind, w = p[0], p[1:]
        if any(w[:k] in lex.stems for k in STEM if k <= len(w)):
            continue
        if kind == "s" and rows.get("w" + w, (0, 0))[1] >= 0.9 * c1:
            continue                    # the word itself, not a stem
        (lex.words if kind == "w" else lex.stems)[w] = round(min(v, 8.0), 4)
    if len(lex.words) + len(lex.stems) > MAX_LEXICON:
        top = sorted([(rows["w" + w][1], "w" + w) for w in lex.words] + [(rows["s" + w][1], "s" + w) for w in lex.stems],
                     reverse=True)[:MAX_LEXICON]
        lex.words = {p[1:]: lex.words[p[1:]] for _, p in top if p[0] == "w"}
        lex.stems = {p[1:]: lex.stems[p[1:]] for _, p in top if p[0] == "s"}
    seen = _measure(one.select("y", "t"), lex, ["y"]).collect()
    lex.curve = _fit(np.array([[r.x0, r.x1] for r in seen]).reshape(-1, 2), np.array([r.y for r in seen], float))
    return lex


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> tuple[float, float, float]:
    """Logistic regression by Newton steps; rows ordered so that sums repeat exactly."""
    order = np.lexsort((y, x[:, 1], x[:, 0]))
    x, y = np.column_stack([np.ones(len(x)), x])[order], y[order]
    wt = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    b = np.zeros(3)
    reg = ridge * np.diag([0.0, 1.0, 1.0])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (wt * p * (1 - p))[:, None]).T @ x + reg + 1e-9 * np.eye(3)
        step = np.linalg.solve(h, x.T @ (wt * (y - p)) - reg @ b)
        b = b + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in np.round(b, 9))


def _measure(d: DataFrame, lex: Lexicon, passed: list[str]) -> DataFrame:
    """``passed`` columns, features and hits of the texts in column ``t``."""
    schema = ", ".join([f"`{c}` {d.schema[c].dataType.simpleString()}" for c in passed]
                       + ["x0 double, x1 double, n_hits long"])
    at = d.columns.index("t")
    keep = [d.columns.index(c) for c in passed]

    def run(batches):
        automaton = lex.automaton()
        for batch in batches:
            got = [features(automaton, t) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in keep], *[pa.array([g[j] for g in got], pa.float64()) for j in (0, 1)],
                 pa.array([g[2] for g in got], pa.int64())], [*passed, "x0", "x1", "n_hits"])

    return d.mapInArrow(run, schema)


def score(docs: DataFrame, lex: Lexicon, id_col: str = "doc_id", text: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """``id, score, predicted, n_hits`` of every document."""
    arrow_rows(docs.sparkSession, 500)
    d = docs.select(F.col(id_col).alias("id"), F.col(text).alias("t"))
    out = _measure(d, lex, ["id"])
    if lex.curve is None:
        s = F.lit(0.0)
    else:
        c = [F.lit(v) for v in lex.curve]
        s = F.round(1 / (1 + F.exp(-(c[0] + c[1] * F.col("x0") + c[2] * F.col("x1")))), 9)
    return out.select(F.col("id").alias(id_col), s.alias("score"), (s >= threshold).cast("int").alias("predicted"),
                      "n_hits")
