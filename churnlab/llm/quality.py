"""Quality rules: base measures and a line-labelling conditional random field.

``Viterbi decoding`` of a linear-chain CRF marks each line with a word as
content or boilerplate; a document whose share of words in content lines is
below ``share`` is rejected, and so is one that fails the base rules. The CRF
has binary line features and 2 x 2 transitions; it is fitted by maximum
likelihood on the lines of a bounded sample of labelled documents, whose
quality label all their lines take.

Null, empty and blank texts have no words and fail the base rules. Repeated
rows are judged each on their own, alike. With an empty table the result is
empty; without labelled documents of both classes every line is content, so
the base rules alone decide. Other columns, whatever their names, are ignored
by the measures and kept by ``keep``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import arrow_rows

MIN_WORDS = 50
MAX_REPEAT_PCT = 50
SHARE = 0.5
#: labelled documents of each class that the CRF is fitted on, and the largest text among them
FIT_DOCS, FIT_CHARS = 1500, 20_000

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_END = np.zeros(256, bool)
_END[list(b".!?:;\"')")] = True

FEATURES = ["bias", "words<=3", "words<=10", "words>40", "symbols>0", "symbols>.1", "symbols>.5", "marks>.1",
            "marks>.5", "upper>.3", "upper>.6", "same>.1", "same>.5", "repeat>.2", "repeat>.5", "end", "short",
            "long", "digits>.2", "duplicate"]


def measure(w: W.Words, texts: list[str | None]) -> tuple[dict[str, np.ndarray], list[np.ndarray], list[np.ndarray]]:
    """Base measures per document, and per document the features and word
    counts of its lines with a word."""
    n, words = len(w), np.diff(w.first)
    b = w.data
    chars = np.concatenate([[0], np.cumsum(((b & 0xC0) != 0x80) & ~W._SEP[b])]) if len(b) else np.zeros(1, np.int64)
    sym = np.concatenate([[0], np.cumsum(_SYMBOL[b])]) if len(b) else np.zeros(1, np.int64)
    off = w.off
    rep = _repeated(w)
    rc = np.concatenate([[0], np.cumsum(rep)])
    # lines: a new one at each document and after each newline
    edge = np.unique(np.concatenate([off[:-1], np.flatnonzero(b == 10) + 1]))
    line = np.searchsorted(edge, w.start, "right") - 1          # line of each word
    used, at, count = np.unique(line, return_index=True, return_counts=True) if len(line) else (
        np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    lo, hi = w.start[at], w.end[at + count - 1] if len(at) else at

    def per(mask):      # bytes of a class in each used line
        c = np.concatenate([[0], np.cumsum(mask[b])])
        return c[hi] - c[lo]

    dup, n_dup = np.zeros(len(used), bool), np.zeros(n, np.int64)
    first_line = np.searchsorted(used, np.searchsorted(edge, off[:-1], "left")) if len(used) else np.zeros(n, np.int64)
    last_line = np.append(first_line[1:], len(used))
    for i in np.flatnonzero(last_line - first_line > 1):
        seen, k = set(), first_line[i]
        for x in texts[i].split("\n"):
            if x.strip("\x20\x09\x0a\x0b\x0c\x0d"):
                if x in seen:
                    dup[k] = True
                seen.add(x)
                k += 1
        n_dup[i] = dup[first_line[i]:last_line[i]].sum()
    base = {"n_words": words, "word_chars": chars[off[1:]] - chars[off[:-1]], "n_symbols": sym[off[1:]] - sym[off[:-1]],
            "n_dup_lines": n_dup, "n_repeat_words": rc[w.first[1:]] - rc[w.first[:-1]]}
    if len(used):
        same = np.zeros(len(w.hash) + 1, np.int64)
        same[2:] = np.cumsum((w.hash[1:] == w.hash[:-1]) & (line[1:] == line[:-1]))
        last = at + count
        size = (w.end - w.start)
        sc = np.concatenate([[0], np.cumsum(size)])
        letters = np.maximum(per(_LETTER), 1)
        mean = (sc[last] - sc[at]) / count
        symbols, marks = per(_SYMBOL) / count, per(np.arange(256) == 33) / count
        upper, sames, reps = per(_UPPER) / letters, (same[last] - same[at]) / count, (rc[last] - rc[at]) / count
        x = np.stack([np.ones(len(used), bool), count <= 3, count <= 10, count > 40, symbols > 0, symbols > .1,
                      symbols > .5, marks > .1, marks > .5, upper > .3, upper > .6, sames > .1, sames > .5, reps > .2,
                      reps > .5, _END[b[hi - 1]], mean < 2.5, mean > 14,
                      per(_DIGIT) / np.maximum(sc[last] - sc[at], 1) > .2, dup], axis=1).astype(np.float32)
    else:
        x = np.zeros((0, len(FEATURES)), np.float32)
    cut = list(zip(first_line, last_line))
    return base, [x[a:z] for a, z in cut], [count[a:z] for a, z in cut]


def _repeated(w: W.Words) -> np.ndarray:
    """True for words in 3-word windows that occur twice or more in their document."""
    n = len(w.hash)
    out = np.zeros(n, bool)
    if n < 3:
        return out
    where = np.flatnonzero(w.starts(3)[:n - 2])
    key = W.mix(w.ngrams(3)[where] + w.doc[where].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    k = key[order]
    twice = np.zeros(len(k), bool)
    eq = k[1:] == k[:-1]
    twice[1:] |= eq
    twice[:-1] |= eq
    p = where[order[twice]]
    for j in range(3):
        out[p + j] = True
    return out


def viterbi(emit: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Best label sequence (1 content, 0 boilerplate) for emissions ``[lines, 2]``."""
    t00, t01, t10, t11 = (float(v) for v in trans.ravel())
    back, (a, c) = [], (0.0, 0.0)
    for k, (e0, e1) in enumerate(emit.tolist()):
        if k == 0:
            a, c = e0, e1
            continue
        from0, from1 = a + t00 < c + t10, a + t01 < c + t11     # ties stay with label 0
        a, c = (c + t10 if from0 else a + t00) + e0, (c + t11 if from1 else a + t01) + e1
        back.append((from0, from1))
    out = np.zeros(len(emit), np.int8)
    if len(emit):
        s = int(c >= a)
        out[-1] = s
        for k in range(len(back) - 1, -1, -1):
            s = int(back[k][s])
            out[k] = s
    return out


def fit(docs: list[tuple[np.ndarray, int]], rounds: int = 200, l2: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Weights ``[features, 2]`` and transitions ``[2, 2]`` by maximum
    likelihood (forward-backward gradients, Adam steps)."""
    f = len(FEATURES)
    docs = [d for d in docs if len(d[0])]
    if len({y for _, y in docs}) < 2:
        w = np.zeros((f, 2))
        w[0, 1] = 1.0
        return w, np.zeros((2, 2))
    docs.sort(key=lambda d: -len(d[0]))
    x = np.concatenate([d[0] for d in docs]).astype(float)
    sizes = np.array([len(d[0]) for d in docs])
    start = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    y = np.array([d[1] for d in docs])
    yl = np.repeat(y, sizes)
    live = [int((sizes > t).sum()) for t in range(sizes[0])]
    theta, m, v = np.zeros(f * 2 + 4), 0.0, 0.0
    total = len(x)
    gold = np.zeros((f, 2))
    for c in (0, 1):
        gold[:, c] = x[yl == c].sum(0)
    gold_t = np.array([[(sizes[y == 0] - 1).sum(), 0], [0, (sizes[y == 1] - 1).sum()]], float)
    for r in range(1, rounds + 1):
        w, t = theta[:2 * f].reshape(f, 2), theta[2 * f:].reshape(2, 2)
        e = x @ w
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        for k, n in enumerate(live):
            i = start[:n] + k
            alpha[i] = e[i] if k == 0 else e[i] + np.logaddexp.reduce(alpha[i - 1][:, :, None] + t, axis=1)
        for k in range(len(live) - 2, -1, -1):
            i = start[:live[k + 1]] + k
            beta[i] = np.logaddexp.reduce(t + (e[i + 1] + beta[i + 1])[:, None, :], axis=2)
        z = np.logaddexp.reduce(alpha[start] + beta[start], axis=1)
        zl = np.repeat(z, sizes)
        p = np.exp(alpha + beta - zl[:, None])
        inner = np.ones(total, bool)
        inner[start] = False
        i = np.flatnonzero(inner)
        pt = np.exp(alpha[i - 1][:, :, None] + t + (e[i] + beta[i])[:, None, :] - zl[i][:, None, None]).sum(0)
        g = np.concatenate([(gold - x.T @ p).ravel(), (gold_t - pt).ravel()]) / total - l2 * theta
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta + 0.1 * (m / (1 - 0.9 ** r)) / (np.sqrt(v / (1 - 0.999 ** r)) + 1e-8)
    return theta[:2 * f].reshape(f, 2), theta[2 * f:].reshape(2, 2)


def _slices(col: pa.Array):
    texts = col.to_pylist()
    for w in W.split(col):
        yield w, texts[w.base:w.base + len(w)]


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text",
          label: str = "quality", fit_docs: int = FIT_DOCS, fit_chars: int = FIT_CHARS):
    """Fit the CRF on at most ``fit_docs`` labelled documents of each class
    with texts of at most ``fit_chars`` characters, picked by a hash of the id."""
    chosen = None
    for c in (0, 1):
        part = (labels.filter((F.col(label) == c) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
                .agg(F.max(label).alias("y")).orderBy(F.xxhash64("id"), "id").limit(fit_docs))
        chosen = part if chosen is None else chosen.union(part)
    picked = docs.select(F.col(id_col).alias("id"), F.col(text).alias("t")).filter(F.length("t") <= fit_chars) \
        .join(F.broadcast(chosen), "id")        # bounded: 2 x fit_docs ids

    def feats(batches):
        for batch in batches:
            ys = batch.column("y").to_pylist()
            out = []
            for w, texts in _slices(batch.column("t")):
                _, xs, _ = measure(w, texts)
                out += [(x.astype(np.uint8).tobytes(), ys[w.base + i]) for i, x in enumerate(xs)]
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.binary()),
                                              pa.array([o[1] for o in out], pa.int32())], ["x", "y"])

    rows = picked.select("t", F.col("y").cast("int").alias("y")).mapInArrow(feats, "x binary, y int").collect()
    rows.sort()
    return fit([(np.frombuffer(bytes(r.x), np.uint8).reshape(-1, len(FEATURES)), r.y) for r in rows])


def judge(docs: DataFrame, model, id_col: str = "doc_id", text: str = "text", share: float = SHARE,
          extra: list[str] = ()) -> DataFrame:
    """Measures and verdict of every document: the id, the base measures,
    ``content_share``, ``base_failed`` and ``kept``, then the ``extra`` columns."""
    arrow_rows(docs.sparkSession, 500)
    wts, trans = model
    names = [id_col, *extra]
    read = names if text in names else [*names, text]
    d = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(read)])
    long = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    kept_schema = ", ".join([f"c{i} {d.schema[f'c{i}'].dataType.simpleString()}" for i in range(len(names))]
                            + [f"{c} long" for c in long] + ["content_share double", "base_failed boolean", "kept boolean"])

    def run(batches):
        for batch in batches:
            got = {c: [] for c in [*long, "content_share"]}
            for w, texts in _slices(batch.column(read.index(text))):
                base, xs, counts = measure(w, texts)
                for c in long:
                    got[c].append(base[c])
                got["content_share"].append(np.array([
                    float((n * viterbi(x @ wts, trans)).sum() / n.sum()) if len(n) else 0.0
                    for x, n in zip(xs, counts)]))
            if batch.num_rows == 0:
                continue
            v = {c: np.concatenate(a) for c, a in got.items()}
            failed = (v["n_words"] < MIN_WORDS) | (100 * v["n_repeat_words"] > MAX_REPEAT_PCT * v["n_words"])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(len(names))], *[pa.array(v[c], pa.int64()) for c in long],
                 pa.array(v["content_share"]), pa.array(failed), pa.array(~failed & (v["content_share"] >= share))],
                [*[f"c{i}" for i in range(len(names))], *long, "content_share", "base_failed", "kept"])

    out = d.mapInArrow(run, kept_schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], *long, "content_share", "base_failed",
                      "kept")


def keep(docs: DataFrame, model, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns."""
    cols = docs.columns
    return judge(docs, model, cols[0], text, extra=cols[1:], **options).filter("kept").select(
        *[F.col(f"`{c}`") for c in cols])
