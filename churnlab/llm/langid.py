"""Language identification by the nearest of several centroids per language.

A text becomes a TF-IDF vector of its letter n-grams (one to three characters,
words padded by a blank, lower-cased, hashed into ``dims`` cells; 1 + log of the
count times the inverse document frequency), normalised to length 1. Document
frequencies are counted over every training text. The training texts of a
language are clustered into ``k`` centroids by spherical k-means, and a text takes
the language of the centroid with the largest cosine.

Rejection: a text is further from its centroid the fewer n-grams it has, so
each band of n-gram counts (powers of two) has its own largest accepted
distance: the ``accept`` quantile of the distances that sample texts, and pieces
of them cut to every band, have to their nearest own centroid, and a slack on
top. A text beyond it is rejected: it is in no learned language.

The score is the share of the chosen language in a softmax of the languages'
cosines, whose sharpness is picked by likelihood on the sample's pieces.

What is fitted on a sample: centroids, distance limits and sharpness, on at most
``SAMPLE`` different texts per language, the smallest by hash of the text. What
covers everything: document frequencies and predictions. The model holds
``languages x k x dims`` numbers of 4 bytes (256 KB a language by default), checked
against ``MODEL_BYTES``; the driver holds it and its tasks get a copy.

Defined results: a null text, or one without a letter, is ``und`` with score 0,
not rejected, distance 1. Texts of any length are read whole, in pieces. Equal
cosines go to the language first in UTF-8 order. Rows without a language are not
learned from; copies of a text count once in the sample and each in the document
frequencies. Without any training row every text is ``und``. An empty table gives
an empty result. Columns other than the named ones are ignored, whatever their names.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize

DIMS = 1 << 14
SAMPLE = 1000           # different texts per language that centroids are fitted on
MODEL_BYTES = 1 << 28
UNKNOWN = "und"
PIECE = 1 << 20         # characters of a text that are hashed at once
BANDS = 24
SHARPNESS = (10.0, 20.0, 40.0, 80.0, 160.0)
SLACK = 1.02
_M = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)]


@lru_cache(1)
def _letters() -> np.ndarray:
    """Whether a code point is a letter or a mark on one."""
    return np.array([unicodedata.category(chr(i))[0] in "LM" for i in range(0x110000)])


def _hashed(c: np.ndarray, dims: int) -> np.ndarray:
    """Cells of the n-grams of a run of code points that starts and ends with a
    blank; every other character is a letter or a blank."""
    shift = np.uint32(32 - int(dims).bit_length() + 1)
    inner = c[1:-1] != 32
    a, b, z = c[:-2][inner], c[1:-1][inner], c[2:][inner]
    one = b * _M[0]
    two = one + z * _M[1]                       # a letter and what follows it
    three = two + a * _M[2] + np.uint32(7)      # and what precedes it
    out = []
    for h in (one, two ^ np.uint32(0x5bd1e995), three):
        h = (h ^ (h >> np.uint32(15))) * _M[1]
        out.append((h ^ (h >> np.uint32(13))) * _M[0] >> shift)
    return np.concatenate(out)


def profile(text: str, dims: int = DIMS) -> np.ndarray:
    """Count of every cell."""
    total = np.zeros(dims, np.int64)
    letters = _letters()
    before = 32
    for lo in range(0, len(text), PIECE):       # a piece sees the character before and after it
        part = np.frombuffer(text[lo:lo + PIECE + 1].encode("utf-32-le", "replace"), np.uint32)
        own = np.concatenate([np.array([before], np.uint32), part] + ([] if lo + PIECE < len(text) else [np.array([32], np.uint32)]))
        c = np.where(letters[own], own, np.uint32(32))
        total += np.bincount(_hashed(c, dims), minlength=dims)
        before = int(own[-2])
    return total


def _profiles(column: pa.Array, dims: int) -> Iterator[np.ndarray]:
    for lo in range(0, len(column), 64):        # few texts at once as Python strings
        for t in pc.utf8_lower(column.slice(lo, 64).fill_null("")).to_pylist():
            yield profile(t, dims)


@dataclass
class Model:
    """Centroids (rows of ``centroids``, ``lang`` is the number of the language of
    each), inverse document frequencies, largest accepted distance per band."""
    langs: list[str] = field(default_factory=list)
    lang: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    centroids: np.ndarray = field(default_factory=lambda: np.zeros((0, DIMS), np.float32))
    idf: np.ndarray = field(default_factory=lambda: np.ones(DIMS, np.float32))
    limit: np.ndarray = field(default_factory=lambda: np.ones(BANDS))
    sharpness: float = SHARPNESS[0]

    def cosines(self, count: np.ndarray) -> np.ndarray:
        """Largest cosine of a profile with the centroids of each language."""
        at, v = _vector(count, self.idf)
        best = np.full(len(self.langs), -1.0)
        np.maximum.at(best, self.lang, self._by_cell[at].T @ v if len(at) else np.zeros(len(self.lang)))
        return best

    @property
    def _by_cell(self) -> np.ndarray:
        if "_cells" not in self.__dict__:
            self._cells = np.ascontiguousarray(self.centroids.T)
        return self._cells


def _vector(count: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells and values of a normalised TF-IDF vector."""
    at = np.flatnonzero(count)
    v = (1 + np.log(count[at])) * idf[at]
    return at, (v / (np.linalg.norm(v) or 1.0)).astype(np.float32)


def _band(count: np.ndarray) -> int:
    return min(BANDS - 1, int(count.sum() // 3).bit_length())


def document_frequencies(d: DataFrame, dims: int = DIMS) -> tuple[np.ndarray, int]:
    """Texts that have each cell, over all rows, and the number of texts."""
    def run(batches):
        n, df = 0, np.zeros(dims, np.int64)
        for batch in batches:
            for count in _profiles(batch.column(0), dims):
                df += count > 0
                n += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], n))], ["cell", "n"])

    got = d.select("t").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    cell, n = got.column("cell").to_numpy(), got.column("n").to_numpy()
    out = np.zeros(dims, np.int64)
    out[cell[cell >= 0]] = n[cell >= 0]
    return out, int(n[cell == -1].sum())


def sample(d: DataFrame, most: int = SAMPLE) -> DataFrame:
    """Up to ``most`` different texts per language, the smallest by hash. A hash
    limit per language, from its number of different texts, keeps what is sorted
    small; copies are combined before they are shuffled."""
    h = d.select("lang", "t", F.xxhash64("t").bitwiseAND(F.lit((1 << 62) - 1)).alias("h"))
    per = h.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("n"))
    reach = F.least(F.lit(1.0), F.lit(1.5 * most + 100) / F.col("n")) * float(1 << 62)
    near = (h.join(F.broadcast(per.select("lang", reach.alias("reach"))), "lang").filter(F.col("h") <= F.col("reach"))
            .groupBy("lang", "h").agg(F.min("t").alias("t")))
    first = W.partitionBy("lang").orderBy("h")
    return near.withColumn("k", F.row_number().over(first)).filter(F.col("k") <= most).select("lang", "k", "t")


def _cluster(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; the first centroids are the mean and then the vectors
    furthest from those chosen."""
    mean = x.mean(0)
    cents = [mean / (np.linalg.norm(mean) or 1.0)]
    near = x @ cents[0]
    while len(cents) < min(k, len(x)):
        cents.append(x[int(near.argmin())])
        near = np.maximum(near, x @ cents[-1])
    c = np.array(cents, np.float32)
    for _ in range(rounds):
        at = (x @ c.T).argmax(1)
        for j in range(len(c)):
            if (at == j).any():
                m = x[at == j].mean(0)
                c[j] = m / (np.linalg.norm(m) or 1.0)
    return c


def _pieces(text: str) -> Iterator[str]:
    """The text and pieces of it of 2, 8, 32 ... characters."""
    yield text
    size, lo = 2, 0
    while size < len(text):
        yield text[lo:lo + size]
        lo, size = (lo + size) % max(1, len(text) - 4 * size), 4 * size


def learn(docs: DataFrame, train: Column | None = None, text: str = "text", lang: str = "lang", k: int = 4,
          dims: int = DIMS, most: int = SAMPLE, accept: float = 0.995) -> Model:
    """Model of the languages of the rows for which ``train`` holds."""
    d = docs.filter(train) if train is not None else docs
    d = (d.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("t"))
         .filter(F.col("lang").isNotNull()))
    # before anything is sized by the number of languages
    room = MODEL_BYTES // (k * dims * 4)
    if d.select("lang").distinct().limit(room + 1).count() > room:
        raise ValueError(f"more than {room} languages: raise MODEL_BYTES or lower k or dims")
    d = d.filter(has_letter(F.col("t")))
    df, n = document_frequencies(d, dims)
    if not n:
        return Model()
    idf = (np.log((n + 1) / (df + 1)) + 1).astype(np.float32)
    chosen = materialize(sample(d, most), "language_sample")

    def fit(_, t):
        texts = pc.utf8_lower(t.sort_by("k").column("t").combine_chunks()).to_pylist()
        x = np.zeros((len(texts), dims), np.float32)
        for i, s in enumerate(texts):
            at, v = _vector(profile(s, dims), idf)
            x[i, at] = v
        c = _cluster(x, k)
        name = t.column("lang")[0].as_py()
        return pa.table({"lang": pa.array([name] * len(c), pa.string()), "j": pa.array(range(len(c)), pa.int32()),
                         "c": pa.array([r.tobytes() for r in c], pa.binary())})

    rows = chosen.groupBy("lang").applyInArrow(fit, "lang string, j int, c binary").orderBy("lang", "j").collect()
    langs = sorted({r.lang for r in rows}, key=str.encode)
    model = Model(langs, np.array([langs.index(r.lang) for r in rows], np.int64),
                  np.array([np.frombuffer(r.c, np.float32) for r in rows]), idf)
    _set_limits(model, chosen, dims, accept)
    return model


def _set_limits(model: Model, chosen: DataFrame, dims: int, accept: float) -> None:
    """Distance limits and sharpness from the sample's texts and pieces."""
    def run(batches):
        for batch in batches:
            band, dist, loss = [], [], []
            for name, s in zip(batch.column("lang").to_pylist(), pc.utf8_lower(batch.column("t")).to_pylist()):
                own = model.langs.index(name)
                for piece in _pieces(s):
                    count = profile(piece, dims)
                    if not count.any():
                        continue
                    cos = model.cosines(count)
                    band.append(_band(count)), dist.append(1.0 - float(cos[own]))
                    loss.append([-float(np.log(max(_softmax(cos, s)[own], 1e-12))) for s in SHARPNESS])
            yield pa.RecordBatch.from_arrays([pa.array(band, pa.int32()), pa.array(dist, pa.float64()),
                                              pa.array(loss, pa.list_(pa.float64()))], ["band", "dist", "loss"])

    seen = chosen.mapInArrow(run, "band int, dist double, loss array<double>")
    rows = seen.groupBy("band").agg(F.percentile("dist", F.lit(accept)).alias("limit"),
                                    *[F.sum(F.element_at("loss", i + 1)).alias(f"l{i}") for i in range(len(SHARPNESS))]).collect()
    at = {r.band: min(1.0, r.limit * SLACK) for r in rows}
    if not at:
        return
    # bands without a text take the limit of the next longer one seen, else of the longest
    model.limit = np.array([at[min((b for b in at if b >= i), default=max(at))] for i in range(BANDS)])
    model.sharpness = min(SHARPNESS, key=lambda s: sum(round(r[f"l{SHARPNESS.index(s)}"], 6) for r in rows))


def _softmax(cos: np.ndarray, sharpness: float) -> np.ndarray:
    e = np.exp((cos - cos.max()) * sharpness)
    return e / e.sum()


def has_letter(t: Column) -> Column:
    return F.coalesce(t.rlike(r"\p{L}"), F.lit(False))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text",
             reject: bool = True) -> DataFrame:
    """``id, lang_pred, score, distance, rejected`` of every document. With
    ``reject`` a rejected text is ``und`` (its score stays that of the nearest
    language); without, it keeps the nearest language."""
    dims = model.centroids.shape[1]
    d = docs.select(F.col(id_col).alias("id"), F.when(has_letter(F.col(text)), F.col(text)).alias("t"))
    id_type = d.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            langs, scores, dists, out = [], [], [], []
            texts = batch.column("t")
            for known, count in zip(texts.is_valid().to_pylist(), _profiles(texts, dims)):
                if not known or not model.langs:
                    langs.append(UNKNOWN), scores.append(0.0), dists.append(1.0), out.append(False)
                    continue
                cos = np.round(model.cosines(count), 6)
                best = int(cos.argmax())                    # the first of equal cosines
                dist = round(1.0 - float(cos[best]), 6)
                far = dist > model.limit[_band(count)]
                langs.append(UNKNOWN if far and reject else model.langs[best])
                scores.append(round(float(_softmax(cos, model.sharpness)[best]), 6)), dists.append(dist), out.append(far)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(dists, pa.float64()), pa.array(out, pa.bool_())], ["id", "lang_pred", "score", "distance", "rejected"])

    out = d.mapInArrow(run, f"id {id_type}, lang_pred string, score double, distance double, rejected boolean")
    return out.withColumnRenamed("id", id_col)
