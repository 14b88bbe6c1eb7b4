"""Language identification: n-gram profiles by brute force, held-out accuracy, awkward cases."""

import math
import random
import unicodedata
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlab.llm import langid as L

SCHEMA = "doc_id long, text string, lang string, source string, t string, id long, score double, k int, `h.x` int"
SYLLABLES = {"aa": "ba be bi bo bu bam", "bb": "kra kre kri kro kru krim", "cc": "éta ité ôla ñam çed ïr", "dd": "ня ко ла ми ту ро"}


def text_of(rnd, lang, n):
    return " ".join("".join(rnd.choice(SYLLABLES[lang].split()) for _ in range(rnd.randint(1, 3))) for _ in range(n))


def rows():
    rnd = random.Random(6)
    out = [(k, text_of(rnd, lang, rnd.choice([3, 20, 200])), lang) for k, lang in enumerate(rnd.choices(list(SYLLABLES), k=240))]
    out += [(300 + k, text_of(random.Random(1), "aa", 30), "aa") for k in range(120)]       # a group of copies
    out += [(500, None, "aa"), (501, "", "bb"), (502, "123 !? ", "cc"), (503, text_of(rnd, "dd", 30), None), (504, None, None),
            (None, "babe", "aa"), (510, "twice ba", "aa"), (510, "twice ba", "aa"), (505, text_of(rnd, "cc", 30000), "cc"),
            (506, "字" * 50, "zz"), (507, "ب", None)]
    return out


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('lang')}/d"
    spark.createDataFrame([(i, x, y, "s", "t", 1, 0.5, 2, 3) for i, x, y in rows()], SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def model(docs):
    return L.learn(docs, F.col("doc_id") % 3 != 1, dims=1 << 12)


def naive(text, dims):
    """Cells of the n-grams counted one character at a time."""
    c = [" "] + [x if unicodedata.category(x)[0] in "LM" else " " for x in text] + [" "]
    out = Counter()
    for i in range(1, len(c) - 1):
        if c[i] != " ":
            for cell in L._hashed(np.array([ord(x) for x in c[i - 1:i + 2]], np.uint32), dims):
                out[int(cell)] += 1
    return out


@pytest.mark.parametrize("piece", [1 << 20, 1, 7])
def test_profile_counts_every_gram_once(monkeypatch, piece):
    monkeypatch.setattr(L, "PIECE", piece)
    for text in ("", "a", "ab", "éa b1c\n字x", "  two  words ", "\U0001f600a\U00020000b", text_of(random.Random(2), "cc", 40)):
        got = L.profile(text, 1 << 12)
        assert {int(k): int(got[k]) for k in np.flatnonzero(got)} == naive(text, 1 << 12)
        assert got.sum() == 3 * sum(unicodedata.category(x)[0] in "LM" for x in text)


def test_document_frequencies_cover_all_training_rows(docs, model):
    train = [x for i, x, y in rows() if i is not None and i % 3 != 1 and y is not None and x and any(c.isalpha() for c in x)]
    df = Counter(k for x in train for k in naive(x.lower(), 1 << 12))
    want = [math.log((len(train) + 1) / (df[k] + 1)) + 1 for k in range(1 << 12)]
    assert np.allclose(model.idf, want, atol=1e-5)


def test_prediction_is_the_nearest_centroid(docs, model):
    got = {}
    for r in L.identify(docs, model, reject=False).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(rows())
    right = seen = 0
    for i, x, y in rows():
        r = got[i][0]
        if not x or not any(c.isalpha() for c in x):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, False)
            continue
        v = np.zeros(1 << 12)
        for cell, n in naive(x.lower(), 1 << 12).items():
            v[cell] = (1 + math.log(n)) * model.idf[cell]
        cos = model.centroids @ (v / np.linalg.norm(v))
        assert abs((1 - cos.max()) - r.distance) < 1e-4 and 0 <= r.score <= 1
        if i is not None and i % 3 == 1 and y in SYLLABLES:
            seen, right = seen + 1, right + (r.lang_pred == y)
    assert seen > 60 and right >= 0.95 * seen
    assert len(model.langs) == 5 and (np.bincount(model.lang) <= 4).all()


def test_far_texts_are_rejected(spark, docs, model):
    d = spark.createDataFrame([(1, "ხვალ წავალთ ტყეში სოკოსთვის"), (2, text_of(random.Random(9), "bb", 60))], "doc_id long, text string")
    got = {r.doc_id: r for r in L.identify(d, model).collect()}
    assert got[1].rejected and got[1].lang_pred == "und" and got[1].distance > 0.9
    assert not got[2].rejected and got[2].lang_pred == "bb"
    assert {r.doc_id: r.lang_pred for r in L.identify(d, model, reject=False).collect()}[1] in model.langs


def test_ties_go_to_the_first_language():
    m = L.Model(["a", "b"], np.array([0, 1]), np.ones((2, 8), np.float32), np.ones(8, np.float32))
    assert int(m.cosines(np.arange(8)).argmax()) == 0


def test_nothing_to_learn_and_empty_tables(docs, monkeypatch):
    none = L.learn(docs, F.lit(False))
    assert {(r.lang_pred, r.score) for r in L.identify(docs, none).collect()} == {("und", 0.0)}
    assert L.identify(docs.limit(0), L.learn(docs.limit(0))).collect() == []
    monkeypatch.setattr(L, "MODEL_BYTES", 2 * 4 * 4 * L.DIMS)
    with pytest.raises(ValueError, match="languages"):
        L.learn(docs)


def test_result_does_not_depend_on_the_partitions(docs, model):
    again = L.learn(docs.repartition(7), F.col("doc_id") % 3 != 1, dims=1 << 12)
    assert np.array_equal(again.centroids, model.centroids) and again.sharpness == model.sharpness
    assert np.allclose(again.limit, model.limit)


def test_held_out_accuracy(spark):
    from churnlab.llm.queries import QUERIES
    sf = "/root/testdata/sf0.01"
    out = QUERIES["op12_language"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    r = out.filter("held_out and lang is not null and lang_pred <> 'und'").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("a"), F.count("*").alias("n")).first()
    assert r.n > 250 and r.a >= 0.98
