"""Source divergence by count-level bitsets against brute force."""

import random
import re
from collections import Counter, defaultdict

import pytest

from churnlab.llm import divergence as D

SCHEMA = "doc_id long, text string, lang string, source string, term string, value long, `seg.x` int, kind string, c int"
TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def rows(seed=4):
    rnd = random.Random(seed)
    vocab = ["".join(rnd.choice("abcdeé中") for _ in range(rnd.randint(1, 3))) for _ in range(90)]
    weight = {s: [rnd.random() ** 4 for _ in vocab] for s in ("a", "b", "c", "d", "", "é")}
    out = []
    for k in range(260):
        source = rnd.choice(["a", "a", "a", "b", "c", "d", None, "é"])
        lang = rnd.choice(["x", "x", "x", "y", None])
        words = rnd.choices(vocab, weight[source or ""], k=rnd.randint(0, 60))
        sep = rnd.choice([" ", ", ", "1", "\n"])
        out.append((k, sep.join(w.upper() if w.isascii() and rnd.random() < 0.2 else w for w in words), lang, source))
    out += [(300, None, "x", "silent"), (301, "", "x", "blank"), (302, "123 !?", "y", "digits"), (303, "a", "lonely", "one")]
    out += [(304 + k, "same words here same", "x", "a") for k in range(60)]          # a group of copies
    out += [(400, "é中 " * 3000 + "bcd " * 2000, "y", "long"), (5, "twice", "x", "b"), (5, "twice", "x", "b")]
    rnd.shuffle(out)
    return out


def brute(data, min_docs, top, scale=1_000_000_000, smooth=5):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in data:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        low = "".join(chr(ord(ch) + 32) if "A" <= ch <= "Z" else ch for ch in text or "")
        found = TERM.findall(low)
        docs[lang].update(set(found))
        counts[lang, source].update(found)
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        sources = [s for x, s in groups if x == lang]

        def share(c):
            whole = sum(c[t] for t in kept) + smooth * len(kept)
            return {t: 1 + scale * (c[t] + smooth) // whole for t in kept}
        p = {s: share(counts[lang, s]) for s in sources}
        q = share(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, k + 1) for k, (v, item) in enumerate(found[:most])]
    return Counter(out)


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('div')}/d"
    full = [(*r, "t", 1, 2, "k", 3) for r in rows()]
    spark.createDataFrame(full, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("options", [
    dict(min_docs=30, top=50), dict(min_docs=3, top=5, block=2, segment=7, segment_frequent=3, frequent=40),
    dict(min_docs=1, top=3, block=1, segment=1), dict(min_docs=10 ** 6, top=5)])
def test_audit_equals_brute_force(docs, options):
    want = brute(rows(), options["min_docs"], options["top"])
    assert Counter(tuple(r) for r in D.audit(docs, **options).collect()) == want


def test_tasks_that_hand_on_their_counts_and_cut_long_texts(docs, monkeypatch):
    kept = D.counts(docs, 3).collect()
    text = ("Ab é1" * 50).encode()
    monkeypatch.setattr(D, "PIECE", 16)
    cut = [t for piece in D._pieces(text) for t in D.TERM.findall(piece.lower())]
    assert cut == D.TERM.findall(text.lower())
    monkeypatch.setattr(D, "ENTRIES", 10)
    assert Counter(D.counts(docs, 3).collect()) == Counter(kept)


def test_empty_table(docs):
    none = D.audit(docs.limit(0))
    assert none.collect() == [] and none.columns == ["lang", "source", "part", "item", "value", "rank"]
