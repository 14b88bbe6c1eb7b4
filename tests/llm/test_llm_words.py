"""Vectorised words and hashes against regular expressions."""

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

import llm_cases as C
from churnlab.llm import words as W

TEXT = st.one_of(st.none(), st.text(alphabet="aAbB \t\n\x0b\x0c\r\x1c\x85 é中.1", max_size=60))


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXT, max_size=8))
def test_words_are_those_of_the_pattern(texts):
    seen = {}
    got = [[] for _ in texts]
    for w in W.split(pa.array(texts, pa.string())):
        for i in range(len(w)):
            for j in range(w.first[i], w.first[i + 1]):
                word = bytes(w.data[w.start[j]:w.end[j]]).decode()
                got[w.base + i].append(word)
                assert seen.setdefault(word, w.hash[j]) == w.hash[j]
    assert got == [C.words(x) for x in texts]
    assert len(set(map(int, seen.values()))) == len(seen)


def test_long_words_slices_and_case():
    long = ["x" * 5000 + "A", "x" * 5000 + "a", "x" * 5000 + "b"]
    w = next(W.split(pa.array(long), lower=True))
    assert w.hash[0] == w.hash[1] != w.hash[2]
    big = ["word " * 300_000, None, "tail"]
    parts = list(W.split(pa.array(big)))
    assert len(parts) > 1 and sum(len(p) for p in parts) == 3 and parts[-1].hash[-1] == next(W.split(pa.array(["tail"]))).hash[0]


def test_ngrams_do_not_cross_documents():
    w = next(W.split(pa.array(["a b c", "d", "e f"])))
    assert w.starts(2).tolist() == [True, True, False, False, True, False]
    assert np.unique(w.ngrams(2)).size == 5
    assert len(w.ngrams(9)) == 0
