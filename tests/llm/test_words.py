import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.common import lower, plain, spaced, texts
from walletgraph.llm import words as W
from walletgraph.llm.buckets import KeyFilter


def per_document(alphabet, own):
    out = []
    for _, counts, hashes in W.Hasher(alphabet).words(pa.array(own, pa.string())):
        out += np.split(hashes, np.cumsum(counts)[:-1])
    return out


def check(own):
    for alphabet, cut in ((W.SPACED, spaced), (W.SPACED_LOWER, lambda t: spaced(lower(t))), (W.PLAIN_LOWER, plain)):
        seen = {}
        found = per_document(alphabet, own)
        assert len(found) == len(own)
        for text, hashes in zip(own, found, strict=True):
            expected = cut(text)
            assert len(hashes) == len(expected)
            for w, h in zip(expected, hashes.tolist(), strict=True):
                assert seen.setdefault(w, h) == h
        assert len(set(seen.values())) == len(seen)


def test_corpus():
    check(texts())


def test_pieces(monkeypatch):
    monkeypatch.setattr(W, "PIECE", 64)
    check(texts() + ["ab " * 100, "c" * 500, " " * 300 + "d" * 200 + " e"])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=30)), min_size=1, max_size=5))
def test_any_text(own):
    check([None if t is None else re.sub("[\ud800-\udfff]", "", t) for t in own])


def test_grams_and_minima():
    rng = np.random.default_rng(0)
    h = W.Hasher(W.SPACED)
    a = rng.integers(0, 3, 200).astype(np.uint64)
    for k in (1, 3, 10):
        g, seen = h.grams(a, k), {}
        for i in range(len(a) - k + 1):
            assert seen.setdefault(tuple(a[i : i + k]), g[i]) == g[i]
        assert len(set(seen.values())) == len(seen)
        x = rng.integers(0, 1000, 97).astype(np.uint64)
        assert W.sliding_min(x, k).tolist() == [min(x[i : i + k]) for i in range(len(x) - k + 1)]
    counts = np.array([3, 0, 1, 5])
    assert W.within(counts, 3).tolist() == [True, False, False, False, True, True, True]
    assert len(h.grams(a[:2], 3)) == len(W.sliding_min(a[:2], 3)) == len(W.within(np.array([2]), 3)) == 0


def test_filter(spark):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), 12345678901]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    (f,) = KeyFilter.of(df, "k")
    assert f.has(np.array(keys)).all() and not f.has(np.arange(1000, 2000)).any()
