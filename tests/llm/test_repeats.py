import hashlib
import random

import numpy as np
import pytest

from tests.llm.common import SCHEMA, docs, empty, rows, spaced
from walletgraph.llm import automata, passages, repeats, suffix_array
from walletgraph.llm.words import SPACED, Hasher

METHODS = ["suffix_array", "automata"]


def brute(own, size):
    first = {}
    for i, text, *_ in own:
        w = spaced(text)
        for p in range(len(w) - size + 1) if i is not None else ():
            key = tuple(w[p : p + size])
            first[key] = min(i, first.get(key, i))
    out = []
    for i, text, *_ in own:
        w = spaced(text)
        gone = [False] * len(w)
        for p in range(len(w) - size + 1) if i is not None else ():
            if first[tuple(w[p : p + size])] < i:
                gone[p : p + size] = [True] * size
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((i, len(w), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("method", METHODS)
@pytest.mark.parametrize("size", [50, 20, 7])
def test_brute(spark, method, size):
    assert got(repeats.digests(docs(spark, size), method, size)) == brute(rows(size), size)


def tangled(seed, n=80, words=4):
    """Texts of few words, so that phrases repeat in and across documents at all offsets."""
    rng = random.Random(seed)
    base = [rng.choice("abcdefgh"[:words]) for _ in range(150)]
    out = []
    for i in range(n):
        lo = rng.randrange(100)
        own = base[lo : lo + rng.randrange(1, 120)] + [rng.choice("xyz") for _ in range(rng.randrange(3))] + base[rng.randrange(100) :][: rng.randrange(80)]
        out.append((rng.randrange(n), " ".join(own), None, None, None, None, i))
    return out


@pytest.mark.parametrize("method", METHODS)
@pytest.mark.parametrize("hot", [4096, 3])
def test_tangled_and_hot(spark, monkeypatch, method, hot):
    """Small shards and flushes, ids that repeat with other texts, and phrases that nearly all documents have."""
    monkeypatch.setattr(passages, "HOT", hot)
    monkeypatch.setattr(passages, "FLUSH", 64)
    monkeypatch.setattr(passages, "FLUSH_WORDS", 500)
    monkeypatch.setattr(repeats.METHODS[method], "MOST", 300)
    own = tangled(1, words=8) + [(1000 + i, *rest) for i, *rest in tangled(2, words=2)]
    assert got(repeats.digests(spark.createDataFrame(own, SCHEMA).repartition(3), method, 20)) == brute(own, 20)


@pytest.mark.parametrize("method", METHODS)
def test_hot_rows(spark, method):
    """Half of all ids null, one id and text 3,000 times, one passage in a third of the rows."""
    rng = random.Random(4)
    say = lambda n: " ".join(f"w{rng.randrange(3000)}" for _ in range(n))
    passage, copy = say(60), say(80)
    own = [(None, f"{say(20)} {passage}") for _ in range(300)] + [(7, copy)] * 3000 + [(1000 + i, f"{say(20)} {passage} {say(20)}") for i in range(300)] + [(8, copy)]
    rng.shuffle(own)
    assert got(repeats.digests(spark.createDataFrame(own, "doc_id long, text string").repartition(4), method)) == brute(own, 50)


@pytest.mark.parametrize("method", METHODS)
def test_remove(spark, method):
    own = docs(spark)
    out = repeats.remove(own, method)
    assert out.schema == own.schema
    expected = {i: (n, gone, sha) for i, n, gone, sha in brute(rows(), 50)}
    kept = out.collect()
    assert {r.doc_id for r in kept} == {i for i, (n, gone, _) in expected.items() if n > gone or not gone}
    for r in kept:
        n, gone, sha = expected[r.doc_id]
        assert hashlib.sha256(" ".join(spaced(r.text)).encode()).hexdigest() == sha
        if gone:
            assert r.n_chars == len(r.text)
    before = {r[0]: r for r in rows()}
    assert all(tuple(r) == before[r.doc_id] for r in kept if not expected[r.doc_id][1])


@pytest.mark.parametrize("method", METHODS)
def test_reserved_names(spark, method):
    own = docs(spark).selectExpr("*", "1 AS __bucket", "2 AS own_id", "3 AS own_print", "4 AS OWN_SPOTS", "5 AS print", "6 AS mask", "7 AS at")
    out = repeats.remove(own, method)
    stay = [x for x in brute(rows(), 50) if x[1] > x[2] or not x[2]]
    assert out.schema == own.schema and out.where("own_id = 2 and OWN_SPOTS = 4 and at = 7").count() == len(stay)


@pytest.mark.parametrize("method", METHODS)
def test_empty(spark, method):
    assert repeats.digests(empty(spark), method).collect() == [] and repeats.remove(empty(spark), method).collect() == []
    nulls = spark.createDataFrame([(None,) * 7, (1, None, *(None,) * 5)], SCHEMA)
    assert sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in repeats.digests(nulls, method).collect()) == [(0, 0, 0), (1, 0, 0)]


def apart(spark):
    """Two documents that share a passage, in tasks of their own, so that no batch has both."""
    rng = random.Random(9)
    say = lambda n: " ".join(f"w{rng.randrange(3000)}" for _ in range(n))
    passage = say(60)
    return spark.createDataFrame([(1, f"{say(30)} {passage}"), (2, f"{passage} {say(30)}")], "doc_id long, text string").repartitionByRange(2, "doc_id")


def test_nothing_without_the_array(spark, monkeypatch):
    """The result is the array's: with every suffix taken for unlike its neighbours nothing is found."""
    assert sum(r.n_removed for r in repeats.digests(apart(spark), "suffix_array").collect()) == 60
    monkeypatch.setattr(suffix_array, "sorted_suffixes", lambda x: (np.arange(len(x)), np.full(len(x), -1)))
    assert sum(r.n_removed for r in repeats.digests(apart(spark), "suffix_array").collect()) == 0


def test_nothing_without_the_automata(spark, monkeypatch):
    """The result is the automata's: without their patterns nothing is found."""
    assert sum(r.n_removed for r in repeats.digests(apart(spark), "automata").collect()) == 60
    monkeypatch.setattr(automata.Stream, "patterns", lambda self, at: ["`" * self.count * self.letters] * len(at))
    assert sum(r.n_removed for r in repeats.digests(apart(spark), "automata").collect()) == 0


def test_suffixes():
    rng = np.random.default_rng(0)
    own = rng.integers(1, 3, (200, 6)).astype(np.uint64) << np.uint64(60)
    order, common = suffix_array.sorted_suffixes(own)
    assert own[order].tolist() == sorted(own.tolist())
    for i in range(1, 200):
        x, y = own[order[i - 1]], own[order[i]]
        assert common[i] == next((j for j in range(6) if x[j] != y[j]), 6)


def test_choice():
    """The leftmost least phrase of each window, and a hot one only if there is no other."""
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 6, 300).astype(np.uint64) << np.uint64(61)
    hot = passages.Hot(np.unique(keys)[:2])
    for known in (passages.Hot(np.zeros(0, np.uint64)), hot):
        weigh = [(bool(known.has(keys[i : i + 1])[0]), int(keys[i]) >> 25) for i in range(300)]
        want = [min(range(i, i + 11), key=lambda j: (weigh[j], j)) for i in range(290)]
        assert passages.choose(keys, 11, known).tolist() == want


def test_choice_in_parts(monkeypatch):
    keys = np.random.default_rng(2).integers(0, 1 << 63, 100).astype(np.uint64)
    whole = passages.choose(keys, 7, passages.Hot(np.zeros(0, np.uint64))).tolist()
    monkeypatch.setattr(passages, "_BITS", 5)
    assert passages.choose(keys, 7, passages.Hot(np.zeros(0, np.uint64))).tolist() == whole


def test_spans():
    hasher, hashes = Hasher(SPACED), np.random.default_rng(3).integers(0, 1 << 63, 50).astype(np.uint64)
    assert hasher.spans(hashes, np.arange(41), np.arange(41) + 10).tolist() == hasher.grams(hashes, 10).tolist()
