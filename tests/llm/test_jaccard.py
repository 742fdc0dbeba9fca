import collections

import pytest

from tests.llm.common import SCHEMA, docs, empty, lower, rows, spaced
from walletgraph.llm import jaccard


def shingles(text, k):
    w = spaced(lower(text))
    return frozenset(tuple(w[p : p + k]) for p in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(own, k, num, den):
    """Smallest id by set: rows are nodes, and rows of one set are linked."""
    own = [(i, shingles(t, k)) for i, t, *_ in own]
    root = list(range(len(own)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, (i, a) in enumerate(own):
        for y, (j, b) in enumerate(own[:x]):
            if a and b and i is not None and j is not None and den * len(a & b) >= num * len(a | b):
                root[find(x)] = find(y)
    least = collections.defaultdict(list)
    for x, (i, _) in enumerate(own):
        if i is not None:
            least[find(x)].append(i)
    return sorted(((i, len(a), None if i is None else min(least[find(x)])) for x, (i, a) in enumerate(own)), key=repr)


@pytest.mark.parametrize("k,num", [(4, 85), (5, 80), (3, 60), (1, 90), (1, 50), (2, 30)])
def test_brute(spark, k, num):
    seed = k + num
    out = jaccard.near_duplicates(docs(spark, seed), k, num, 100)
    assert sorted(map(tuple, out.collect()), key=repr) == brute(rows(seed), k, num, 100)


@pytest.mark.parametrize("small", [0, 8, 64])
def test_boundaries_and_parts(spark, monkeypatch, small):
    """Whatever the boundary, and with lists that are split, links are the same."""
    monkeypatch.setattr(jaccard, "boundary", lambda *_: small)
    monkeypatch.setattr(jaccard, "PART", 2)
    monkeypatch.setattr(jaccard, "PART_SHIFT", 60)
    monkeypatch.setattr(jaccard, "BATCH_LEAST", 1)
    monkeypatch.setattr(jaccard, "FLUSH", 64)
    assert sorted(map(tuple, jaccard.near_duplicates(docs(spark), 4, 70, 100).collect()), key=repr) == brute(rows(), 4, 70, 100)


@pytest.mark.parametrize("num,small", [(50, 8), (30, 0), (30, 64)])
def test_one_common_word(spark, monkeypatch, num, small):
    """Small sets that are similar by a single n-gram."""
    monkeypatch.setattr(jaccard, "boundary", lambda *_: small)
    own = [(1, "x"), (2, "x y"), (3, "y z"), (4, "p q r"), (5, "r s t"), (6, "s"), (7, "u v w a b c d e f"), (8, "u"), (9, "u v w g h i j k l")]
    out = jaccard.near_duplicates(spark.createDataFrame(own, "doc_id long, text string").repartition(4), 1, num, 100)
    assert sorted(map(tuple, out.collect()), key=repr) == brute(own, 1, num, 100)


def test_lists_that_turn_out_long(spark, monkeypatch):
    """An n-gram twice in every batch is not among the frequent ones of the first pass; its list is split all the same."""
    monkeypatch.setattr(jaccard, "PART", 2)
    monkeypatch.setattr(jaccard, "PART_SHIFT", 60)
    made = []
    monkeypatch.setattr(jaccard, "Prefixes", lambda *a, own=jaccard.Prefixes: made.append(len(a[0])) or own(*a))
    own = [(i, f"a{i % 7} b{i} same words here") for i in range(40)]
    df = spark.createDataFrame(own, "doc_id long, text string").repartitionByRange(20, "doc_id")
    assert sorted(map(tuple, jaccard.near_duplicates(df, 1, 60, 100).collect()), key=repr) == brute(own, 1, 60, 100)
    assert made[0] == 0 and made[-1] > 0


def test_boundary():
    assert 0 <= jaccard.boundary({3: 100, 500: 10}, 80, 100) <= jaccard.MOST_SMALL
    assert jaccard.boundary({}, 80, 100) == 0


def test_representatives(spark):
    own = docs(spark)
    out = jaccard.representatives(own)
    assert out.schema == own.schema
    gone = {i for i, _, c in brute(rows(), 5, 80, 100) if i is not None and i != c}
    assert sorted((r.doc_id for r in out.collect()), key=repr) == sorted((r[0] for r in rows() if r[0] not in gone), key=repr)


def test_empty(spark):
    assert jaccard.near_duplicates(empty(spark)).collect() == []
    nulls = spark.createDataFrame([(None,) * 7, (1, None, *(None,) * 5), (2, "", *(None,) * 5)], SCHEMA)
    assert sorted(map(tuple, jaccard.near_duplicates(nulls).collect()), key=repr) == [(1, 0, 1), (2, 0, 2), (None, 0, None)]


@pytest.mark.parametrize("n", [9, 10_001])
def test_driver_data(spark, monkeypatch, n):
    """What the first pass sends to the driver depends neither on the number of buckets nor, but for its bounds, on the texts."""
    from walletgraph.llm.jaccard import _most_frequent, _pieces

    got = []
    monkeypatch.setattr(jaccard, "_pieces", lambda found: got.append(_pieces(found)) or got[-1])
    monkeypatch.setattr(jaccard, "_most_frequent", lambda found: got.append(_most_frequent(found)) or got[-1])
    monkeypatch.setattr(jaccard, "BATCH_LEAST", 1)
    own = docs(spark, 3).where("doc_id is not null")
    bits, keys, counts, sizes = jaccard._statistics(own, 2, 1 << 62, n)
    plain = collections.Counter(x for i, t, *_ in rows(3) if i is not None for x in shingles(t, 2))
    assert len(got[0]) <= 4096 and sorted(counts.tolist()) == sorted(c for c in plain.values() if c > 1) and sum(sizes.values()) == own.count()
    assert sum(int(x).bit_count() for x in bits) <= sum(c > 1 for c in plain.values())
    monkeypatch.setattr(jaccard, "FREQUENT", 10)
    few = jaccard._statistics(own, 2, 1 << 62, n)
    assert len(few[1]) <= 10 and (few[0] == bits).all() and set(few[2].tolist()) <= set(sorted(counts.tolist())[-10:])


def test_rows_of_a_batch(spark):
    """A batch sends a row for each part, however many buckets there are."""
    import numpy as np

    from walletgraph.llm import buckets

    keys = np.random.default_rng(1).integers(0, 1 << 62, 1 << 16, np.uint64)
    own = buckets.key_bucket(keys, 1_000_001)
    batch = buckets.nest(own, 33, keys=keys, other=None)
    again = buckets.nest_rows(list(buckets.deal(own, keys)), 33, buckets.pa.schema([("bucket", buckets.pa.int32()), ("keys", buckets.pa.binary())]))
    assert len(batch) == len(again) == 33 and len(np.unique(own)) > 60_000
    for b in (batch, again):
        found = {r["bucket"]: r["keys"] for row in b["cells"].to_pylist() for r in row}
        assert len(found) == len(np.unique(own)) and all(len(found[x]) == 8 * c for x, c in zip(*(v.tolist() for v in np.unique(own, return_counts=True)), strict=True))
        assert all(buckets.key_bucket(np.frombuffer(v, np.uint64), 1_000_001).tolist() == [k] * (len(v) // 8) for k, v in list(found.items())[:100])
