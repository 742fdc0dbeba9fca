import random

import numpy as np
import pytest

from walletgraph.operators import clusters as C
from walletgraph.operators.graph import _forest, connected_components, contract, union_find
from walletgraph.operators.normalize import dictionary
from walletgraph.operators import adjacency
from walletgraph.operators.walk import route, walk

CASES = {
    "single": ([(1, 2), (1, 3), (1, 4)], [(2, 0), (3, 0), (4, 0)]),
    "multiple": ([(1, 2), (1, 3), (2, 5), (2, 6), (10, 9), (10, 8)], [(2, 0), (3, 0), (5, 1), (6, 1), (8, 2), (9, 2)]),
    "disconnected": ([(1, 2), (2, 3), (3, 4), (4, 5)], [(2, 0), (3, 1), (4, 2), (5, 3)]),
    "chain": ([(1, 2), (1, 3), (2, 3), (2, 4), (3, 5), (5, 3), (5, 10)], [(2, 0), (3, 0), (4, 0), (5, 1), (10, 0)]),
    "repeated": ([(1, 2), (1, 3), (1, 2), (1, 3), (1, 4)], [(2, 0), (3, 0), (4, 0)]),
    "empty": ([], []),
}


def brute(edges):
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {x: find(x) for x in root}


def graphs():
    rng = random.Random(1)
    yield "path", [(i, i + 1) for i in range(60)]
    yield "star", [(0, i) for i in range(1, 40)]
    yield "clique", [(i, j) for i in range(12) for j in range(i)]
    yield "hubs", [(100, i) for i in range(30)] + [(200, i) for i in range(29, 60)]
    yield "singletons", [(i, i) for i in range(10)]
    for n in (30, 80):
        yield f"random{n}", [(rng.randrange(n), rng.randrange(n)) for _ in range(n * 2 // 3)]


@pytest.mark.parametrize("name", CASES)
def test_cases(spark, name):
    rows, expected = CASES[name]
    found = C.cluster(spark.createDataFrame(rows, "tx long, wallet long"))
    assert sorted(map(tuple, found.collect())) == expected


@pytest.mark.parametrize("name,edges", list(graphs()))
def test_components(spark, name, edges):
    expected = brute(edges)
    df = spark.createDataFrame([*edges, *(e[::-1] for e in edges[:3])], "a long, b long")
    assert {r.node: r.component for r in connected_components(df).collect()} == expected
    if name in ("path", "hubs", "random80"):
        assert {r.node: r.component for r in connected_components(df, small=0).collect()} == expected
    nodes, roots = union_find(*map(np.array, zip(*edges, strict=True)))
    assert dict(zip(nodes.tolist(), roots.tolist(), strict=True)) == expected


def test_strings_and_nulls(spark):
    df = spark.createDataFrame([("b", "a"), ("c", "b"), (None, "x"), ("d", None), ("e", "e")], "a string, b string")
    for small in (10, 0):
        assert {r.node: r.component for r in connected_components(df, small=small).collect()} == {"a": "a", "b": "a", "c": "a", "e": "e"}


def test_dictionary(spark):
    df = spark.createDataFrame([(x,) for x in [5, 3, 3, None, 9, -1]], "v long").repartition(4)
    assert sorted(map(tuple, dictionary(df, "v", "id").collect())) == [(-1, 0), (3, 1), (5, 2), (9, 3)]


def test_match_rows(spark):
    rows = [("key1", "c_key1", "legacy1", "segwit1"), ("key2", "c_key2", "legacy2", None), (None, None, "legacy1", "segwit1"), ("key3", "c_key3", "legacy3", "segwit3"), (None, None, "legacy3", "segwit3"), (None, None, "legacy3", "segwit3"), ("key3", "c_key3", "legacy3", "segwit3"), ("key4", None, "legacy4", "segwit4"), ("key4", None, None, "segwit4")]
    known = {1: ("key1", "c_key1", "legacy1", "segwit1", 0), 2: ("key2", "c_key2", "legacy2", None, 2), 3: ("key3", "c_key3", "legacy3", "segwit3", 1), 4: ("key4", None, "legacy4", "segwit4", 3)}
    names = ["Uncompressed_Public_Key", "Compressed_Public_Key", "Legacy_Address", "Segwit_Address"]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "n int, " + ", ".join(f"{c} string" for c in names))
    out = C.match_rows(df, names, "n").orderBy("n").collect()
    assert [tuple(r)[1:] for r in out] == [known[k] for k in (1, 2, 1, 3, 3, 3, 3, 4, 4)]


def test_edges_and_neighbors(spark):
    pairs = spark.createDataFrame([(1, 2), (1, 3), (2, 3), (2, 4), (9, 7)], "tx long, wallet long")
    assert sorted(map(tuple, C.spend_edges(pairs).collect())) == [(2, 3), (3, 4)]
    assert sorted(r.wallet for r in C.neighbors(pairs, 3).collect()) == [2, 4]
    assert dict(map(tuple, C.one_hop_label(pairs).collect())) == {2: 2, 3: 2, 4: 3, 7: 7}
    found = C.components(pairs)
    assert sorted((r.component, r.part, r.members) for r in C.members(found, size=2).collect()) == [(2, 0, [2, 3]), (2, 1, [4]), (7, 0, [7])]
    assert sorted(map(tuple, C.positions(found).collect())) == [(2, 0, 2), (2, 1, 3), (2, 2, 4), (7, 0, 7)]


@pytest.mark.parametrize("name,edges", [g for g in graphs() if g[0] in ("path", "hubs", "random80")])
def test_contraction(spark, name, edges):
    """Forests of any size, merged or left to the stars, give the same components."""
    expected = brute(edges)
    df = spark.createDataFrame(edges, "a long, b long").repartition(6)
    for small in (1, 3, 7, 30, 1000):
        assert {r.node: r.component for r in connected_components(df, small=small).collect()} == expected, small
        forest, whole = contract(df, small)
        rows = [tuple(r) for r in forest.df.select("a", "b").collect()]
        assert brute(rows) == expected and (not whole or dict(rows) == expected)
        assert whole or small < 1000


def test_contraction_exchanges_less(spark):
    """What is left of each task's edges is a node's star at most, before anything is exchanged."""
    rng = random.Random(4)
    edges = [(rng.randrange(500), rng.randrange(500)) for _ in range(40_000)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(4)
    assert _forest(df, 1 << 20).count() <= 4 * 500 < len(edges) // 10
    forest, whole = contract(df)
    assert whole and forest.df.count() == 500


def plain_walk(rows, seeds, hops):
    found, level = {s: (0, None) for s in seeds}, set(seeds)
    near = {}
    for tx, w in rows:
        near.setdefault(tx, set()).add(w)
    while level and (hops is None or max(d for d, _ in found.values()) < hops):
        new = {}
        for own in near.values():
            via = own & level
            for w in own - found.keys() if via else ():
                new[w] = min(min(via), new.get(w, min(via)))
        found |= {w: (max(d for d, _ in found.values()) + 1, v) for w, v in new.items()}
        level = set(new)
    return found


@pytest.mark.parametrize("stored", [False, True])
@pytest.mark.parametrize("hops", [0, 1, 3, None])
def test_walk(spark, hops, stored, tmp_path):
    rng = random.Random(9)
    rows = [(t, w) for t in range(120) for w in {t, t + 1, rng.randrange(300)}] + [(500, 900), (500, 901), (501, 5), (501, 5)]
    pairs = spark.createDataFrame([*rows, (None, 5), (7, None)], "tx long, wallet long").repartition(3)
    seeds = spark.createDataFrame([(3,), (3,), (118,), (9999,), (None,)], "wallet long")
    found = walk(adjacency.build(pairs, str(tmp_path / "lists"), 4, size=2) if stored else pairs, seeds, hops)
    got = {r.wallet: (r.distance, r.via) for r in found.collect()}
    assert got == plain_walk(rows, [3, 118, 9999], hops) and found.count() == len(got)
    if hops is None:
        assert 901 not in got and max(d for d, _ in got.values()) > 4
        goals = sorted(got, key=got.get)[-3:]
        steps = {}
        for r in route(found, spark.createDataFrame([(g,) for g in goals], "wallet long")).collect():
            steps.setdefault(r.goal, {})[r.step] = r.wallet
        txs = {}
        for t, w in rows:
            txs.setdefault(w, set()).add(t)
        assert set(steps) == set(goals)
        for g, own in steps.items():
            path = [own[i] for i in range(len(own))]
            assert path[0] == g and path[-1] in (3, 118) and len(path) == got[g][0] + 1 and all(txs[x] & txs[y] for x, y in zip(path, path[1:]))


def test_walk_of_nothing(spark):
    none = spark.createDataFrame([], "tx long, wallet string")
    assert walk(none, none).count() == 0
    assert [tuple(r) for r in walk(none, spark.createDataFrame([("a",)], "wallet string")).collect()] == [("a", 0, None)]


def test_stored_lists(spark, tmp_path):
    """A hub's list in parts and order, null and repeated pairs, keys that are not there, and only touched buckets read."""
    rows = [(t, 0) for t in range(50)] + [(t, 1 + t % 20) for t in range(50)] + [(3, 99), (3, 99)]
    pairs = spark.createDataFrame([*rows, (None, 5), (7, None)], "block long, owner long").repartition(4)
    built = adjacency.build(pairs, str(tmp_path / "lists"), 8, "block", "owner", size=7)
    hub = sorted((r.part, r.members) for r in built.lists(spark, "wallet").where("wallet = 0").collect())
    assert [x for _, part in hub for x in part] == list(range(50)) and [p for p, _ in hub] == list(range(8)) and max(len(x) for _, x in hub) == 7
    again = adjacency.Adjacency(built.path, 8)
    assert {r.wallet: r.n for r in again.degrees(spark, "wallet").collect()} == {w: len({t for t, x in rows if x == w}) for _, w in rows}
    some = spark.createDataFrame([(99,), (1,), (1,), (None,), (12345,)], "wallet int")
    want = {(w, y) for w in (99, 1) for t, x in rows if x == w for u, y in rows if u == t and y != w}
    got = [tuple(r) for r in again.neighbors(some).collect()]
    assert set(got) == want and len(got) == len(want)
    assert again.neighbors(some.limit(0)).count() == 0
    assert sorted(map(tuple, again.transactions(some).collect())) == sorted({(w, t) for t, w in rows if w in (99, 1)})
    one = again.of(spark.createDataFrame([(99,)], "wallet long"), "wallet")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "bucket_of_8" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "PushedFilters: [" in plan and "wallet" in plan.split("PushedFilters: [")[1].split("]")[0]
    assert one.select(adjacency.F.input_file_name()).distinct().count() == 1


def test_many_keys_are_joined(spark, tmp_path):
    pairs = spark.range(3000).select((adjacency.F.col("id") % 1000).alias("tx"), adjacency.F.col("id").alias("wallet"))
    built = adjacency.build(pairs, str(tmp_path / "lists"), 4)
    some = spark.range(1, 3000, 3).select(adjacency.F.col("id").alias("wallet"))
    assert some.count() > adjacency.FEW and sorted(map(tuple, built.transactions(some).collect())) == [(w, w % 1000) for w in range(1, 3000, 3)]


def test_stored_lists_of_nothing(spark, tmp_path):
    none = spark.createDataFrame([], "tx long, wallet string")
    built = adjacency.build(none, str(tmp_path / "lists"), 4)
    assert [tuple(r) for r in walk(built, spark.createDataFrame([("a",)], "wallet string")).collect()] == [("a", 0, None)]
    assert built.degrees(spark, "tx").count() == 0


def test_rounds_move_few_edges(spark, monkeypatch):
    """Each round has the edges between the roots of the last one only, so the first round writes most of what all rounds do."""
    from walletgraph.operators import graph
    from walletgraph.shared import Table

    rng, rows = random.Random(11), []

    class Counted(Table):
        def __init__(self, df, name, *a, **k):
            super().__init__(df, name, *a, **k)
            if name in ("edges", "stars", "large"):
                rows.append(self.df.count())

    monkeypatch.setattr(graph, "Table", Counted)
    edges = [(rng.randrange(3000), rng.randrange(3000)) for _ in range(20000)]
    found = {r.node: r.component for r in graph.connected_components(spark.createDataFrame(edges, "a long, b long"), small=0).collect()}
    assert found == brute(edges)
    assert sum(rows) < 1.5 * len(edges)


def test_rounds_of_joins_on_paths_and_stars(spark):
    """Paths in and out of order, a star whose centre is largest, a comb of both, and nodes alone: all by joins."""
    rng = random.Random(4)
    order = rng.sample(range(1000, 1200), 200)
    edges = [(i, i + 1) for i in range(0, 150)] + list(zip(order, order[1:])) + [(2999, i) for i in range(2000, 2050)]
    edges += [(3000 + i, 3100 + i) for i in range(50)] + [(3100 + i, 3001 + i) for i in range(49)] + [(5000, 5000)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long"), small=0).collect()}
    assert found == brute(edges)


def test_only_large_lists_are_put_in_order(spark, monkeypatch):
    """Lists that fit a row are gathered as they are: nothing of them is sorted by range; larger ones are cut as before."""
    placed, real = [], C.positions
    monkeypatch.setattr(C, "positions", lambda rows, *a, **k: placed.append(rows) or real(rows, *a, **k))
    rows = [(g, w) for g in range(20) for w in range(g % 4 + 1)] + [(3, 0), (None, 5)]
    df = spark.createDataFrame(rows, "component long, wallet long")
    small = {(r.component, r.part): r.members for r in C.members(df, size=4).collect()}
    assert small == {(g, 0): list(range(g % 4 + 1)) for g in range(20)} and not placed
    cut = {(r.component, r.part): r.members for r in C.members(df, size=3).collect()}
    assert cut == {(g, p): list(range(g % 4 + 1))[3 * p : 3 * p + 3] for g in range(20) for p in range(g % 4 // 3 + 1)}
    assert {r.g for r in placed[0].select("g").collect()} == {3, 7, 11, 15, 19}
