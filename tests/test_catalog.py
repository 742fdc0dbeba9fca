"""Every query with SQL is held against DuckDB on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from tests.conftest import DATA
from walletgraph import catalog


def _plain(rows, names):
    return sorted(map(repr, ([None if v is None else str(v) for v in row] for row in rows))), names


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_oracle(spark, duck, name):
    df = catalog.QUERIES[name](spark, DATA)
    names = sorted(df.columns)
    ours = [[r[c] for c in names] for r in df.collect()]
    ref = duck.execute(catalog.ORACLES[name])
    at = {d[0]: i for i, d in enumerate(ref.description)}
    assert sorted(at) == names
    theirs = [[r[at[c]] for c in names] for r in ref.fetchall()]
    assert len(ours) == len(theirs)
    assert len(ours) > 0
    for c, a, b in zip(names, zip(*ours, strict=True), zip(*theirs, strict=True), strict=True):
        assert {type(x) for x in a} - {type(None)} == {type(x) for x in b} - {type(None)}, c
    assert _plain(ours, names) == _plain(theirs, names)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_runs(spark, name):
    assert catalog.QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(catalog.QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_all_pairs(spark):
    """The graph queries over the whole table, against union-find: one giant component, by one task and by stars."""
    from tests.test_graph import brute
    from walletgraph import testbed
    from walletgraph.operators import clusters, graph

    rows = {(r.l_orderkey, r.l_partkey) for r in testbed.table(spark, DATA, "lineitem").collect()}
    orders = {}
    for tx, wallet in rows:
        orders.setdefault(tx, set()).add(wallet)
    expected = brute([(w, min(own)) for own in orders.values() for w in own])
    assert set(map(tuple, testbed.pairs(spark, DATA).collect())) == rows
    found = catalog.QUERIES["components_min_label"](spark, DATA).collect()
    assert len(found) == len(expected) and dict(map(tuple, found)) == expected
    stars = clusters.star_edges(testbed.pairs(spark, DATA))
    assert dict(map(tuple, graph.connected_components(stars, small=0).collect())) == expected
    largest = max(r.n_wallets for r in catalog.QUERIES["cluster_sizes"](spark, DATA).collect())
    assert largest == max(list(expected.values()).count(c) for c in set(expected.values())) > 0.9 * len(expected)
    edges = {(a, b) for own in orders.values() for a in own for b in own if a < b}
    assert set(map(tuple, catalog.QUERIES["spend_edges"](spark, DATA).collect())) == edges


def test_extended_keys(spark):
    """Children of all extended keys, against the plain derivation of each."""
    from walletgraph import testbed
    from walletgraph.functions import keys

    known = {r.address: keys.derive_or_none(r.address, 2) for r in testbed.extended_keys(spark, DATA).collect()}
    got = {}
    for r in catalog.QUERIES["xpub_children"](spark, DATA).collect():
        got.setdefault(r.key, {})[r.nth] = r.form
    assert {k: None if v == {None: None} else [v[i] for i in sorted(v)] for k, v in got.items()} == known
    assert None in known.values() and any(v and len(v) == 10 for v in known.values())


def test_ledger_run(spark):
    """The whole run over blocks: each node in one cluster, and all clusters' last balances are the unspent outputs."""
    import collections

    from walletgraph import testbed
    from walletgraph.operators import balances

    clusters = catalog.QUERIES["ledger_clusters"](spark, DATA).collect()
    assert len({r.root_hash for r in clusters}) == len(clusters) and {r.cluster_id for r in clusters} == set(range(len({r.cluster for r in clusters})))
    last = {}
    for r in sorted(catalog.QUERIES["ledger_balances"](spark, DATA).collect(), key=lambda r: r.miner_time):
        last[r.cluster] = r.balance
    unspent = balances.utxo_set(testbed.outputs(spark, DATA), testbed.inputs(spark, DATA), testbed.transactions(spark, DATA), 1 << 40).collect()
    assert sum(last.values()) == sum(r.value_sats for r in unspent)
    by_cluster = collections.Counter(r.cluster for r in clusters)
    assert set(by_cluster) <= set(last)
