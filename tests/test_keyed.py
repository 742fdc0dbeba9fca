"""Tables by bucket, joins without an exchange, and holdings at many times."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from walletgraph.operators import balances as B
from walletgraph.operators import normalize as N
from walletgraph.sources import keyed, tables


def _files(path):
    return {p.relative_to(path).parts[0]: {x.name for x in p.parent.glob("*.parquet")} for p in Path(path).glob("*/*.parquet")}


def test_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    table = keyed.Keyed(str(tmp_path / "t"), ("k",), 32)
    rows = spark.range(2000).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    table.create(rows)
    before = _files(table.path)
    assert len(before) == 32
    new = spark.createDataFrame([(5, "new"), (5, "newer"), (3000, "more")], "k long, v string")
    n = table.upsert(new)
    after = _files(table.path)
    assert 1 <= n <= 2 and sum(before[b] != after[b] for b in before) == n
    assert sorted(map(tuple, table.read(spark).collect())) == sorted(map(tuple, tables.upsert(rows, new, ["k"]).collect()))
    assert table.upsert(new) == n and table.read(spark).count() == 2001  # run again, the same rows
    assert table.upsert(new.limit(0)) == 0 and _files(table.path).keys() == before.keys()


def test_update_insert_and_null_keys(spark, tmp_path):
    table = keyed.Keyed(str(tmp_path / "t"), ("a", "b"), 4)
    table.create(spark.createDataFrame([(1, None, "x"), (None, None, "y"), (2, "q", "z")], "a int, b string, v string"))
    table.insert_ignore(spark.createDataFrame([(None, None, "no"), (3, "q", "w"), (3, "q", "w")], "a int, b string, v string"))
    table.update_from(spark.createDataFrame([(2, "q", "up")], "a int, b string, w string"), {"v": F.col("w")})
    assert sorted(map(tuple, table.read(spark).collect()), key=repr) == sorted([(1, None, "x"), (None, None, "y"), (2, "q", "up"), (3, "q", "w")], key=repr)
    with pytest.raises(ValueError):
        keyed.Keyed(table.path, ("a", "b"), 8).read(spark)


def test_a_table_without_rows(spark, tmp_path):
    table = keyed.Keyed(str(tmp_path / "t"), ("k",), 4)
    table.create(spark.createDataFrame([], "k long, v string"))
    assert table.read(spark).count() == 0 and table.read(spark).columns == ["k", "v"]
    table.upsert(spark.createDataFrame([(k, "x") for k in range(20)], "k long, v string"))
    assert sorted(r.k for r in table.read(spark).collect()) == list(range(20))


def test_a_failed_change_leaves_the_table(spark, tmp_path):
    table = keyed.Keyed(str(tmp_path / "t"), ("k",), 4)
    table.create(spark.range(100).select(F.col("id").alias("k"), F.lit(1).alias("v")))
    before = _files(table.path)
    with pytest.raises(Exception, match="stop here"):
        table.rewrite(spark.range(100).select(F.col("id").alias("k")), lambda old, own: old.select("k", F.raise_error(F.lit("stop here")).cast("int").alias("v")))
    assert _files(table.path) == before


def test_outpoints_join_without_exchange(spark):
    outputs = spark.range(500).select((F.col("id") % 100).cast("string").alias("txid"), F.expr("CAST(id DIV 100 AS INT)").alias("vout_n"), F.col("id").alias("value_sats"))
    inputs = outputs.where("value_sats % 3 = 0").select(F.concat(F.lit("s"), "txid").alias("txid"), F.col("txid").alias("vin_txid"), F.col("vout_n").cast("long").alias("vin_vout"))
    inputs = inputs.unionByName(spark.createDataFrame([("c", None, None)], inputs.schema))
    outs, ins = keyed.outpoint_tables(outputs, inputs, 4)
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        local, plain = N.match_inputs(ins, outs), N.match_inputs(inputs, outputs)
        plans = [x._jdf.queryExecution().executedPlan().toString() for x in (local, plain)]
        assert "Exchange" not in plans[0] and "Exchange" in plans[1] and "SortMergeJoin" in plans[0]
        assert sorted(map(tuple, local.collect())) == sorted(map(tuple, plain.collect())) and local.count() == 167
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def test_buckets_divide_each_other():
    assert [keyed.buckets_for(n) for n in (0, 1, 4_000_000)] == [1, 1, 1]
    found = [keyed.buckets_for(10**k) for k in range(7, 13)]
    assert found == sorted(found) and all(b % a == 0 for a, b in zip(found, found[1:]))
    assert all(10**k / b < 2 * keyed.BUCKET_ROWS for k, b in zip(range(7, 13), found))


@pytest.mark.parametrize("seed", range(3))
def test_holdings_against_counting(spark, seed):
    """Times before, between, after and on the rows' own; times that repeat; spends before they are made."""
    r = random.Random(seed)
    lives = [(r.choice("abc"), r.randrange(100), made, r.choice([None, made, made - 3, made + r.randrange(1, 400)])) for made in (r.choice([7, r.randrange(1000)]) for _ in range(120))]
    at = [r.choice([-50, 3, 7, 8, 990, 5000, 10**9, r.randrange(1000), r.randrange(1000)]) for _ in range(15)]
    rows = spark.createDataFrame(lives, "wallet string, value_sats long, made long, ended long")
    times = spark.createDataFrame([(x,) for x in at] + [(None,)], "at long")
    whole, each = {}, {}
    for t in set(at):
        alive = [(w, v) for w, v, made, ended in lives if made <= t and (ended is None or ended > t)]
        whole[t] = (len(alive), sum(v for _, v in alive))
        for w in {w for w, _ in alive}:
            own = [v for x, v in alive if x == w]
            each[w, t] = (len(own), sum(own))
    got = B.holdings(rows, times).collect()
    assert {x.at: (x.n_unspent, x.unspent_sats) for x in got} == whole and len(got) == len(whole)
    got = B.holdings(rows, times, "wallet").collect()
    assert {(x.wallet, x.at): (x.n_unspent, x.unspent_sats) for x in got} == each and len(got) == len(each)


def test_holdings_of_nothing(spark):
    rows = spark.createDataFrame([], "wallet string, value_sats long, made long, ended long")
    times = spark.createDataFrame([(5,), (9,)], "at long")
    assert sorted(map(tuple, B.holdings(rows, times).collect())) == [(5, 0, 0), (9, 0, 0)]
    assert B.holdings(rows, times, "wallet").count() == 0
    one = spark.createDataFrame([("a", 1, 2, None)], rows.schema)
    assert B.holdings(one, times.limit(0)).count() == 0 and B.holdings(one, times.limit(0), "wallet").count() == 0


def test_lifetimes_join_spenders_once(spark):
    spends = spark.createDataFrame([("t", 0, 5, "w", "s"), ("t", 1, 6, "w", None), ("t", 2, 7, "w", "unknown")], "txid string, vout_n int, value_sats long, wallet string, spender string")
    times = spark.createDataFrame([("t", 10), ("s", 20)], "txid string, miner_time long")
    assert sorted((x.vout_n, x.made, x.ended) for x in B.lifetimes(spends, times).collect()) == [(0, 10, 20), (1, 10, None), (2, 10, None)]


def test_holdings_of_a_group_are_summed_by_slot(spark):
    """Lifetimes of a group hardly share their times: they are exchanged by slot and by group, not by their times before."""
    rows = spark.range(3000).select((F.col("id") % 40).cast("string").alias("wallet"), "id", F.col("id").alias("made"), (F.col("id") + F.col("id") % 900).alias("ended")).withColumnRenamed("id", "value_sats")
    times = spark.createDataFrame([(x,) for x in range(0, 4000, 500)], "at long")
    plan = B.holdings(rows, times, "wallet")._jdf.queryExecution().executedPlan().toString()
    by = [x.split("hashpartitioning(")[1].split(", REP")[0].split(", ENS")[0] for x in plan.split("\n") if "Exchange hashpartitioning(wallet" in x]
    assert len(by) == 2 and not any("made" in x or "time" in x for x in by)


def test_lifetimes_compare_transactions_as_they_are(spark):
    """Spenders meet their times as numbers, and outputs without a spender are dealt out; a spender of another kind still finds its time."""
    times = spark.createDataFrame([(1, 10), (2, 20)], "txid long, miner_time long")
    spends = spark.createDataFrame([(1, 0, 5, "w", 2), (1, 1, 6, "w", None)], "txid long, vout_n int, value_sats long, wallet string, spender long")
    found = B.lifetimes(spends, times)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "as string" not in plan and "__deal" in plan
    for kind in ("long", "int", "string"):
        got = B.lifetimes(spends.withColumn("spender", F.col("spender").cast(kind)), times)
        assert sorted((x.vout_n, x.made, x.ended) for x in got.collect()) == [(0, 10, 20), (1, 10, None)]
