"""Walks over the graph of wallets that spend together, a level at a time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walletgraph.operators.adjacency import Adjacency
from walletgraph.shared import Table


def walk(pairs: DataFrame | Adjacency, seeds: DataFrame, hops: int | None = None, tx: str = "tx", wallet: str = "wallet") -> DataFrame:
    """(wallet, distance, via): wallets within `hops` transactions of the seeds (all that can be reached, if None).

    Breadth first: a level's wallets are written, their transactions not met before are found, then those transactions' wallets
    not met before. via is the smallest wallet a level before that shares a transaction; seeds have distance 0 and no via. Every
    transaction and every wallet is taken up once, so that all levels together move each pair twice, however large the
    graph is; a level is joined by broadcast where Spark finds its file small enough, else by an exchange.
    Seeds that no pair has are kept; null wallets and transactions link nothing.
    From stored lists a level reads only the buckets that its wallets and transactions are in."""
    if isinstance(pairs, Adjacency):
        transactions, wallets = pairs.transactions, pairs.wallets
        kind = pairs.lists(seeds.sparkSession, "wallet").schema["wallet"].dataType.simpleString()
    else:
        rows = pairs.select(F.col(tx).alias("tx"), F.col(wallet).alias("wallet")).where("tx is not null and wallet is not null")
        transactions, wallets = (lambda some: rows.join(some, "wallet")), (lambda some: rows.join(some, "tx"))
        kind = rows.schema["wallet"].dataType.simpleString()
    start = seeds.select(F.col(wallet).cast(kind).alias("wallet")).where("wallet is not null").distinct()
    levels = [Table(start.select("wallet", F.lit(0).alias("distance"), F.lit(None).cast(kind).alias("via")), "level")]
    met: list[Table] = []
    while hops is None or len(levels) <= hops:
        frontier = levels[-1].df.select("wallet")
        new = transactions(frontier).groupBy("tx").agg(F.min("wallet").alias("via"))
        if met:
            new = new.join(reduce(DataFrame.unionByName, (x.df.select("tx") for x in met)), "tx", "left_anti")
        met.append(Table(new, "met"))
        found = wallets(met[-1].df.select("tx")).join(met[-1].df, "tx").groupBy("wallet").agg(F.min("via").alias("via"))
        found = found.join(reduce(DataFrame.unionByName, (x.df.select("wallet") for x in levels)), "wallet", "left_anti")
        levels.append(Table(found.select("wallet", F.lit(len(levels)).alias("distance"), "via"), "level"))
        if levels[-1].df.isEmpty():
            break
    for x in met:
        x.drop()
    return reduce(DataFrame.unionByName, (x.df for x in levels))


def route(found: DataFrame, to: DataFrame, wallet: str = "wallet") -> DataFrame:
    """(goal, step, wallet): from each goal that a walk has reached back along via to a seed; step 0 is the goal.

    found is what walk() returned; as many joins as the farthest goal has hops."""
    at = Table(to.select(F.col(wallet).alias("wallet")).distinct().join(found, "wallet").select(F.col("wallet").alias("goal"), F.lit(0).alias("step"), "wallet", "via"), "route")
    steps = [at]
    while not steps[-1].df.where("via is not null").isEmpty():
        back = steps[-1].df.where("via is not null").select("goal", F.col("via").alias("wallet"))
        steps.append(Table(back.join(found, "wallet").select("goal", F.lit(len(steps)).alias("step"), "wallet", "via"), "route"))
    return reduce(DataFrame.unionByName, (x.df.select("goal", "step", "wallet") for x in steps))
