"""What clusters receive, spend and hold, in satoshis."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from walletgraph.functions.script import node_id
from walletgraph.operators.normalize import dictionary
from walletgraph.shared import Table


def credits(outputs: DataFrame, times: DataFrame, clusters: DataFrame) -> DataFrame:
    """(cluster, txid, miner_time, delta): outputs by receiver. outputs has wallet; a wallet without a cluster is its own."""
    rows = outputs.join(times, "txid").join(clusters, "wallet", "left")
    return rows.select(F.coalesce("cluster", "wallet").alias("cluster"), "txid", "miner_time", F.col("value_sats").alias("delta"))


def debits(inputs: DataFrame, outputs: DataFrame, times: DataFrame, clusters: DataFrame) -> DataFrame:
    """The same for spent outputs: the spender's transaction and time, and a negative delta."""
    spent = outputs.select(F.col("txid").alias("vin_txid"), F.col("vout_n").alias("vin_vout"), "wallet", "value_sats")
    rows = inputs.where("vin_txid is not null").select("txid", "vin_txid", "vin_vout").join(spent, ["vin_txid", "vin_vout"])
    rows = rows.join(times, "txid").join(clusters, "wallet", "left")
    return rows.select(F.coalesce("cluster", "wallet").alias("cluster"), "txid", "miner_time", (-F.col("value_sats")).alias("delta"))


def spends(outputs: DataFrame, inputs: DataFrame) -> DataFrame:
    """(txid, vout_n, value_sats, wallet, spender): every output with its wallet and the transaction that spends it, if any. outputs has root_hash.

    The one join of outpoints that links of wallets, credits and debits all come from."""
    wallet = node_id("root_hash", "address", "txid", "vout_n")
    spent = inputs.where("vin_txid is not null").groupBy(F.col("vin_txid").alias("txid"), F.col("vin_vout").alias("vout_n")).agg(F.min("txid").alias("spender"))
    return outputs.select("txid", "vout_n", "value_sats", wallet.alias("wallet")).join(spent, ["txid", "vout_n"], "left")


def flows(spends: DataFrame, times: DataFrame, clusters: DataFrame) -> DataFrame:
    """(cluster, txid, miner_time, delta): credits and debits at once, with one join for clusters and one for times."""
    own = spends.join(clusters, "wallet", "left").withColumn("cluster", F.coalesce("cluster", "wallet"))
    paid = F.struct(F.col("txid"), F.col("value_sats").alias("delta"))
    drawn = F.when(F.col("spender").isNotNull(), F.struct(F.col("spender").alias("txid"), (-F.col("value_sats")).alias("delta")))
    both = own.select("cluster", F.explode(F.array_compact(F.array(paid, drawn))).alias("f")).select("cluster", "f.*")
    return both.join(times, "txid").select("cluster", "txid", "miner_time", "delta")


def timed_flows(spends: DataFrame, clusters: DataFrame, *keep: str) -> DataFrame:
    """The same from spends with made and ended, the times of both transactions, without a join for them: (cluster, delta) and of txid and miner_time those to keep."""
    names = {"txid": ("txid", "spender"), "miner_time": ("made", "ended")}
    paid = F.struct(*(F.col(names[x][0]).alias(x) for x in keep), F.col("value_sats").alias("delta"))
    drawn = F.struct(*(F.col(names[x][1]).alias(x) for x in keep), (-F.col("value_sats")).alias("delta"))
    used = [c for x in keep for c in names[x]]
    own = spends.select("wallet", "value_sats", *used, F.col("spender").isNotNull().alias("__spent")).join(clusters, "wallet", "left")
    both = F.array_compact(F.array(paid, F.when(F.col("__spent"), drawn)))
    return own.select(F.coalesce("cluster", "wallet").alias("cluster"), F.explode(both).alias("f")).select("cluster", "f.*")


def by_time(flows: DataFrame) -> DataFrame:
    return flows.groupBy("cluster", "miner_time").agg(F.sum("delta").alias("delta"))


def net_flows(flows: DataFrame) -> DataFrame:
    """Change by cluster and transaction: transfers within a cluster cancel out."""
    return flows.groupBy("cluster", "txid").agg(F.sum("delta").alias("delta"))


def balance_through_time(flows: DataFrame) -> DataFrame:
    """(cluster, miner_time, balance). A cluster's rows in the window are at most the blocks' times, whatever its traffic."""
    order = Window.partitionBy("cluster").orderBy("miner_time").rowsBetween(Window.unboundedPreceding, 0)
    return by_time(flows).select("cluster", "miner_time", F.sum("delta").over(order).alias("balance"))


def utxo_set(outputs: DataFrame, inputs: DataFrame, times: DataFrame, at: int) -> DataFrame:
    """Outputs made by then and not spent by then."""
    known = times.where(F.col("miner_time") <= at).select("txid")
    spent = inputs.join(known, "txid", "left_semi").where("vin_txid is not null").select(F.col("vin_txid").alias("txid"), F.col("vin_vout").alias("vout_n"))
    return outputs.join(known, "txid", "left_semi").join(spent, ["txid", "vout_n"], "left_anti")


def lifetimes(spends: DataFrame, times: DataFrame) -> DataFrame:
    """(txid, vout_n, wallet, value_sats, made, ended): from when to when an output is unspent; ended is NULL if it still is.

    A spender without a time counts as none. Outputs that nobody spends may be most: their keys are dealt out and match nothing."""
    made = times.select("txid", F.col("miner_time").alias("made"))
    ended = times.select(F.col("txid").alias("__spender"), F.xxhash64("txid").alias("__deal"), F.col("miner_time").alias("ended"))
    own = spends.withColumn("__spender", F.col("spender").cast(times.schema["txid"].dataType))
    own = own.withColumn("__deal", F.when(F.col("__spender").isNull(), F.xxhash64("txid", "vout_n")).otherwise(F.xxhash64("__spender")))
    return own.join(made, "txid").join(ended, ["__spender", "__deal"], "left").select("txid", "vout_n", "wallet", "value_sats", "made", "ended")


def first_at(rows: DataFrame, at: DataFrame, time: str, slot: str = "slot") -> DataFrame:
    """rows with the number of the first time in `at` (at, slot: dense ids in order) that isn't before `time`; rows after the last time go.

    An equi-join on stretches of time, as wide as the times lie apart on average: a stretch has the times within it and the first one after it.
    There are some stretches for each time, whatever the rows."""
    span = at.agg(F.min("at").alias("lo"), F.max("at").alias("hi"), F.count("*").alias("n")).first()
    if not span.n:
        return rows.limit(0).withColumn(slot, F.lit(None).cast("long"))
    width = max(1, -(-(span.hi - span.lo + 1) // span.n))
    stretch = lambda c: F.greatest(F.expr(f"(({c}) - {span.lo}) DIV {width}"), F.lit(0).cast("long"))
    within = at.groupBy(stretch("at").alias("__stretch")).agg(F.sort_array(F.collect_list(F.struct(F.col("at").cast("long").alias("at"), F.col(slot)))).alias("__within"))
    # The first time after a stretch is the one after its last; stretches without any take it from the last that has some.
    starts = at.select(stretch("at").alias("__stretch"), slot).groupBy("__stretch").agg(F.max(slot).alias("__last")).join(at.select((F.col(slot) - 1).alias("__last"), stretch("at").alias("__next")), "__last", "left")
    filled = starts.select(F.explode(F.sequence("__stretch", F.coalesce(F.col("__next") - 1, "__stretch"))).alias("__stretch"), (F.col("__last") + 1).alias("__after"), F.col("__next").isNotNull().alias("__more"))
    stretches = filled.join(within, "__stretch", "left")
    own = rows.withColumn("__stretch", stretch(time)).join(stretches, "__stretch")
    first = F.get("__within", F.lit(0))  # most stretches have one time: only the rest are searched
    here = F.when(first["at"] >= F.col(time), first[slot]).when(F.size("__within") > 1, F.get(F.filter("__within", lambda x: x["at"] >= F.col(time)), F.lit(0))[slot])
    return own.withColumn(slot, F.coalesce(here, F.when(F.col("__more"), F.col("__after")))).where(F.col(slot).isNotNull()).select(*rows.columns, slot)


def holdings(lifetimes: DataFrame, at: DataFrame, group: str | None = None) -> DataFrame:
    """(group, at, n_unspent, unspent_sats): what is unspent at each of many times (column at), in one pass over the lifetimes.

    An output is unspent from the transaction that makes it to the one that spends it, both as of their own times (made <= at < ended).
    It adds itself at the first time that it lives to see and takes itself away at the first that it doesn't, so work doesn't grow with the times
    that it lives through. Without a group lifetimes are summed by their two times before anything is ordered; a group's hardly share any, so that
    they are given their slots first and summed by these. A group has rows for the times
    at which it has unspent outputs; without a group there is one row for each time, zeros included. Repeated and null times count once or not at all."""
    keys = [group] if group else []
    times = Table(dictionary(at.select(F.col("at").cast("long").alias("at")), "at", "slot"), "times").df
    lives = lifetimes.where("made is not null and (ended is null or ended > made)")
    if group:
        sums = lives.select(group, "made", "ended", F.lit(1).cast("long").alias("n"), F.col("value_sats").cast("long").alias("sats"))
    else:
        sums = lives.groupBy("made", "ended").agg(F.count("*").alias("n"), F.sum("value_sats").alias("sats"))
    born = F.struct(F.col("made").cast("long").alias("time"), "n", "sats")
    gone = F.when(F.col("ended").isNotNull(), F.struct(F.col("ended").cast("long").alias("time"), (-F.col("n")).alias("n"), (-F.col("sats")).alias("sats")))
    events = sums.select(*keys, F.explode(F.array(born, gone)).alias("e")).select(*keys, "e.*").where("time is not null")
    if not group:
        events = events.groupBy("time").agg(F.sum("n").alias("n"), F.sum("sats").alias("sats"))
    changes = first_at(events, times, "time").groupBy(*keys, "slot").agg(F.sum("n").alias("n"), F.sum("sats").alias("sats"))
    order = Window.partitionBy(*keys).orderBy("slot")  # of a group one row for each time at most
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    end = F.coalesce(F.lead("slot").over(order), F.lit(times.count()).cast("long"))
    if not group:
        changes = changes.unionByName(times.select("slot", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("sats"))).groupBy("slot").agg(F.sum("n").alias("n"), F.sum("sats").alias("sats"))
    runs = changes.select(*keys, "slot", F.sum("n").over(upto).alias("n_unspent"), F.sum("sats").over(upto).alias("unspent_sats"), end.alias("__end"))
    if group:
        runs = runs.where("n_unspent > 0")
    spread = runs.select(*keys, F.explode(F.sequence("slot", F.col("__end") - 1)).alias("slot"), "n_unspent", "unspent_sats")
    return spread.join(times, "slot").select(*keys, "at", "n_unspent", "unspent_sats")
