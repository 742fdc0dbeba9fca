"""A ledger made from the star-schema test tables, and the same in SQL for the oracle.

Outputs are lines of orders (grouped, as (order, line number) is not unique), wallets are parts, and the next
order that touches a wallet spends the output.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from walletgraph.functions.keys import base58check

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', o_orderdate)")
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("txid"), seconds.alias("miner_time"))


def outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("txid"), F.col("l_linenumber").alias("vout_n"))
    return rows.agg(F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("value_sats"), F.min("l_partkey").alias("wallet"))


def spends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(txid, vin_txid, vin_vout, wallet): outputs that the next order of their wallet spends."""
    rows = outputs(spark, sf_dir).join(transactions(spark, sf_dir), "txid")
    order = Window.partitionBy("wallet").orderBy("miner_time", "txid", "vout_n")
    return rows.select(F.lead("txid").over(order).alias("txid"), F.col("txid").alias("vin_txid"), F.col("vout_n").alias("vin_vout"), "wallet").where("txid <> vin_txid")


def inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the spent output's wallet; a row with NULL vin_txid for each transaction that spends nothing."""
    spent = spends(spark, sf_dir)
    first = transactions(spark, sf_dir).select("txid").join(spent.select("txid").distinct(), "txid", "left_anti")
    return spent.unionByName(first, allowMissingColumns=True)


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wallets of each order: nearly all wallets are one component."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("tx"), F.col("l_partkey").alias("wallet")).distinct()


def _paid(w: Column) -> list[Column]:
    """Descriptor, address and kind of an output to wallet w."""
    kind = F.when(w % 7 == 0, "pubkey").when(w % 3 == 0, "pubkeyhash").otherwise("witness_v0_keyhash")
    key = F.sha2(w.cast("string"), 256)
    return [F.concat(F.lit("pk(02"), key, F.lit(")#qwerty12")).alias("descriptor"), F.when(w % 5 == 0, "").otherwise(F.concat(F.lit("P"), w.cast("string"))).alias("address"), kind.alias("descriptor_type")]


def _shown(v: Column, w: Column) -> list[Column]:
    """Script and witness of an input that spends an output of transaction v to wallet w."""
    key = F.concat(F.lit("02"), F.sha2(w.cast("string"), 256))
    return [F.when(v % 3 == 1, F.concat(F.lit("3044 "), key)).alias("vin_asm"), F.when(v % 3 == 0, F.concat(F.lit("3045, "), key)).alias("witness_data")]


def addresses(outs: DataFrame) -> DataFrame:
    """Outputs with the columns of the ledger: every fifth wallet blank, every seventh to a bare key, every third to a key's hash."""
    return outs.select("txid", "vout_n", "value_sats", *_paid(F.col("wallet")))


def scripts(ins: DataFrame) -> DataFrame:
    """Inputs with the columns of the ledger: a key shown in a witness, in a script, or not at all."""
    return ins.select("txid", "vin_txid", "vin_vout", *_shown(F.col("vin_txid"), F.col("wallet")))


def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(hash, root_hash): two of four wallets share a root."""
    p = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").where(p % 4 < 2)
    return rows.select(F.concat(F.lit("P"), p.cast("string")).alias("hash"), F.concat(F.lit("R"), (p / 4).cast("bigint").cast("string")).alias("root_hash"))


def blocks(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """(value): blocks as a node writes them in JSON, eight orders' keys to a block, at its first order's time; in so many parts, in no order, if that is given.

    Only numbers are exchanged: lines, orders and spends meet once, by height, and all the rest of a block happens where it is;
    the long strings of scripts are made once a block is together."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("txid"), F.col("l_linenumber").alias("n"), F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("x"), F.col("l_partkey").alias("wallet"))
    txs = transactions(spark, sf_dir).select("txid", F.lit(None).cast("int").alias("n"), F.col("miner_time").alias("x"), F.lit(None).cast("bigint").alias("wallet"))
    spent = spends(spark, sf_dir).select("txid", F.col("vin_vout").alias("n"), F.col("vin_txid").alias("x"), "wallet")
    kinds = [df.withColumn("kind", F.lit(k).cast("byte")) for k, df in enumerate((lines, txs, spent))]  # n and x: line number and price; none and time; spent line and order
    # Lines of one number are one output; an order's other rows pass that step one by one.
    rows = kinds[0].unionByName(kinds[1]).unionByName(kinds[2]).select(F.expr("txid DIV 8").alias("height"), "*", F.when(F.col("kind") > 0, F.monotonically_increasing_id()).alias("own"))
    rows = rows.repartition(parts, "height") if parts else rows.repartition("height")
    rows = rows.groupBy("height", "txid", "kind", "n", "own").agg(F.sum("x").alias("x"), F.min("wallet").alias("wallet"))
    of = lambda kind, **c: F.collect_list(F.when(F.col("kind") == kind, F.struct(*(F.col(x).alias(name) for name, x in c.items()))))
    parts_of = of(1, miner_time="x").alias("made"), of(0, vout_n="n", value_sats="x", wallet="wallet").alias("outs"), of(2, vin_txid="x", vin_vout="n", wallet="wallet").alias("ins")
    none = F.array(F.struct(F.lit(None).cast("bigint").alias("vin_txid"), F.lit(None).cast("int").alias("vin_vout"), F.lit(None).cast("bigint").alias("wallet")))
    ins, outs = F.when(F.size("ins") > 0, F.col("ins")).otherwise(none), F.when(F.size("outs") > 0, F.col("outs"))
    txs = rows.groupBy("height", "txid").agg(*parts_of).select("height", "txid", F.explode("made").alias("made"), ins.alias("ins"), outs.alias("outs"))
    rows = txs.groupBy("height").agg(F.min("made.miner_time").alias("time"), F.collect_list(F.struct("txid", "ins", "outs")).alias("txs"))

    def vout(o: Column) -> Column:
        desc, address, kind = _paid(o["wallet"])
        value = (o["value_sats"].cast("decimal(24,0)") / 100_000_000).cast("decimal(16,8)")
        return F.struct(value.alias("value"), o["vout_n"].alias("n"), F.struct(desc.alias("desc"), F.nullif(address, F.lit("")).alias("address"), kind.alias("type")).alias("scriptPubKey"))

    def vin(i: Column) -> Column:
        asm, witness = _shown(i["vin_txid"], i["wallet"])
        script = F.when(asm.isNotNull(), F.struct(asm.alias("asm")))
        return F.struct(i["vin_txid"].cast("string").alias("txid"), i["vin_vout"].alias("vout"), script.alias("scriptSig"), F.split(witness, ", ").alias("txinwitness"))

    tx = F.transform("txs", lambda t: F.struct(t["txid"].cast("string").alias("txid"), F.lit(0).alias("locktime"), F.transform(t["ins"], vin).alias("vin"), F.transform(t["outs"], vout).alias("vout")))
    return rows.select(F.to_json(F.struct("height", F.concat(F.lit("h"), F.col("height").cast("string")).alias("hash"), (F.col("time") - 600).alias("mediantime"), "time", tx.alias("tx"))).alias("value"))


def extended_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An extended public key for each part; every second one is no point of the curve."""

    @F.pandas_udf("string")
    def encode(chains: pd.Series, keys: pd.Series) -> pd.Series:
        return pd.Series([base58check(bytes.fromhex("0488b21e010000000000000000" + c + "02" + k)) for c, k in zip(chains, keys, strict=True)], dtype=object)

    p = F.col("p_partkey").cast("string")
    return table(spark, sf_dir, "part").select(encode(F.sha2(F.concat(F.lit("chain"), p), 256), F.sha2(p, 256)).alias("address"))


def forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, forms) as derivation gives them, from digests rather than curve points: every seventh key unusable, two keys to a first and a third form."""
    p = F.col("p_partkey")
    form = lambda letter, by: F.sha2(F.concat(F.lit(letter), F.expr(f"p_partkey DIV {by}").cast("string")), 256)
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    own = F.when(p % 7 != 0, F.array(form("a", 2), form("b", 1), form("c", 2), form("d", 1), form("e", 1)))
    rows = table(spark, sf_dir, "part").select("p_partkey").repartition(tasks)  # a row of 8 bytes becomes 700: one split of the file would be too much for a task
    return rows.select(F.lpad(p.cast("string"), 12, "0").alias("key"), own.alias("forms"))


SQL = {
    "txs": "txs AS (SELECT o_orderkey AS txid, CAST(epoch(o_orderdate) AS BIGINT) AS miner_time FROM orders)",
    "outs": "outs AS (SELECT l_orderkey AS txid, l_linenumber AS vout_n, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS value_sats, min(l_partkey) AS wallet FROM lineitem GROUP BY ALL)",
    "spends": "spends AS (SELECT * FROM (SELECT lead(txid) OVER (PARTITION BY wallet ORDER BY miner_time, txid, vout_n) AS txid, txid AS vin_txid, vout_n AS vin_vout, wallet FROM outs JOIN txs USING (txid)) WHERE txid <> vin_txid)",
    "ins": "ins AS (SELECT * FROM spends UNION ALL SELECT txid, NULL, NULL, NULL FROM txs WHERE txid NOT IN (SELECT txid FROM spends))",
    "pairs": "pairs AS (SELECT DISTINCT l_orderkey AS tx, l_partkey AS wallet FROM lineitem)",
    "star": "star AS (SELECT DISTINCT wallet AS a, m AS b FROM pairs JOIN (SELECT tx, min(wallet) AS m FROM pairs GROUP BY tx) USING (tx))",
    # One label a node: the smallest met so far. Without a key the recursion would keep all labels that reach a node, quadratic in the giant component.
    "reach": "reach(node, c) USING KEY (node) AS (SELECT DISTINCT wallet, wallet FROM pairs UNION SELECT e.b, min(r.c) FROM reach r JOIN (SELECT a, b FROM star UNION SELECT b, a FROM star) e ON r.node = e.a JOIN recurring.reach x ON x.node = e.b WHERE r.c < x.c GROUP BY e.b)",
    "comps": "comps AS (SELECT node AS wallet, min(c) AS component FROM reach GROUP BY node)",
    "keyed": "keyed AS (SELECT txid, vout_n, value_sats, 'pk(02' || sha256(CAST(wallet AS VARCHAR)) || ')#qwerty12' AS descriptor, CASE WHEN wallet % 5 = 0 THEN '' ELSE 'P' || wallet END AS address, CASE WHEN wallet % 7 = 0 THEN 'pubkey' WHEN wallet % 3 = 0 THEN 'pubkeyhash' ELSE 'witness_v0_keyhash' END AS descriptor_type FROM outs)",
    "shown": "shown AS (SELECT txid, vin_txid, vin_vout, CASE WHEN vin_txid % 3 = 1 THEN '3044 02' || sha256(CAST(wallet AS VARCHAR)) END AS vin_asm, CASE WHEN vin_txid % 3 = 0 THEN '3045, 02' || sha256(CAST(wallet AS VARCHAR)) END AS witness_data FROM ins)",
    "norm": "norm AS (SELECT 'P' || p_partkey AS hash, 'R' || (p_partkey // 4) AS root_hash FROM part WHERE p_partkey % 4 < 2)",
    "flows": "flows AS (SELECT coalesce(component, wallet) AS cluster, txid, miner_time, delta FROM (SELECT wallet, txid, value_sats AS delta FROM outs UNION ALL SELECT o.wallet, i.txid, -o.value_sats FROM spends i JOIN outs o ON o.txid = i.vin_txid AND o.vout_n = i.vin_vout) JOIN txs USING (txid) LEFT JOIN comps USING (wallet))",
}

_NEEDS = {"spends": ["txs", "outs"], "ins": ["spends"], "star": ["pairs"], "reach": ["star"], "comps": ["reach"], "keyed": ["outs"], "shown": ["ins"], "flows": ["spends", "comps"]}


def sql(body: str, *names: str) -> str:
    """The body with the common table expressions that it names."""
    order: list[str] = []

    def need(name: str) -> None:
        for x in _NEEDS.get(name, []):
            need(x)
        if name not in order:
            order.append(name)

    for name in names:
        need(name)
    return f"WITH RECURSIVE {', '.join(SQL[n] for n in order)} {body}" if order else body
