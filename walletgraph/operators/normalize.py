"""From outputs and inputs to one root id for all address forms of a key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walletgraph.functions.keys import CHILDREN, derive_addresses
from walletgraph.functions.script import first_desc_key, keys_or_address, node_id, packed, revealed_key, root_hash_v1, unpacked
from walletgraph.shared import Table
from walletgraph.sources.tables import update_from

HASHED_TYPES = ("pubkey", "pubkeyhash", "multisig")
#: What a derived address is in the list of forms, by variant.
ROOT_KEY, ROOT_TUPLE = "key", "tuple"


def _blank(name: str):
    return F.nullif(F.col(name), F.lit(""))


def output_hashes(outputs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """A row for each key of an output, a NULL address where it has none; outputs that `known` has are left out."""
    rows = outputs.where(F.col("descriptor_type").isin(*HASHED_TYPES))
    if known is not None:
        rows = rows.join(known.select("txid", "vout_n"), ["txid", "vout_n"], "left_anti")
    return rows.select("txid", "vout_n", F.explode_outer(keys_or_address("address", "descriptor")).alias("address"), "descriptor_type")


def parse_pubkey_descriptors(outputs: DataFrame) -> DataFrame:
    """Outputs to a bare key get that key as their address, if they have none."""
    lacks = (F.col("descriptor_type") == "pubkey") & _blank("address").isNull()
    return outputs.withColumn("address", F.when(lacks, first_desc_key("descriptor")).otherwise(F.col("address")))


def key_for_descriptor(outputs: DataFrame) -> DataFrame:
    """Outputs with the first key alone in place of a descriptor that may have to give one, and NULL for the others: what reveals and parse_pubkey_descriptors() can use."""
    asked = (F.col("descriptor_type") == "pubkey") & _blank("address").isNull() | (F.col("descriptor_type") == "pubkeyhash")
    return outputs.withColumn("descriptor", F.when(asked, first_desc_key("descriptor")))


def unparsed_descriptors(outputs: DataFrame) -> DataFrame:
    """(txid, vout_n, descriptor) of outputs to a key, or to several, that have neither an address nor a descriptor with a key."""
    lacks = F.col("descriptor_type").isin("pubkey", "multisig") & _blank("address").isNull() & first_desc_key("descriptor").isNull()
    return outputs.where(lacks).select("txid", "vout_n", "descriptor")


def revealed_keys(outputs: DataFrame, inputs: DataFrame) -> DataFrame:
    """(txid, vout_n, revealed_key) of outputs to a key's hash whose spending script shows the key."""
    asked = outputs.where(F.col("descriptor_type") == "pubkeyhash").select("txid", "vout_n")
    spent = inputs.where("vin_txid is not null and (witness_data is not null or vin_asm is not null)")
    spent = spent.select(F.col("vin_txid").alias("txid"), F.col("vin_vout").alias("vout_n"), revealed_key("witness_data", "vin_asm").alias("revealed_key"))
    return spent.join(asked, ["txid", "vout_n"]).groupBy("txid", "vout_n").agg(F.min("revealed_key").alias("revealed_key"))


def apply_reveals(outputs: DataFrame, inputs: DataFrame) -> DataFrame:
    """Outputs whose key is revealed take it as their address and count as outputs to a key."""
    return update_from(outputs, revealed_keys(outputs, inputs), ["txid", "vout_n"], {"address": F.col("revealed_key"), "descriptor_type": F.lit("pubkey")})


def met_outputs(outputs: DataFrame, inputs: DataFrame) -> DataFrame:
    """(txid, vout_n, value_sats, key, bare, made, spender, ended) in one join of outpoints: of each output what apply_reveals() and parse_pubkey_descriptors()
    leave as its address, whether it is to a bare key then, its time, and the transaction that spends it with its time. Both tables have miner_time.

    key: the address as packed() has it, which it is in the exchanges too; where there is none, the outpoint after a byte 2."""
    own = key_for_descriptor(outputs).select("txid", "vout_n", "value_sats", "descriptor_type", packed("descriptor").alias("descriptor"), packed(_blank("address")).alias("address"), F.col("miner_time").alias("made"))
    shown = F.when(F.col("witness_data").isNotNull() | F.col("vin_asm").isNotNull(), packed(revealed_key("witness_data", "vin_asm")))
    spent = inputs.where("vin_txid is not null").select(F.col("vin_txid").alias("txid"), F.col("vin_vout").alias("vout_n"), shown.alias("shown"), F.struct(F.col("txid").alias("spender"), F.col("miner_time").alias("ended")).alias("by"))
    # Names are sorted to be grouped: exchanged first, they are sorted once.
    spent = spent.repartition("txid", "vout_n").groupBy("txid", "vout_n").agg(F.min("by").alias("by"), F.min(unpacked("shown")).alias("shown"))
    met = own.join(spent, ["txid", "vout_n"], "left").withColumn("shown", F.when(F.col("descriptor_type") == "pubkeyhash", F.col("shown")))
    told = met.withColumns({"descriptor": unpacked("descriptor"), "address": F.coalesce("shown", unpacked("address")), "descriptor_type": F.when(F.col("shown").isNotNull(), "pubkey").otherwise(F.col("descriptor_type"))})
    outpoint = F.concat(F.lit(b"\x02"), F.concat("txid", F.lit(":"), F.col("vout_n").cast("bigint").cast("string")).cast("binary"))
    bare = F.coalesce(F.col("descriptor_type") == "pubkey", F.lit(False))
    return parse_pubkey_descriptors(told).select("txid", "vout_n", "value_sats", F.coalesce(packed(_blank("address")), outpoint).alias("key"), bare.alias("bare"), "made", "by.spender", "by.ended")


def bare_keys(met: DataFrame) -> DataFrame:
    """(address) of met_outputs(): the keys that are to be derived."""
    return met.where(F.col("bare") & (F.substring("key", 1, 1) != F.lit(b"\x02"))).select(unpacked("key").alias("address"))


def wallet_numbers(met: DataFrame, normalized: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, wallet) of met_outputs(), and (wallet, name): wallets as numbers in no order. A wallet is the root of an address, else that address, else the output itself."""
    roots = normalized.select(packed("hash").alias("key"), "root_hash").repartition("key").groupBy("key").agg(F.min("root_hash").alias("root_hash"))
    named = Table(met.select("key").distinct().join(roots, "key", "left").select("key", F.coalesce("root_hash", unpacked("key")).alias("name")), "named", rebalance=False, compression="zstd")
    names = Table(named.df.select("name").distinct().select(F.monotonically_increasing_id().alias("wallet"), "name"), "names", rebalance=False, compression="zstd").df
    numbers = Table(named.df.join(names, "name").select("key", "wallet"), "numbers", rebalance=False, compression="zstd").df
    named.drop()
    return numbers, names


def unmapped_keys(outputs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Distinct keys that no hash is mapped for yet."""
    keys = outputs.where(F.col("descriptor_type") == "pubkey").select(_blank("address").alias("address")).where("address is not null").distinct()
    return keys if known is None else keys.join(known, keys["address"] == known["hash"], "left_anti")


def derived(keys: DataFrame, column: str = "address", n_child: int = CHILDREN) -> DataFrame:
    """(key, forms) of distinct keys, spread over all tasks for the costly part; forms is NULL for an unusable key.

    Each key is derived once: the forms are written before anything filters on them, as a filter would make the planner derive them again."""
    return Table(_underived(keys, column).withColumn("forms", derive_addresses(n_child)("key")), "forms", rebalance=False).df


def _underived(keys: DataFrame, column: str) -> DataFrame:
    """Distinct keys, dealt out in turn: dealt by key, they would stay where the aggregation put them, few small rows in one task."""
    spark = keys.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return keys.select(F.col(column).alias("key")).where("key is not null").distinct().repartition(tasks)


def unusable_keys(forms: DataFrame) -> DataFrame:
    return forms.where("forms is null").select("key")


def normalized_hashes(forms: DataFrame, root: str = ROOT_KEY) -> DataFrame:
    """(hash, root_hash), each pair once.

    key: the root is the uncompressed key, which also maps to itself. tuple: the older way, with four forms
    (no P2PKH of the compressed key) and as root a digest of them all; the first root of a hash, by key, wins.
    """
    good = forms.where("forms is not null")
    if root == ROOT_KEY:
        return good.select(F.explode("forms").alias("hash"), F.get("forms", F.lit(0)).alias("root_hash")).distinct()
    own = good.select("key", F.filter("forms", lambda x, i: i % 5 != 3).alias("forms"))
    rows = own.select("key", F.explode("forms").alias("hash"), root_hash_v1("forms").alias("root_hash"))
    return first_wins(rows, "hash", "root_hash", "key")


def first_wins(rows: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """Each key once, with the value that comes first in the order."""
    return rows.groupBy(key).agg(F.min_by(value, order).alias(value))


def one_root(hashes: DataFrame) -> DataFrame:
    """Each hash once, with its smallest root, so that joins do not multiply rows."""
    return hashes.groupBy("hash").agg(F.min("root_hash").alias("root_hash"))


def with_root(rows: DataFrame, normalized: DataFrame, *spread: str) -> DataFrame:
    """Rows with the root_hash of their address. Rows without an address, which may be very many, match nothing: their keys are dealt out by other columns."""
    none = F.concat(F.lit("\0"), F.xxhash64(*spread).cast("string"))
    own = rows.withColumn("__key", F.coalesce("address", none))
    return own.join(one_root(normalized).withColumnRenamed("hash", "__key"), "__key", "left").drop("__key")


def wallet_ids(inputs: DataFrame, hashes: DataFrame, normalized: DataFrame) -> DataFrame:
    """Inputs with vin_wallet_id: the root of the spent output's address, else that address."""
    address = hashes.groupBy("txid", "vout_n").agg(F.min(_blank("address")).alias("address"))
    spent = inputs.join(address.withColumnsRenamed({"txid": "vin_txid", "vout_n": "vin_vout"}), ["vin_txid", "vin_vout"], "left")
    return with_root(spent, normalized, "txid", "vin_txid", "vin_vout").select(*(c for c in inputs.columns if c != "vin_wallet_id"), F.coalesce("root_hash", "address").alias("vin_wallet_id"))


def input_nodes(inputs: DataFrame, outputs: DataFrame, normalized: DataFrame, edge_key: str = "spending") -> DataFrame:
    """Distinct (tx, node). spending: inputs of one transaction share tx; funding: outputs of one transaction do."""
    tx = {"spending": "txid", "funding": "vin_txid"}[edge_key]
    out = outputs.select(F.col("txid").alias("vin_txid"), F.col("vout_n").alias("vin_vout"), _blank("address").alias("address"))
    rows = inputs.where("vin_txid is not null").select(F.col(tx).alias("tx"), F.col("vin_txid"), "vin_vout").join(out, ["vin_txid", "vin_vout"])
    return with_root(rows, normalized, "vin_txid", "vin_vout").select("tx", node_id("root_hash", "address", "vin_txid", "vin_vout").alias("node")).distinct()


def match_inputs(inputs: DataFrame, outputs: DataFrame, extra: tuple[str, ...] = ("value_sats",)) -> DataFrame:
    """Each input with the output that it spends: (txid, spent_txid, vout_n, ...). An output is spent once at most."""
    spent = outputs.select(F.col("txid").alias("spent_txid"), "vout_n", *extra)
    on = (inputs["vin_txid"] == spent["spent_txid"]) & (inputs["vin_vout"] == spent["vout_n"])
    return inputs.select("txid", "vin_txid", "vin_vout").join(spent, on).select("txid", "spent_txid", "vout_n", *extra)


def missing_nodes(nodes: DataFrame, normalized: DataFrame) -> DataFrame:
    """(hash, root_hash) of nodes that don't map to themselves yet."""
    own = nodes.select(F.col("node").alias("hash"), F.col("node").alias("root_hash")).distinct()
    return own.join(normalized, ["hash", "root_hash"], "left_anti")


def trim(outputs: DataFrame, inputs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Outputs without descriptors of keys, and inputs without scripts where the spent output is to a key."""
    is_key = F.col("descriptor_type") == "pubkey"
    done = outputs.where(is_key).select(F.col("txid").alias("vin_txid"), F.col("vout_n").alias("vin_vout")).distinct()
    empty = F.lit(None).cast("string")
    lean = update_from(inputs, done, ["vin_txid", "vin_vout"], {c: empty for c in ("vin_asm", "witness_data") if c in inputs.columns})
    return outputs.withColumn("descriptor", F.when(is_key, empty).otherwise(F.col("descriptor"))), lean


def dictionary(df: DataFrame, column: str, name: str) -> DataFrame:
    """(column, name): dense ids from 0 in the order of the distinct values, without a window over all of them."""
    sorted_values = Table(df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column).withColumn("__at", F.monotonically_increasing_id()), "dictionary", rebalance=False).df
    part, nth = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = sorted_values.groupBy(part.alias("__part")).agg(F.count("*").alias("n")).orderBy("__part").collect()  # a row for each task
    starts, at = [], 0
    for row in counts:
        starts.append((row[0], at))
        at += row.n
    first = df.sparkSession.createDataFrame(starts, "__part long, __first long")
    return sorted_values.withColumn("__part", part).join(F.broadcast(first), "__part").select(column, (F.col("__first") + nth).alias(name))


def encode(df: DataFrame, ids: DataFrame, column: str, key: str, name: str) -> DataFrame:
    """df with the id of a column's value; NULL where the dictionary lacks it."""
    own = ids.select(F.col(key).alias(column), F.col(ids.columns[1]).alias(name))
    return df.join(own, column, "left")
