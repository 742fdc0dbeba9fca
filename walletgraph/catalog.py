"""Registered queries over whole test tables, and the SQL that they are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from walletgraph import schema
from walletgraph import testbed as T
from walletgraph.functions import keys as K
from walletgraph.functions import registry
from walletgraph.functions import script as S
from walletgraph.operators import balances as B
from walletgraph.operators import clusters as C
from walletgraph.operators import normalize as N
from walletgraph.operators import adjacency, walk
from walletgraph.plans import pipeline
from walletgraph.shared import Table, drop_path, new_path, tidy
from walletgraph.sources import blocks, keyed, tables
from walletgraph.sources.counters import Counters
from walletgraph.streaming import incremental

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None, *ctes: str):
    """Registers a query, with its SQL where SQL can express it."""

    def register(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = T.sql(oracle, *ctes)
        return f

    return register


# The ledger's tables.


@query("SELECT txid, miner_time FROM txs", "txs")
def tx_times(spark, d):
    return T.transactions(spark, d)


@query("SELECT * FROM outs", "outs")
def outputs_table(spark, d):
    return T.outputs(spark, d)


@query("SELECT * FROM ins", "ins")
def inputs_table(spark, d):
    return T.inputs(spark, d)


@query("SELECT o_orderkey AS height, (o_orderkey - 0) // 800 AS chunk FROM orders")
def height_chunks(spark, d):
    heights = T.table(spark, d, "orders").select(F.col("o_orderkey").alias("height"))
    top = heights.agg(F.max("height")).first()[0] or 0
    return heights.join(blocks.chunks(spark, 0, top), "height").select("height", "chunk")


@query("SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS tx_id, o_orderkey AS txid FROM orders")
def txid_dictionary(spark, d):
    return N.dictionary(T.transactions(spark, d), "txid", "tx_id")


@query("SELECT i.txid, d.n AS vin_tx_id, i.vin_vout FROM ins i LEFT JOIN (SELECT txid, row_number() OVER (ORDER BY txid) - 1 AS n FROM txs) d ON d.txid = i.vin_txid", "ins")
def encoded_inputs(spark, d):
    ids = N.dictionary(T.transactions(spark, d), "txid", "tx_id")
    return N.encode(T.inputs(spark, d), ids, "vin_txid", "txid", "vin_tx_id").select("txid", "vin_tx_id", "vin_vout")


# Filters.


@query("SELECT txid, vout_n, descriptor_type FROM keyed WHERE descriptor_type IN ('pubkey', 'pubkeyhash', 'multisig')", "keyed")
def descriptor_filter(spark, d):
    return T.addresses(T.outputs(spark, d)).where(F.col("descriptor_type").isin(*N.HASHED_TYPES)).select("txid", "vout_n", "descriptor_type")


@query("SELECT txid, vout_n FROM keyed WHERE descriptor_type = 'pubkey' AND (address IS NULL OR address = '')", "keyed")
def blank_address_filter(spark, d):
    return T.addresses(T.outputs(spark, d)).where((F.col("descriptor_type") == "pubkey") & F.nullif("address", F.lit("")).isNull()).select("txid", "vout_n")


@query("SELECT txid, vin_txid, vin_vout FROM ins WHERE vin_txid IS NOT NULL", "ins")
def coinbase_filter(spark, d):
    return T.inputs(spark, d).where("vin_txid is not null").select("txid", "vin_txid", "vin_vout")


@query("SELECT DISTINCT address FROM keyed WHERE descriptor_type = 'pubkey'", "keyed")
def distinct_pubkeys(spark, d):
    return T.addresses(T.outputs(spark, d)).where("descriptor_type = 'pubkey'").select("address").distinct()


# Script and descriptor functions.

_KEY = "sha256(CAST(p_partkey AS VARCHAR))"
# What each form holds, by hand.
_KEYS = f"CASE p_partkey % 6 WHEN 1 THEN ['02' || {_KEY}, '03' || {_KEY}] WHEN 2 THEN [{_KEY}, {_KEY}] WHEN 3 THEN [] WHEN 5 THEN ['xpub' || {_KEY} || '/0/*'] ELSE ['02' || {_KEY}] END"


def _descriptors(spark: SparkSession, d: str) -> DataFrame:
    p, key = F.col("p_partkey"), F.sha2(F.col("p_partkey").cast("string"), 256)
    forms = ("pk(02%s)#abcd1234", "multi(1, 02%s,03%s)", "tr(%s,{pk(%s)})", "addr(none)", "pkh([d34db33f/44'/0']02%s)", "wpkh(xpub%s/0/*)")
    out = F.lit(None).cast("string")
    for i, form in enumerate(forms):
        parts = form.split("%s")
        text = F.lit(parts[0])
        for part in parts[1:]:
            text = F.concat(text, key, F.lit(part))
        out = F.when(p % 6 == i, text).otherwise(out)
    return T.table(spark, d, "part").select(p, out.alias("descriptor"))


@query(f"SELECT p_partkey, array_to_string({_KEYS}, ',') AS keys, CAST(len({_KEYS}) AS INTEGER) AS n_keys FROM part")
def parse_desc_keys(spark, d):
    return _descriptors(spark, d).select("p_partkey", F.array_join(S.parse_desc("descriptor"), ",").alias("keys"), F.size(S.parse_desc("descriptor")).alias("n_keys"))


@query(f"SELECT p_partkey, ({_KEYS})[1] AS key FROM part")
def parse_desc_first(spark, d):
    return _descriptors(spark, d).select("p_partkey", S.first_desc_key("descriptor").alias("key"))


@query("SELECT p_partkey, array_to_string([x FOR x IN string_split(asm, ' ') IF x <> '' AND NOT starts_with(x, 'OP')], ',') AS tokens FROM (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'OP_2  ' || sha256(CAST(p_partkey AS VARCHAR)) || ' OP_PUSHBYTES_65 04' || p_partkey || ' OP_CHECKMULTISIG ' ELSE '' END AS asm FROM part)")
def push_data_tokens(spark, d):
    p = F.col("p_partkey")
    asm = F.when(p % 2 == 0, F.concat(F.lit("OP_2  "), F.sha2(p.cast("string"), 256), F.lit(" OP_PUSHBYTES_65 04"), p.cast("string"), F.lit(" OP_CHECKMULTISIG "))).otherwise("")
    return T.table(spark, d, "part").select(p, F.array_join(S.parse_push_data(asm), ",").alias("tokens"))


@query("SELECT txid, vin_txid, vin_vout, CASE WHEN witness_data IS NOT NULL THEN trim(string_split(witness_data, ',')[-1]) ELSE trim(string_split(vin_asm, ' ')[-1]) END AS key FROM shown", "shown")
def revealed_key(spark, d):
    return T.scripts(T.inputs(spark, d)).select("txid", "vin_txid", "vin_vout", S.revealed_key("witness_data", "vin_asm").alias("key"))


@query("SELECT p_partkey, CASE WHEN y % 2 = 1 THEN '03' ELSE '02' END || h AS compressed FROM (SELECT p_partkey, sha256(CAST(p_partkey AS VARCHAR)) AS h, position(right(sha256('y' || p_partkey), 1) IN '0123456789abcdef') - 1 AS y FROM part)")
def compress_pubkey(spark, d):
    p = F.col("p_partkey").cast("string")
    key = F.concat(F.lit("04"), F.sha2(p, 256), F.sha2(F.concat(F.lit("y"), p), 256))
    return T.table(spark, d, "part").select("p_partkey", S.compress_pubkey(key).alias("compressed"))


@query("SELECT p_partkey, left(p_name, 4) IN ('xpub', 'tpub', 'ypub', 'zpub', 'vpub') OR p_partkey % 3 = 0 AS extended FROM part")
def is_extended_key(spark, d):
    key = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("zpub"), "p_name")).otherwise(F.col("p_name"))
    return T.table(spark, d, "part").select("p_partkey", S.is_extended_key(key).alias("extended"))


@query("SELECT p_partkey, sha256('(''a' || p_partkey || ''', ''' || sha256(CAST(p_partkey AS VARCHAR)) || ''')') AS root_hash FROM part")
def root_hash_v1(spark, d):
    p = F.col("p_partkey").cast("string")
    return T.table(spark, d, "part").select("p_partkey", S.root_hash_v1(F.array(F.concat(F.lit("a"), p), F.sha2(p, 256))).alias("root_hash"))


# Keys. Only Python can derive addresses; golden values are in the tests.


def _points(spark: SparkSession, d: str) -> DataFrame:
    """Compressed hex that is a curve's x in about every second case."""
    return T.table(spark, d, "part").select(F.concat(F.lit("02"), F.sha2(F.col("p_partkey").cast("string"), 256)).alias("address"))


@query()
def derive_addresses(spark, d):
    return N.derived(_points(spark, d)).select("key", F.array_join("forms", ",").alias("forms"))


@query()
def unusable_keys(spark, d):
    return N.unusable_keys(N.derived(_points(spark, d)))


@query()
def normalized_hashes_v2(spark, d):
    return N.normalized_hashes(N.derived(_points(spark, d)))


@query()
def normalized_hashes_v1(spark, d):
    return N.normalized_hashes(N.derived(_points(spark, d)), N.ROOT_TUPLE)


@query()
def decompressed_pubkeys(spark, d):
    return _points(spark, d).distinct().select("address", K.decompress_pubkey()("address").alias("uncompressed"))


@query()
def xpub_children(spark, d):
    return N.derived(T.extended_keys(spark, d), n_child=2).select("key", F.posexplode_outer("forms").alias("nth", "form"))


_FORMS = "forms AS (SELECT lpad(CAST(p_partkey AS VARCHAR), 12, '0') AS key, sha256('a' || p_partkey // 2) AS a, sha256('b' || p_partkey) AS b, sha256('c' || p_partkey // 2) AS c, sha256('d' || p_partkey) AS d, sha256('e' || p_partkey) AS e FROM part WHERE p_partkey % 7 <> 0)"
_TUPLE = "sha256('(''' || a || ''', ''' || b || ''', ''' || c || ''', ''' || e || ''')')"


@query(f"WITH {_FORMS} SELECT DISTINCT unnest([a, b, c, d, e]) AS hash, a AS root_hash FROM forms")
def normalized_roots_v2(spark, d):
    return N.normalized_hashes(T.forms(spark, d))


@query(f"WITH {_FORMS}, r AS (SELECT key, unnest([a, b, c, e]) AS hash, {_TUPLE} AS root FROM forms) SELECT hash, min_by(root, key) AS root_hash FROM r GROUP BY hash")
def normalized_roots_v1(spark, d):
    return N.normalized_hashes(T.forms(spark, d), N.ROOT_TUPLE)


@query("SELECT lpad(CAST(p_partkey AS VARCHAR), 12, '0') AS key FROM part WHERE p_partkey % 7 = 0")
def unusable_roots(spark, d):
    return N.unusable_keys(T.forms(spark, d))


# Blocks.


def _lines(spark: SparkSession, d: str, name: str = "blocks", parts: int | None = None) -> str:
    """The folder of JSON lines, as landed blocks are."""
    path = new_path(spark, name)
    with tidy(spark):
        T.blocks(spark, d, parts).write.text(path, compression="gzip")  # hex is half air; a file is some shuffle partition, so that it can't be split matters little
    return path


def _shredded(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Through JSON lines in the shared folder."""
    return blocks.shred(blocks.read_blocks(spark, _lines(spark, d)))


def _ledger(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The whole run, from JSON lines that are parsed once and go then."""
    path = _lines(spark, d)
    read = blocks.landed_once(spark.read.text(path))[0]
    drop_path(spark, path)
    return pipeline.run_tables(blocks.shred(read, timed=True))


@query("SELECT CAST(txid AS VARCHAR) AS txid, t - 600 AS median_blocktime, t AS miner_time, CAST(0 AS BIGINT) AS locktime FROM txs JOIN (SELECT txid // 8 AS height, min(miner_time) AS t FROM txs GROUP BY ALL) b ON b.height = txid // 8", "txs")
def shredded_transactions(spark, d):
    return _shredded(spark, d)["transactions"]


@query("SELECT CAST(txid AS VARCHAR) AS txid, vout_n, value_sats, descriptor, nullif(address, '') AS address, descriptor_type FROM keyed", "keyed")
def shredded_outputs(spark, d):
    return _shredded(spark, d)["outputs"]


@query("SELECT CAST(txid AS VARCHAR) AS txid, CAST(vin_txid AS VARCHAR) AS vin_txid, vin_vout, vin_asm, witness_data FROM shown", "shown")
def shredded_inputs(spark, d):
    return _shredded(spark, d)["inputs"]


_REASON = "CASE txid // 8 % 6 WHEN 1 THEN 'malformed' WHEN 3 THEN 'no transactions' END"


@query(f"SELECT coalesce(r, 'blocks') AS kind, count(*) AS n FROM (SELECT DISTINCT txid // 8 AS height, {_REASON} AS r FROM txs) GROUP BY 1 UNION ALL SELECT 'transactions', count(*) FROM txs WHERE {_REASON} IS NULL UNION ALL SELECT 'outputs', count(*) FROM outs WHERE {_REASON} IS NULL UNION ALL SELECT 'inputs', count(*) FROM ins WHERE {_REASON} IS NULL UNION ALL SELECT 'inputs.coinbase', count(*) FROM ins WHERE {_REASON} IS NULL AND vin_txid IS NULL", "ins")
def rejected_blocks(spark, d):
    """A third of the lines broken, by a truncated end or for want of transactions: what was read and what was not, as counted on the way."""
    height = F.get_json_object("value", "$.height").cast("long")
    broken = F.when(height % 6 == 1, F.expr("left(value, length(value) - 9)")).when(height % 6 == 3, F.concat(F.lit('{"height":'), height.cast("string"), F.lit("}"))).otherwise(F.col("value"))
    path, counters = new_path(spark, "lines"), Counters()
    T.blocks(spark, d).select(broken.alias("value")).write.text(path, compression="gzip")
    read, rejects = blocks.landed_once(spark.read.text(path))
    for name, df in ({"blocks": read} | blocks.shred(read)).items():
        also = {"coinbase": F.col("vin_txid").isNull()} if name == "inputs" else {}
        counters.rows(df, name, **also).write.format("noop").mode("overwrite").save()
    seen = counters.table(spark).select(F.col("name").alias("kind"), "n")
    return seen.unionByName(rejects.groupBy(F.col("reason").alias("kind")).agg(F.count("*").alias("n")))


@query()
def ledger_clusters(spark, d):
    """The whole run, from blocks."""
    return _ledger(spark, d)["clusters"]


@query()
def ledger_balances(spark, d):
    return _ledger(spark, d)["balances"]


# Joins and updates.


@query("SELECT txid, vout_n, unnest(CASE WHEN nullif(address, '') IS NOT NULL THEN [address] ELSE regexp_extract_all(string_split(descriptor, '#')[1], '0[23][0-9A-Fa-f]{64}') END) AS address, descriptor_type FROM keyed WHERE descriptor_type IN ('pubkey', 'pubkeyhash', 'multisig')", "keyed")
def output_hashes_explode(spark, d):
    return N.output_hashes(T.addresses(T.outputs(spark, d)))


@query("SELECT txid, vout_n, CASE WHEN descriptor_type = 'pubkey' AND address = '' THEN regexp_extract(descriptor, '0[23][0-9a-f]{64}') ELSE address END AS address FROM keyed", "keyed")
def parse_pubkey_descriptors(spark, d):
    return N.parse_pubkey_descriptors(T.addresses(T.outputs(spark, d))).select("txid", "vout_n", "address")


_REVEALS = "(SELECT k.txid, k.vout_n, min(CASE WHEN witness_data IS NOT NULL THEN trim(string_split(witness_data, ',')[-1]) ELSE trim(string_split(vin_asm, ' ')[-1]) END) AS key FROM shown s JOIN keyed k ON k.txid = s.vin_txid AND k.vout_n = s.vin_vout WHERE k.descriptor_type = 'pubkeyhash' AND (witness_data IS NOT NULL OR vin_asm IS NOT NULL) GROUP BY ALL)"


@query(f"SELECT k.txid, k.vout_n, k.value_sats, k.descriptor, CASE WHEN r.txid IS NOT NULL THEN r.key ELSE k.address END AS address, CASE WHEN r.txid IS NOT NULL THEN 'pubkey' ELSE k.descriptor_type END AS descriptor_type FROM keyed k LEFT JOIN {_REVEALS} r USING (txid, vout_n)", "keyed", "shown")
def apply_reveals(spark, d):
    return N.apply_reveals(T.addresses(T.outputs(spark, d)), T.scripts(T.inputs(spark, d)))


@query("SELECT hash, min_by(root, pos) AS root FROM (SELECT p_brand AS hash, p_name AS root, p_partkey AS pos FROM part) GROUP BY hash")
def first_wins_map(spark, d):
    rows = T.table(spark, d, "part").select(F.col("p_brand").alias("hash"), F.col("p_name").alias("root"), F.col("p_partkey").alias("pos"))
    return N.first_wins(rows, "hash", "root", "pos")


@query("SELECT i.txid, o.txid AS spent_txid, o.vout_n, o.value_sats FROM ins i JOIN outs o ON i.vin_txid = o.txid AND i.vin_vout = o.vout_n", "ins")
def resolve_inputs(spark, d):
    return N.match_inputs(T.inputs(spark, d), T.outputs(spark, d))


@query("SELECT i.txid, o.txid AS spent_txid, o.vout_n, o.wallet FROM ins i JOIN outs o ON i.vin_txid = o.txid AND i.vin_vout = o.vout_n", "ins")
def match_input_output(spark, d):
    return N.match_inputs(T.inputs(spark, d).drop("wallet"), T.outputs(spark, d), ("wallet",))


@query("SELECT i.txid, i.vin_txid, i.vin_vout, coalesce(n.root_hash, nullif(k.address, '')) AS vin_wallet_id FROM ins i LEFT JOIN keyed k ON i.vin_txid = k.txid AND i.vin_vout = k.vout_n LEFT JOIN norm n ON n.hash = k.address", "ins", "keyed", "norm")
def wallet_ids(spark, d):
    ins = T.inputs(spark, d).drop("wallet")
    return N.wallet_ids(ins, T.addresses(T.outputs(spark, d)), T.normalized(spark, d)).select("txid", "vin_txid", "vin_vout", "vin_wallet_id")


_NODES = "nodes AS (SELECT DISTINCT {tx} AS tx, coalesce(n.root_hash, nullif(k.address, ''), i.vin_txid || ':' || i.vin_vout) AS node FROM ins i JOIN keyed k ON i.vin_txid = k.txid AND i.vin_vout = k.vout_n LEFT JOIN norm n ON n.hash = k.address)"


def _node_oracle(tx: str, body: str) -> str:
    return T.sql("", "ins", "keyed", "norm").rstrip() + ", " + _NODES.format(tx=tx) + " " + body


def _nodes(spark: SparkSession, d: str, edge_key: str) -> DataFrame:
    return N.input_nodes(T.inputs(spark, d), T.addresses(T.outputs(spark, d)), T.normalized(spark, d), edge_key)


@query(_node_oracle("i.txid", "SELECT * FROM nodes"))
def node_ids(spark, d):
    return _nodes(spark, d, "spending")


@query(_node_oracle("i.vin_txid", "SELECT * FROM nodes"))
def node_ids_funding(spark, d):
    return _nodes(spark, d, "funding")


@query(_node_oracle("i.txid", "SELECT DISTINCT node AS hash, node AS root_hash FROM nodes WHERE NOT EXISTS (SELECT 1 FROM norm WHERE hash = node AND root_hash = node)"))
def missing_nodes(spark, d):
    return N.missing_nodes(_nodes(spark, d, "spending"), T.normalized(spark, d))


@query(_node_oracle("i.vin_txid", "SELECT DISTINCT x.node AS a, y.node AS b FROM nodes x JOIN nodes y ON x.tx = y.tx AND x.node < y.node"))
def sibling_edges(spark, d):
    return C.spend_edges(_nodes(spark, d, "funding"), wallet="node")


_COMPONENTS = "pairs AS (SELECT tx, node AS wallet FROM nodes), " + ", ".join(T.SQL[x] for x in ("star", "reach", "comps"))


def _component_oracle(tx: str) -> str:
    return T.sql("", "ins", "keyed", "norm").rstrip() + f", {_NODES.format(tx=tx)}, {_COMPONENTS} SELECT wallet AS node, component FROM comps"


@query(_component_oracle("i.txid"))
def node_components(spark, d):
    return C.components(_nodes(spark, d, "spending"), wallet="node")


@query(_component_oracle("i.vin_txid"))
def node_components_funding(spark, d):
    return C.components(_nodes(spark, d, "funding"), wallet="node")


@query("SELECT DISTINCT address FROM keyed WHERE descriptor_type = 'pubkey' AND address <> '' AND NOT EXISTS (SELECT 1 FROM norm WHERE hash = address)", "keyed", "norm")
def unmapped_outputs(spark, d):
    return N.unmapped_keys(T.addresses(T.outputs(spark, d)), T.normalized(spark, d))


@query("SELECT s.txid, s.vin_txid, s.vin_vout, CASE WHEN k.descriptor_type = 'pubkey' THEN NULL ELSE vin_asm END AS vin_asm, CASE WHEN k.descriptor_type = 'pubkey' THEN NULL ELSE witness_data END AS witness_data FROM shown s LEFT JOIN keyed k ON s.vin_txid = k.txid AND s.vin_vout = k.vout_n", "shown", "keyed")
def trim_inputs(spark, d):
    return N.trim(T.addresses(T.outputs(spark, d)), T.scripts(T.inputs(spark, d)))[1]


@query("SELECT txid, vout_n, CASE WHEN descriptor_type = 'pubkey' THEN NULL ELSE descriptor END AS descriptor FROM keyed", "keyed")
def trim_outputs(spark, d):
    return N.trim(T.addresses(T.outputs(spark, d)), T.scripts(T.inputs(spark, d)))[0].select("txid", "vout_n", "descriptor")


@query("SELECT DISTINCT 'P' || p_partkey AS hash, 'R' || (p_partkey // 4) AS root_hash FROM part WHERE p_partkey % 4 >= 2")
def insert_ignore(spark, d):
    p = F.col("p_partkey")
    new = T.table(spark, d, "part").select(F.concat(F.lit("P"), p.cast("string")).alias("hash"), F.concat(F.lit("R"), (p / 4).cast("bigint").cast("string")).alias("root_hash"))
    return tables.insert_ignore(T.normalized(spark, d), new.unionByName(new), ["hash", "root_hash"])


@query("SELECT c_custkey AS wallet, CASE WHEN c_custkey % 3 = 0 THEN c_custkey + 1 ELSE c_nationkey END AS cluster_id FROM customer")
def upsert_clusters(spark, d):
    own = T.table(spark, d, "customer").select(F.col("c_custkey").alias("wallet"), F.col("c_nationkey").cast("long").alias("cluster_id"))
    return tables.upsert(own, own.where("wallet % 3 = 0").withColumn("cluster_id", F.col("wallet") + 1), ["wallet"])


@query("SELECT c_custkey AS wallet, CASE WHEN c_custkey % 3 = 0 THEN c_custkey + 1 WHEN c_custkey % 5 = 0 THEN -1 ELSE c_nationkey END AS cluster_id FROM customer UNION ALL SELECT -1 - c_custkey, 0 FROM customer WHERE c_custkey % 7 = 0")
def upsert_in_buckets(spark, d):
    """A table by buckets of its key: updated, upserted and inserted into, each time only in the buckets that change."""
    own = T.table(spark, d, "customer").select(F.col("c_custkey").alias("wallet"), F.col("c_nationkey").cast("long").alias("cluster_id"))
    table = keyed.Keyed(new_path(spark, "keyed"), ("wallet",), 16)
    table.create(own)
    table.update_from(own.where("wallet % 5 = 0").select("wallet"), {"cluster_id": F.lit(-1).cast("long")})
    table.upsert(own.where("wallet % 3 = 0").withColumn("cluster_id", F.col("wallet") + 1))
    table.insert_ignore(own.where("wallet % 7 = 0").select((-1 - F.col("wallet")).alias("wallet"), F.lit(0).cast("long").alias("cluster_id")).unionByName(own))
    return table.read(spark)


@query("SELECT i.txid, o.txid AS spent_txid, o.vout_n, o.value_sats FROM ins i JOIN outs o ON i.vin_txid = o.txid AND i.vin_vout = o.vout_n", "ins")
def resolve_in_buckets(spark, d):
    """The join of outpoints on tables bucketed alike, without an exchange."""
    outs, ins = keyed.outpoint_tables(T.outputs(spark, d), T.inputs(spark, d), 8)
    return N.match_inputs(ins, outs)


# Sources and sinks.


@query("SELECT txid, vout_n, value_sats, txid // 800 AS chunk, wallet FROM outs", "outs")
def csv_chunks(spark, d):
    """Written as CSV by chunk of heights, marked once whole, and read back."""
    path = new_path(spark, "chunks")
    rows = T.outputs(spark, d).withColumn("chunk", F.expr("txid DIV 800"))
    tables.write_chunks(rows, path, kind="csv")
    if not tables.is_whole(spark, path):
        raise RuntimeError("a chunk is missing")
    return tables.read_csv(spark, path, rows.schema)


@query("SELECT txid, vin_txid, vin_vout FROM ins", "ins")
def csv_load(spark, d):
    """Missing values survive a CSV file as empty fields."""
    path, rows = new_path(spark, "inputs"), T.inputs(spark, d).drop("wallet")
    tables.write_csv(rows, path)
    return tables.read_csv(spark, path, rows.schema)


@query("SELECT p_partkey AS row_id, p_name AS name FROM part UNION ALL SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT s_suppkey, s_name FROM supplier")
def create_and_append(spark, d):
    """A table is created once, however often that is asked, and appended to."""
    path = new_path(spark, "rows")
    parts = T.table(spark, d, "part").select(F.col("p_partkey").alias("row_id"), F.col("p_name").alias("name"))
    suppliers = T.table(spark, d, "supplier").select(F.col("s_suppkey").alias("row_id"), F.col("s_name").alias("name"))
    for rows in (parts, suppliers):
        tables.create_if_missing(rows, path)
    for _ in range(2):
        tables.append(suppliers, path)
    return spark.read.parquet(path)


@query("SELECT CAST(txid AS VARCHAR) AS txid, CAST(vin_txid AS VARCHAR) AS vin_txid, vin_vout, vin_asm, CAST(NULL AS VARCHAR) AS witness_data FROM shown", "shown")
def fixed_columns(spark, d):
    """The schema's columns: one is missing, one too many, and two are of another kind."""
    return tables.fit_columns(T.scripts(T.inputs(spark, d)).drop("witness_data").withColumn("extra", F.lit(1)), schema.INPUTS)


@query("SELECT txid, miner_time, CAST(NULL AS BIGINT) AS value_sats FROM txs UNION ALL SELECT txid, NULL, value_sats FROM outs", "txs", "outs")
def concatenated(spark, d):
    return tables.concat(T.transactions(spark, d), T.outputs(spark, d).select("txid", "value_sats"))


@query("SELECT txid, vout_n, wallet + 1 AS wallet FROM outs WHERE value_sats % 2 = 1 UNION ALL SELECT txid, vout_n, wallet FROM outs WHERE value_sats % 2 = 0", "outs")
def staged_update(spark, d):
    """Updates staged in a work table, then applied to the rows that they name."""
    rows = T.outputs(spark, d)
    staged = Table(rows.where("value_sats % 2 = 1").select("txid", "vout_n", (F.col("wallet") + 1).alias("new_wallet")), "staged")
    return tables.update_from(rows.select("txid", "vout_n", "wallet"), staged.df, ["txid", "vout_n"], {"wallet": F.col("new_wallet")})


# Other filters and functions.


@query("SELECT txid, vout_n, unnest(CASE WHEN nullif(address, '') IS NOT NULL THEN [address] ELSE regexp_extract_all(string_split(descriptor, '#')[1], '0[23][0-9A-Fa-f]{64}') END) AS address, descriptor_type FROM keyed k WHERE descriptor_type IN ('pubkey', 'pubkeyhash', 'multisig') AND NOT EXISTS (SELECT 1 FROM spends s WHERE s.vin_txid = k.txid AND s.vin_vout = k.vout_n)", "keyed", "spends")
def output_hashes_unknown(spark, d):
    """Hashes of outputs that are not known yet; known here: the spent ones."""
    known = T.inputs(spark, d).where("vin_txid is not null").select(F.col("vin_txid").alias("txid"), F.col("vin_vout").alias("vout_n"))
    return N.output_hashes(T.addresses(T.outputs(spark, d)), known)


@query(f"SELECT p_partkey, array_to_string({_KEYS}, ',') AS keys, p_partkey % 6 = 5 AS extended, CASE WHEN p_partkey % 2 = 0 THEN 'w' || p_partkey ELSE 'a' || p_partkey END AS revealed, 'x' || p_partkey || ',y' AS tokens FROM part")
def sql_functions(spark, d):
    """The library's functions under their SQL names."""
    registry.register(spark)
    _descriptors(spark, d).createOrReplaceTempView("walletgraph_descriptors")
    return spark.sql(
        """SELECT p_partkey, array_join(parse_desc(descriptor), ',') AS keys, coalesce(is_extended_key(get(parse_desc(descriptor), 0)), false) AS extended,
        revealed_key(IF(p_partkey % 2 = 0, concat('s, w', p_partkey), NULL), concat('s a', p_partkey)) AS revealed, array_join(parse_push_data(concat('OP_1 x', p_partkey, '  OP_2 y')), ',') AS tokens FROM walletgraph_descriptors"""
    )


_SPENT = "nodes AS (SELECT DISTINCT i.txid AS tx, coalesce(nullif(k.address, ''), CASE WHEN k.descriptor_type = 'pubkey' THEN regexp_extract(k.descriptor, '0[23][0-9a-f]{64}') END, i.vin_txid || ':' || i.vin_vout) AS node FROM ins i JOIN keyed k ON i.vin_txid = k.txid AND i.vin_vout = k.vout_n)"


@query(T.sql("", "ins", "keyed").rstrip() + f", {_SPENT}, {_COMPONENTS} SELECT wallet, component FROM comps")
def streamed_labels(spark, d):
    """Blocks that land in no order, followed in four batches: clusters of wallets as a run over all of them has them.

    A batch is a file for each 100,000 transactions of it, as a task reads a compressed file whole."""
    folder = new_path(spark, "labels")
    files = -(-T.transactions(spark, d).count() // 400_000) or 1
    path = _lines(spark, d, "landed", 4 * files)
    incremental.follow(incremental.stream_pairs(spark, path, files), folder, new_path(spark, "offsets")).awaitTermination()
    return incremental.Labels(spark, folder).wallets()


# Graph operators.


@query("SELECT DISTINCT x.wallet AS a, y.wallet AS b FROM pairs x JOIN pairs y ON x.tx = y.tx AND x.wallet < y.wallet", "pairs")
def spend_edges(spark, d):
    return C.spend_edges(T.pairs(spark, d))


@query("SELECT DISTINCT y.wallet FROM pairs x JOIN pairs y ON x.tx = y.tx AND x.wallet <> y.wallet WHERE x.wallet = (SELECT min(wallet) FROM pairs JOIN (SELECT tx FROM pairs GROUP BY tx HAVING count(*) > 1) USING (tx))", "pairs")
def neighbors(spark, d):
    pairs = T.pairs(spark, d)
    shared = pairs.groupBy("tx").count().where("count > 1").select("tx")
    of = pairs.join(shared, "tx", "left_semi").agg(F.min("wallet")).first()[0]
    return C.neighbors(pairs, of)


@query("SELECT wallet, component FROM comps", "comps")
def components_min_label(spark, d):
    return C.components(T.pairs(spark, d))


@query("SELECT wallet, component FROM comps", "comps")
def components_by_stars(spark, d):
    """By rounds of joins, as for graphs that no task can hold."""
    return C.components(T.pairs(spark, d), small=0)


_WALK = """, near(wallet, distance) USING KEY (wallet) AS (SELECT DISTINCT p_partkey, 0 FROM part WHERE p_partkey % 500 = 1
UNION SELECT y.wallet, min(n.distance) + 1 FROM near n JOIN pairs x ON x.wallet = n.wallet JOIN pairs y ON y.tx = x.tx LEFT JOIN recurring.near k ON k.wallet = y.wallet WHERE k.wallet IS NULL{limit} GROUP BY y.wallet)
SELECT n.wallet, CAST(n.distance AS INTEGER) AS distance, min(m.wallet) AS via FROM near n LEFT JOIN pairs y ON y.wallet = n.wallet LEFT JOIN pairs x ON x.tx = y.tx LEFT JOIN near m ON m.wallet = x.wallet AND m.distance = n.distance - 1 GROUP BY ALL"""


def _walk_oracle(limit: str) -> str:
    return T.sql("", "pairs").rstrip() + _WALK.format(limit=limit)


def _seeds(spark: SparkSession, d: str) -> DataFrame:
    return T.table(spark, d, "part").where("p_partkey % 500 = 1").select(F.col("p_partkey").alias("wallet"))


@query(_walk_oracle(" AND n.distance < 1"))
def wallet_walk_one_hop(spark, d):
    return walk.walk(T.pairs(spark, d), _seeds(spark, d), 1)


@query(_walk_oracle(""))
def wallet_walk(spark, d):
    """All wallets that can be reached from some, by distance, each with one of the level before."""
    return walk.walk(T.pairs(spark, d), _seeds(spark, d))


def _adjacency(spark: SparkSession, d: str) -> adjacency.Adjacency:
    return adjacency.build(T.pairs(spark, d), new_path(spark, "adjacency"), 8)


@query("SELECT wallet, count(DISTINCT tx) AS n FROM pairs GROUP BY wallet", "pairs")
def adjacency_degrees(spark, d):
    """Lengths of the stored lists of transactions."""
    return _adjacency(spark, d).degrees(spark, "wallet")


@query("SELECT DISTINCT x.wallet, y.wallet AS neighbor FROM pairs x JOIN pairs y ON x.tx = y.tx AND x.wallet <> y.wallet WHERE x.wallet IN (SELECT p_partkey FROM part WHERE p_partkey % 500 = 1)", "pairs")
def adjacency_neighbors(spark, d):
    """Neighbours of some wallets, looked up in stored lists."""
    return _adjacency(spark, d).neighbors(_seeds(spark, d))


@query(_walk_oracle(""))
def adjacency_walk(spark, d):
    """As wallet_walk, from stored lists."""
    return walk.walk(_adjacency(spark, d), _seeds(spark, d))


@query("SELECT wallet, dense_rank() OVER (ORDER BY component) - 1 AS cluster_id FROM comps", "comps")
def cluster_dense_id(spark, d):
    return C.cluster(T.pairs(spark, d))


@query(f"SELECT component, (n - 1) // {C.MEMBERS} AS part, string_agg(wallet, ',' ORDER BY n) AS members FROM (SELECT *, row_number() OVER (PARTITION BY component ORDER BY wallet) AS n FROM comps) GROUP BY ALL", "comps")
def cluster_members(spark, d):
    found = C.members(C.components(T.pairs(spark, d)))
    return found.select("component", "part", F.array_join(F.col("members").cast("array<string>"), ",").alias("members"))


@query("SELECT component, count(*) AS n_wallets FROM comps GROUP BY component", "comps")
def cluster_sizes(spark, d):
    return C.sizes(C.components(T.pairs(spark, d)))


@query("SELECT wallet, dense_rank() OVER (ORDER BY f, component) AS cluster_id FROM comps JOIN (SELECT component, max(wallet) AS f FROM comps GROUP BY component) USING (component)", "comps")
def visited_order(spark, d):
    found = C.components(T.pairs(spark, d))
    latest = found.groupBy("component").agg(F.max("wallet").alias("seed"))
    return C.visited_order(found.join(latest, "component"), "seed")


@query("SELECT wallet, min(m) AS label FROM pairs JOIN (SELECT tx, min(wallet) AS m FROM pairs GROUP BY tx) USING (tx) GROUP BY wallet", "pairs")
def one_hop_label(spark, d):
    return C.one_hop_label(T.pairs(spark, d))


_ROWS = """r AS (SELECT p_partkey AS row_id, CASE WHEN p_partkey % 4 < 2 THEN 'u' || (p_partkey // 4) END AS u, CASE WHEN p_partkey % 4 IN (1, 2) THEN 'c' || (p_partkey // 4) END AS c,
CASE WHEN p_partkey % 4 > 1 THEN 'l' || (p_partkey // 4) END AS l, CASE WHEN p_partkey % 4 = 3 AND p_partkey // 4 % 2 = 0 THEN 's' || (p_partkey // 4) END AS s FROM part)"""


@query(
    f"""WITH RECURSIVE {_ROWS}, v AS (SELECT row_id, unnest(['u' || u, 'c' || c, 'l' || l, 's' || s]) AS x FROM r), e AS (SELECT DISTINCT a.row_id AS a, b.row_id AS b FROM v a JOIN v b USING (x)),
g(n, c) AS (SELECT row_id, row_id FROM r UNION SELECT e.b, g.c FROM g JOIN e ON g.n = e.a), k AS (SELECT n AS row_id, min(c) AS k FROM g GROUP BY n),
w AS (SELECT k, max(u) AS wu, max(c) AS wc, max(l) AS wl, max(s) AS ws FROM r JOIN k USING (row_id) GROUP BY k),
i AS (SELECT *, dense_rank() OVER (ORDER BY (wu IS NULL OR wc IS NULL OR wl IS NULL OR ws IS NULL), k) - 1 AS Identifier FROM w)
SELECT row_id, coalesce(u, wu) AS u, coalesce(c, wc) AS c, coalesce(l, wl) AS l, coalesce(s, ws) AS s, Identifier FROM r JOIN k USING (row_id) JOIN i USING (k)"""
)
def match_addresses(spark, d):
    p, g = F.col("p_partkey"), (F.col("p_partkey") / 4).cast("bigint").cast("string")
    form = lambda when, letter: F.when(when, F.concat(F.lit(letter), g))
    rows = T.table(spark, d, "part").select(p.alias("row_id"), form(p % 4 < 2, "u").alias("u"), form((p % 4).isin(1, 2), "c").alias("c"), form(p % 4 > 1, "l").alias("l"), form((p % 4 == 3) & ((p / 4).cast("bigint") % 2 == 0), "s").alias("s"))
    return C.match_rows(rows, ["u", "c", "l", "s"], "row_id")


# Balances.


def _clusters(spark: SparkSession, d: str) -> DataFrame:
    return C.components(T.pairs(spark, d)).withColumnRenamed("component", "cluster")


def _flows(spark: SparkSession, d: str) -> DataFrame:
    outs, txs, clusters = T.outputs(spark, d), T.transactions(spark, d), _clusters(spark, d)
    return B.credits(outs, txs, clusters).unionByName(B.debits(T.inputs(spark, d).drop("wallet"), outs, txs, clusters))


@query("SELECT cluster, miner_time, CAST(sum(delta) AS BIGINT) AS delta FROM flows WHERE delta > 0 GROUP BY ALL", "flows")
def cluster_credits(spark, d):
    return B.by_time(B.credits(T.outputs(spark, d), T.transactions(spark, d), _clusters(spark, d)))


@query("SELECT cluster, miner_time, CAST(sum(delta) AS BIGINT) AS delta FROM flows WHERE delta < 0 GROUP BY ALL", "flows")
def cluster_debits(spark, d):
    return B.by_time(B.debits(T.inputs(spark, d).drop("wallet"), T.outputs(spark, d), T.transactions(spark, d), _clusters(spark, d)))


@query("SELECT cluster, txid, CAST(sum(delta) AS BIGINT) AS delta FROM flows GROUP BY ALL", "flows")
def net_flows(spark, d):
    return B.net_flows(_flows(spark, d))


@query("SELECT cluster, miner_time, CAST(sum(delta) OVER (PARTITION BY cluster ORDER BY miner_time) AS BIGINT) AS balance FROM (SELECT cluster, miner_time, sum(delta) AS delta FROM flows GROUP BY ALL)", "flows")
def balance_through_time(spark, d):
    return B.balance_through_time(_flows(spark, d))


#: 1997-01-01, within the orders' dates.
THEN = 852_076_800


@query(f"SELECT o.* FROM outs o JOIN txs USING (txid) WHERE miner_time <= {THEN} AND NOT EXISTS (SELECT 1 FROM spends s JOIN txs t USING (txid) WHERE t.miner_time <= {THEN} AND s.vin_txid = o.txid AND s.vin_vout = o.vout_n)", "spends")
def utxo_set(spark, d):
    return B.utxo_set(T.outputs(spark, d), T.inputs(spark, d), T.transactions(spark, d), THEN)


def _spends(spark, d):
    ins = T.inputs(spark, d).where("vin_txid is not null").groupBy(F.col("vin_txid").alias("txid"), F.col("vin_vout").alias("vout_n")).agg(F.min("txid").alias("spender"))
    return T.outputs(spark, d).join(ins, ["txid", "vout_n"], "left")


def _month_ends(spark, d):
    """Seconds of the last instant of each month that has an order."""
    months = T.transactions(spark, d).select(F.trunc(F.timestamp_seconds("miner_time"), "month").alias("m")).distinct()
    return months.select((F.unix_date(F.add_months("m", 1)).cast("long") * 86_400 - 1).alias("at"))


MONTHS = "months AS (SELECT DISTINCT CAST(epoch(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH) AS BIGINT) - 1 AS at FROM orders)"
LIVES = "lives AS (SELECT o.wallet, o.value_sats, m.miner_time AS made, e.miner_time AS ended FROM outs o JOIN txs m USING (txid) LEFT JOIN spends s ON s.vin_txid = o.txid AND s.vin_vout = o.vout_n LEFT JOIN txs e ON e.txid = s.txid)"
ALIVE = "lives l ON l.made <= m.at AND (l.ended IS NULL OR l.ended > m.at)"


@query(f", {MONTHS}, {LIVES} SELECT m.at, count(l.wallet) AS n_unspent, CAST(coalesce(sum(l.value_sats), 0) AS BIGINT) AS unspent_sats FROM months m LEFT JOIN {ALIVE} GROUP BY m.at", "spends")
def utxo_by_month(spark, d):
    """Unspent outputs and their sum at every month's end, in one pass."""
    return B.holdings(B.lifetimes(_spends(spark, d), T.transactions(spark, d)), _month_ends(spark, d))


@query(f", {MONTHS}, {LIVES} SELECT l.wallet, m.at, count(*) AS n_unspent, CAST(sum(l.value_sats) AS BIGINT) AS unspent_sats FROM months m JOIN {ALIVE} GROUP BY ALL", "spends")
def wallets_by_month(spark, d):
    """The same for each wallet that holds something."""
    return B.holdings(B.lifetimes(_spends(spark, d), T.transactions(spark, d)), _month_ends(spark, d), "wallet")
