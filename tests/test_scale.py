"""What must not grow faster than the input: files, rows in memory, bytes written."""

import random

from pyspark.sql import functions as F

from tests.conftest import DATA
from tests.test_graph import brute
from walletgraph import testbed as T
from walletgraph.functions import keys as K
from walletgraph.functions import script as S
from walletgraph.operators import clusters as C
from walletgraph.operators import graph
from walletgraph.operators import normalize as N
from walletgraph.plans import pipeline
from walletgraph.shared import Table
from walletgraph.sources import blocks, tables
from walletgraph.streaming import incremental


def test_forests_of_long_names_are_bounded_by_bytes(spark, monkeypatch):
    """A task that holds more bytes of names than it may hands its forests back in parts; components stay right."""
    monkeypatch.setattr(graph, "SMALL_BYTES", 1 << 20)
    rng = random.Random(5)
    name = lambda i: f"{i:05}" + "x" * 300
    edges = [(rng.randrange(9000), rng.randrange(9000)) for _ in range(12000)]
    df = spark.createDataFrame([(name(a), name(b)) for a, b in edges], "a string, b string").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 500)
    try:
        assert graph._forest(df, graph.SMALL).select("task").distinct().count() > 1
        found = {int(r.node[:5]): int(r.component[:5]) for r in graph.connected_components(df).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found == brute(edges)


def test_chunks_have_a_file_each(spark, tmp_path):
    """Not a file for every task that has some of a chunk's rows."""
    rows = spark.range(4000).select("id", (F.col("id") % 20).alias("chunk")).repartition(8)
    tables.write_chunks(rows, str(tmp_path / "c"), kind="csv")
    assert len(list((tmp_path / "c").glob("chunk=*/*.csv"))) == 20
    assert tables.read_csv(spark, str(tmp_path / "c"), rows.schema).count() == 4000


def test_multiples_of_the_generator():
    """A child costs an addition for each window of its factor, not a doubling for each bit: the same points."""
    rng, point = random.Random(3), K.multiply(12345, K.G)
    for k in [1, 2, 255, 256, 12345, K.N - 1, 2**256 - 1, *(rng.randrange(K.N) for _ in range(20))]:
        assert K.add_generator(k, point) == K.add(K.multiply(k, K.G), point)
    assert K.add_generator(K.N - 12345, point) is None


def test_blocks_exchange_numbers_only(spark):
    """Scripts are made above the last aggregation, not sent through every exchange."""
    lines = T.blocks(spark, DATA)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert max(i for i, x in enumerate(lines) if "sha2" in x) < min(i for i, x in enumerate(lines) if "Aggregate" in x)


def test_lines_are_told_once(spark):
    """Blocks and rejects from one pass are those of two, and reading them parses no line."""
    lines = spark.createDataFrame([('{"height": 1, "tx": [{"txid": "a", "vin": [], "vout": []}]}',), ("no json",), (" ",), ('{"height": 2}',)], "value string")
    for one, two in zip(blocks.landed_once(lines), blocks.landed(lines), strict=True):
        assert sorted(one.collect()) == sorted(two.collect())
        assert "from_json" not in one._jdf.queryExecution().toString()


def test_forms_are_dealt_out(spark):
    assert T.forms(spark, DATA).rdd.getNumPartitions() >= 8


def test_parts_follow_the_pairs(spark, monkeypatch):
    """Edges are made distinct in as many parts as the pairs ask for, and after they have met."""
    monkeypatch.setattr(C, "PAIRS", 10)
    pairs = spark.createDataFrame([(i // 4, i) for i in range(400)], "tx long, wallet long")
    edges = C.spend_edges(pairs)
    assert edges.rdd.getNumPartitions() == 40 and edges.count() == 600


def test_ledger_moves_no_descriptors(spark):
    """What clusters and balances come from has at most a key for a descriptor, and flows are written for neither."""
    outputs = spark.createDataFrame([("t", i, 1, d, a, k) for i, (d, a, k) in enumerate([(f"pk(02{'ab' * 32})#x", None, "pubkey"), (f"pkh([d34db33f/0]02{'cd' * 32})", "1a", "pubkeyhash"), ("wpkh(xpubA1/0/*)", "bc1", "witness_v0_keyhash"), ("raw(6a)", "", "pubkey")])], "txid string, vout_n int, value_sats long, descriptor string, address string, descriptor_type string")
    inputs = spark.createDataFrame([("s", "t", 1, "3044 ", None)], "txid string, vin_txid string, vin_vout int, vin_asm string, witness_data string")
    slim = N.key_for_descriptor(outputs)
    assert [r.descriptor for r in slim.orderBy("vout_n").collect()] == ["02" + "ab" * 32, "02" + "cd" * 32, None, None]
    one, two = (N.parse_pubkey_descriptors(N.apply_reveals(x, inputs)).drop("descriptor") for x in (slim, outputs))
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
    txs = spark.createDataFrame([("t", 0, 1, 0), ("s", 0, 2, 0)], "txid string, median_blocktime long, miner_time long, locktime long")
    got = pipeline.run_tables({"transactions": txs, "outputs": outputs, "inputs": inputs})
    assert not any("/flows-" in f for f in got["balances"].inputFiles())
    assert {r.vout_n: r.descriptor for r in got["outputs"].collect()} == {0: None, 1: None, 2: "wpkh(xpubA1/0/*)", 3: None}


def test_work_tables_leave_no_shuffle_files(spark):
    """What a written table was exchanged through is gone from the disk, not left until the driver collects garbage."""
    files = lambda: {f for f in str(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")).split("\n") if "shuffle_" in f}
    before = files()
    made = Table(spark.range(5000).repartition(4, "id").groupBy("id").count(), "made")
    assert files() - before == set()
    assert made.df.count() == 5000
    made.drop()


def test_packed_names(spark):
    """Hex takes half the bytes, and every string comes back."""
    texts = ["", "ab", "AB", "abc", "02" + "ab" * 32, "t:0", "bc1qz", "\0", "é", None]
    rows = spark.createDataFrame([(x,) for x in texts], "t string").withColumn("p", S.packed("t")).select("t", "p", S.unpacked("p").alias("u")).collect()
    assert [r.u for r in rows] == texts and len({bytes(r.p) for r in rows if r.p is not None}) == len(texts) - 1
    assert len(rows[4].p) == 34


def test_timed_ledger(spark):
    """Times that come with the rows give what a join for them gives; wallets are numbers until the results, which have the smallest names."""
    read = blocks.landed_once(T.blocks(spark, DATA))[0]
    one, two = (pipeline.run_tables(blocks.shred(read, timed=x)) for x in (True, False))
    for name in ("clusters", "balances", "net_flows", "nodes"):
        assert sorted(map(str, one[name].collect())) == sorted(map(str, two[name].collect())), name
    least = {}
    for r in one["clusters"].collect():
        least[r.cluster] = min(least.get(r.cluster, r.root_hash), r.root_hash)
    assert all(k == v for k, v in least.items())
    scanned = one["balances"]._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner, (txid" not in scanned and "miner_time" in scanned


def test_batches_are_exchanged_once(spark, tmp_path, monkeypatch):
    """A batch's links are written once, and no work table of it is exchanged again only to be written."""
    made = []
    monkeypatch.setattr(incremental, "Table", lambda df, name, rebalance=True, **k: made.append((name, rebalance)) or Table(df, name, rebalance, **k))
    outpoints, labels = incremental.Outpoints(spark, str(tmp_path / "o")), incremental.Labels(spark, str(tmp_path / "l"))
    links = outpoints.add(0, spark.createDataFrame([("a:0", "x", None), ("b:0", "y", None), ("a:0", None, "s"), ("b:0", None, "s")], "outpoint string, wallet string, spender string"))
    labels.add(0, links.df)
    assert {tuple(r) for r in labels.wallets().collect()} == {("x", "x"), ("y", "x")}
    assert made == [(x, False) for x in ("events", "met", "links", "pairs", "known")]
