"""The graph of transactions and wallets as stored neighbour lists: built once, read by look-ups and walks.

Each side has a table of lists: the transactions of a wallet, the wallets of a transaction. Together they are as large as the pairs
that they come from, where lists of wallets next to wallets would grow with the square of a transaction's inputs. A list is in order and cut
into rows of `size` members, so a hub that a third of all pairs belongs to is many rows, which several tasks and files share."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from walletgraph.operators.clusters import cut
from walletgraph.shared import Table
from walletgraph.sources.keyed import Keyed

#: Members of a row; keys that a look-up names in its filter, by which Spark leaves out row groups and pages of the buckets' sorted files.
SIZE, FEW = 1000, 200


@dataclass(frozen=True)
class Adjacency:
    """Lists under a path, in `buckets` buckets a side. The path is a folder of the shared storage and outlives the session."""

    path: str
    buckets: int

    def _side(self, key: str) -> Keyed:
        return Keyed(f"{self.path}/of_{key}", (key,), self.buckets)

    def lists(self, spark: SparkSession, key: str) -> DataFrame:
        """(key, part, members): key is wallet or tx, members are the other; parts of a list count from 0 and follow its order."""
        return self._side(key).read(spark)

    def degrees(self, spark: SparkSession, key: str) -> DataFrame:
        """(key, n): how many members the list of each key has; no list is opened up."""
        return self.lists(spark, key).groupBy(key).agg(F.sum(F.size("members").cast("long")).alias("n"))

    def of(self, keys: DataFrame, key: str) -> DataFrame:
        """The lists (key, part, members) of some keys. Reads only the buckets that those are in, and of few keys only the pages that may have them."""
        spark, side = keys.sparkSession, self._side(key)
        stored = side.stored(spark)
        own = keys.select(F.col(key).cast(stored.schema[key].dataType).alias(key)).where(F.col(key).isNotNull()).distinct()
        touched = [r[0] for r in own.select(side.bucket().alias("b")).distinct().collect()]  # numbers of buckets, of which there is a fixed count
        found = stored.where(F.col(side.column).isin(touched) if touched else F.lit(False))
        few = [r[0] for r in own.limit(FEW + 1).collect()]
        if 0 < len(few) <= FEW:
            return found.where(F.col(key).isin(few)).drop(side.column)
        return found.drop(side.column).join(own, key, "left_semi")

    def transactions(self, wallets: DataFrame) -> DataFrame:
        """(wallet, tx) of some wallets."""
        return self.of(wallets, "wallet").select("wallet", F.explode("members").alias("tx"))

    def wallets(self, transactions: DataFrame) -> DataFrame:
        """(tx, wallet) of some transactions."""
        return self.of(transactions, "tx").select("tx", F.explode("members").alias("wallet"))

    def neighbors(self, wallets: DataFrame) -> DataFrame:
        """(wallet, neighbor), distinct: other wallets in the transactions of each of some wallets."""
        own = self.transactions(wallets)
        near = self.wallets(own.select("tx")).withColumnRenamed("wallet", "neighbor")
        return own.join(near, "tx").where("wallet <> neighbor").select("wallet", "neighbor").distinct()


def build(pairs: DataFrame, path: str, buckets: int, tx: str = "tx", wallet: str = "wallet", size: int = SIZE) -> Adjacency:
    """Writes both sides' lists of the distinct pairs; null transactions and wallets are left out. keyed.buckets_for() tells how many buckets suit the rows."""
    rows = Table(pairs.select(F.col(tx).alias("tx"), F.col(wallet).alias("wallet")).where("tx is not null and wallet is not null").distinct(), "pairs", rebalance=False)
    out = Adjacency(path, buckets)
    for key, member in (("wallet", "tx"), ("tx", "wallet")):
        out._side(key).create(cut(rows.df, member, key, size), order=(key, "part"))
    rows.drop()
    return out
