"""Tables laid out by key: rewritten only in the buckets that a change touches, or bucketed so that joins need no exchange."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from walletgraph.shared import Table, new_path
from walletgraph.sources import tables

#: Rows of a bucket that buckets_for() aims at: some hundred megabytes of a ledger's outputs.
BUCKET_ROWS = 4_000_000


def buckets_for(rows: int, each: int = BUCKET_ROWS) -> int:
    """A power of two, so that tables of different sizes have bucket counts that divide each other."""
    return 1 << max(0, (max(rows, 1) - 1).bit_length() - (each - 1).bit_length())


@dataclass(frozen=True)
class Keyed:
    """A Parquet table with a folder for each bucket of its keys. Keys are distinct, so buckets are even whatever the keys are; NULL is a key.

    The number of buckets is part of the folders' name: read with another number, the table is an error and not a wrong answer."""

    path: str
    keys: tuple[str, ...]
    buckets: int

    @property
    def column(self) -> str:
        return f"bucket_of_{self.buckets}"

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, order: tuple[str, ...] = ()) -> None:
        # Rows of a bucket meet in few tasks, so that it has few files; adaptive execution splits a large one.
        rows = rows.hint("rebalance", self.column)
        rows = rows.sortWithinPartitions(self.column, *order) if order else rows
        (rows.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(self.column).parquet(self.path))

    def create(self, rows: DataFrame, order: tuple[str, ...] = ()) -> None:
        """Files are sorted by `order`, where given, so that a filter on those columns leaves out row groups and pages."""
        rows.limit(0).write.mode("overwrite").parquet(f"{self.path}/{self.column}=0")  # the schema, if there are no rows
        self._write(rows.withColumn(self.column, self.bucket()), order)

    def stored(self, spark: SparkSession) -> DataFrame:
        """The rows with the number of their bucket, by which a filter leaves out folders."""
        found = spark.read.parquet(self.path)
        if self.column not in found.columns:
            raise ValueError(f"{self.path} is not laid out in {self.buckets} buckets")
        return found

    def read(self, spark: SparkSession) -> DataFrame:
        return self.stored(spark).drop(self.column)

    def rewrite(self, change: DataFrame, apply: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
        """Puts apply(rows, change) in place of the rows of the buckets that have a key of the change; returns how many those are.

        The change is written once, and so are the new rows before any old file goes: a job that is lost before the last step leaves the
        table as it was. The last step moves whole buckets in. If it is cut off, running the same rewrite again mends upserts and updates of the
        buckets that are there; the driver must not die within it."""
        spark = change.sparkSession
        own = Table(change.withColumn(self.column, self.bucket()), "change")
        touched = [r[0] for r in own.df.select(self.column).distinct().collect()]  # numbers of buckets, of which the table has a fixed count
        if not touched:
            own.drop()
            return 0
        old = self.stored(spark).where(F.col(self.column).isin(touched)).drop(self.column)
        new = Table(apply(old, own.df.drop(self.column)).withColumn(self.column, self.bucket()), "rewritten", rebalance=False)
        self._write(new.df)
        new.drop()
        own.drop()
        return len(touched)

    def upsert(self, new: DataFrame) -> int:
        return self.rewrite(new, lambda old, own: tables.upsert(old, own, list(self.keys)))

    def insert_ignore(self, new: DataFrame) -> int:
        return self.rewrite(new, lambda old, own: old.unionByName(tables.insert_ignore(old, own, list(self.keys))))

    def update_from(self, source: DataFrame, values: dict[str, Column]) -> int:
        """As tables.update_from(); values may use columns that only the source has."""
        return self.rewrite(source, lambda old, own: tables.update_from(old, own, list(self.keys), values))


def bucketed(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """The rows as a table bucketed and sorted by the keys, in the shared folder: joins and groups on all the keys need no exchange.

    Rows are exchanged once, a task to a bucket, so there is one file for each bucket and not one for each task and bucket.
    Rows that lack a key all meet in one bucket: leave them out where they may be many."""
    spark, name = df.sparkSession, f"walletgraph_{uuid.uuid4().hex[:12]}"
    writer = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
    writer.option("path", new_path(spark, "bucketed")).format("parquet").saveAsTable(name)
    return spark.table(name)


def outpoint_tables(outputs: DataFrame, inputs: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame]:
    """Outputs by (txid, vout_n) and inputs that spend by (vin_txid, vin_vout), alike in buckets: every later join of outpoints is local to a bucket."""
    spends = inputs.where("vin_txid is not null")
    kinds = outputs.schema["txid"].dataType, outputs.schema["vout_n"].dataType
    spends = spends.withColumn("vin_txid", F.col("vin_txid").cast(kinds[0])).withColumn("vin_vout", F.col("vin_vout").cast(kinds[1]))
    return bucketed(outputs, ["txid", "vout_n"], buckets), bucketed(spends, ["vin_txid", "vin_vout"], buckets)
