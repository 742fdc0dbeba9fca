"""Work tables in the folder that the driver and all executors share."""

from __future__ import annotations

import pickle
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; where none is set, a local one is made and set if all runs on this machine, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="walletgraph-")
        spark.sparkContext.setCheckpointDir(found)
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def run_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/walletgraph-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{run_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def drop_path(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def clean(spark: SparkSession) -> None:
    """Deletes all work tables of this run; for when no result that reads them is needed."""
    drop_path(spark, run_dir(spark))


def send(spark: SparkSession, value: object) -> Broadcast:
    """A broadcast that workers without this package can open with received(). The caller answers for its size."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(sent: Broadcast) -> object:
    return pickle.loads(sent.value)


#: Where this is set, Spark deletes a query's shuffle files as it ends; else they stay until the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """For writes: their rows are in files by then, nobody reads their exchanges again."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


class Table:
    """A DataFrame written to the shared folder and read again: its lineage is cut and any executor can be lost.

    Its shuffle files are gone once it is written. Rows are first rebalanced, so that many tasks' few rows make few files; not so with rebalance=False."""

    def __init__(self, df: DataFrame, name: str, rebalance: bool = True, compression: str = "snappy"):
        self.spark, self.path = df.sparkSession, new_path(df.sparkSession, name)
        with tidy(self.spark):
            (df.hint("rebalance") if rebalance else df).write.parquet(self.path, compression=compression)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        """To be called once nothing lazy reads the table any more."""
        drop_path(self.spark, self.path)
