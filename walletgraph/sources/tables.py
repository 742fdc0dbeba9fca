"""Reading and writing the ledger's tables, and the inserts and updates of a database as DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, kind: StructType) -> DataFrame:
    """With a header; an empty field is NULL."""
    return spark.read.schema(kind).csv(path, header=True, enforceSchema=False)


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    """With a header; _SUCCESS marks a whole folder."""
    df.write.mode(mode).csv(path, header=True)


def write_chunks(df: DataFrame, path: str, chunk: str = "chunk", kind: str = "parquet") -> None:
    """A folder for each chunk, of Parquet or CSV with a header; chunks that are there already are replaced.

    Rows meet by chunk before they are written, so a chunk has one file, or a few if it is large, not one from every task.
    _SUCCESS goes before the first chunk is touched and is there again once all are whole: replacing some chunks, Spark sets none."""
    options = {"header": True} if kind == "csv" else {}
    system, mark = _mark(df.sparkSession, path)
    system.delete(mark, False)
    df.hint("rebalance", F.col(chunk)).write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(chunk).format(kind).options(**options).save(path)
    system.create(mark, True).close()


def read_chunk(spark: SparkSession, path: str, chunk: int, kind: StructType, name: str = "chunk") -> DataFrame:
    """One chunk of CSV."""
    return read_csv(spark, f"{path}/{name}={chunk}", kind)


def _mark(spark: SparkSession, path: str):
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()), mark


def is_whole(spark: SparkSession, path: str) -> bool:
    system, mark = _mark(spark, path)
    return system.exists(mark)


def fit_columns(df: DataFrame, kind: StructType) -> DataFrame:
    """The schema's columns and no others; missing ones are NULL."""
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in kind))


def concat(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda x, y: x & y, (a[k].eqNullSafe(b[k]) for k in keys))


def insert_ignore(target: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows whose key the target lacks, each key once; to be appended to it."""
    own = new.select(*target.columns).dropDuplicates(keys)
    return own.join(target.select(*keys), _same(own, target, keys), "left_anti")


def upsert(target: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The target with new rows in place of those that share their key; of new rows with one key, the greatest stays."""
    rest = [c for c in target.columns if c not in keys]
    own = new.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("r")).select(*keys, *(F.col(f"r.{c}").alias(c) for c in rest)) if rest else new.select(*keys).distinct()
    return target.join(own.select(*keys), _same(target, own, keys), "left_anti").unionByName(own.select(*target.columns))


def update_from(target: DataFrame, source: DataFrame, keys: list[str], values: dict[str, Column]) -> DataFrame:
    """The target where rows whose key the source has take `values`, which may use the source's columns.

    The source must hold each key once."""
    marked = target.join(source.withColumn("__hit", F.lit(True)), keys, "left")
    return marked.select(*(F.when(F.col("__hit"), values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in target.columns))


def create_if_missing(df: DataFrame, path: str) -> None:
    df.write.mode("ignore").parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)
