"""Columnar exchange: arrays of many small records travel as a few binary cells, one for each bucket of keys.

A batch of documents makes thousands of postings. Sent as rows they would cost a Java object each; here a
batch sends, for each bucket, cells that hold the postings' columns as raw arrays. Buckets are dealt by a hash
of the key, so all postings of a key meet in one bucket, and the number of buckets follows the size of the
input, so a bucket stays at some megabytes. Buckets in turn are dealt to parts, some for each task of an
exchange: a batch sends one row for each part, however many buckets there are, and rows are taken apart
into buckets where they arrive.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walletgraph.llm.words import mix

#: Input bytes for each bucket.
BUCKET_BYTES = 8 << 20
#: Size of a KeyFilter's bitmap at most, as a power of two; and at least, a piece.
FILTER_BITS, PIECE_BITS = 27, 15


def input_bytes(df: DataFrame) -> int:
    """The planner's estimate; where it has none, and so says exabytes, 64 GB."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 60 else 1 << 36


def bucket_count(df: DataFrame) -> int:
    """In proportion to the input; odd."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(input_bytes(df) // BUCKET_BYTES, (1 << 31) - 2)) | 1


def key_bucket(keys: np.ndarray, n: int) -> np.ndarray:
    return (mix(keys.view(np.uint64)) % np.uint64(n)).astype(np.int32)


def deal(bucket: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """(bucket, cell, cell ...) for each bucket that has records."""
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    found, first = np.unique(bucket[order], return_index=True)
    columns = [c[order] for c in columns]
    for b, lo, hi in zip(found.tolist(), first.tolist(), [*first[1:].tolist(), len(order)], strict=True):
        yield (b, *(c[lo:hi].tobytes() for c in columns))


def part_count(df: DataFrame) -> int:
    """Parts that buckets are dealt to: some for each task of an exchange, so that they lie evenly; odd."""
    return 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) | 1


def nest(bucket: np.ndarray, parts: int, **columns: np.ndarray | None) -> pa.RecordBatch:
    """(part, cells): for each part a list of its buckets' cells, (bucket, cell, cell ...); see nested().

    A row for each part that has records, however many buckets there are; columns may be left out as None."""
    order = np.lexsort((bucket, bucket % parts))
    bucket = bucket[order]
    first = runs(bucket)
    edges = np.r_[first, len(bucket)]
    cells = [pa.array(bucket[first])]
    for c in columns.values():
        if c is None:
            cells.append(pa.nulls(len(first), pa.binary()))
            continue
        c = np.ascontiguousarray(c[order])
        width = c.itemsize * (c.shape[1] if c.ndim > 1 else 1)
        cells.append(pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer((edges * width).astype(np.int32)), pa.py_buffer(c)]))
    part = (bucket[first] % parts).astype(np.int32)
    heads = runs(part)
    lists = pa.ListArray.from_arrays(pa.array(np.r_[heads, len(part)].astype(np.int32)), pa.StructArray.from_arrays(cells, ["bucket", *columns]))
    return pa.RecordBatch.from_arrays([pa.array(part[heads]), lists], ["part", "cells"])


def nest_rows(rows: list[tuple], parts: int, schema: pa.Schema) -> pa.RecordBatch:
    """The same from (bucket, cell, cell ...); buckets below 0 make a part -1 of their own, for what is read apart."""
    of = np.array([r[0] for r in rows], np.int64)
    of = np.where(of < 0, -1, of % parts)
    order = np.argsort(of, kind="stable")
    of, cells = of[order].astype(np.int32), record_batch([rows[i] for i in order], schema)
    heads = runs(of)
    lists = pa.ListArray.from_arrays(pa.array(np.r_[heads, len(of)].astype(np.int32)), pa.StructArray.from_arrays(cells.columns, schema.names))
    return pa.RecordBatch.from_arrays([pa.array(of[heads]), lists], ["part", "cells"])


def nest_schema(schema: pa.Schema) -> str:
    """What nest_rows() returns, for Spark."""
    return "part int, cells array<struct<bucket: int, " + ", ".join(f"{c}: binary" for c in schema.names[1:]) + ">>"


def nested(df: DataFrame) -> DataFrame:
    """(part, bucket, cell, cell ...) of what nest() made, exchanged by part; groupBy("part", "bucket") then needs no other exchange."""
    return df.repartition("part").select("part", F.inline("cells"))


def record_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cells = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cells, schema, strict=True)], schema=schema)


def gather(table: pa.Table, name: str, dtype) -> np.ndarray:
    """All arrays of a column of cells, one after the other."""
    cells = [c.as_buffer() for chunk in table[name].chunks for c in chunk if c.is_valid]
    return np.concatenate([np.frombuffer(c, dtype) for c in cells]) if cells else np.zeros(0, dtype)


def runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where each run of equal values starts."""
    return np.flatnonzero(np.r_[True, sorted_values[1:] != sorted_values[:-1]]) if len(sorted_values) else np.zeros(0, np.int64)


def filter_bits(keys: int) -> int:
    """Power of two of a bitmap for so many keys: eight places or more for each, as far as FILTER_BITS goes."""
    return min(FILTER_BITS, max(PIECE_BITS, (8 * keys).bit_length()))


class KeyFilter:
    """A bitmap of a set of 64-bit keys: it finds every key of the set, and few others unless it is full.

    Its size follows the number of keys up to 16 MB. Executors make it in pieces of 4 KB, which is what the driver gets.
    Callers must be right with false positives.
    """

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def empty(power: int) -> KeyFilter:
        return KeyFilter(np.zeros(1 << (power - 3), np.uint8))

    @staticmethod
    def of(df: DataFrame, name: str, kinds: int = 1, kind: str | None = None) -> list[KeyFilter]:
        """A filter for each kind from 0 on, in one pass over a written table after its count."""
        power = filter_bits(df.count())
        at = F.pmod(F.col(name), F.lit(1 << power).cast("long"))
        of = F.col(kind) if kind else F.lit(0)
        pieces = df.select(of.alias("kind"), F.shiftright(at, PIECE_BITS).alias("piece"), F.pmod(at, F.lit(1 << PIECE_BITS).cast("long")).alias("bit"))
        filters = [KeyFilter.empty(power) for _ in range(kinds)]
        for i, piece, own in pieces.groupBy("kind", "piece").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():
            filters[i].add(piece, own)
        return filters

    def add(self, piece: int, bits: bytes) -> None:
        """Bits of 2^15 keys that follow each other."""
        self.bits[piece << 12 : (piece + 1) << 12] |= np.frombuffer(bits, np.uint8)

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = keys.view(np.uint64) & np.uint64(8 * len(self.bits) - 1)
        return (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
