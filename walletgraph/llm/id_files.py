"""Token ids in binary files: each document compressed alone, with a zstandard dictionary that all files share.

A file holds the documents of one range of doc_ids in ascending order: a header (magic, bytes an id, SHA-256
of the dictionary), the documents' frames, then an index (doc_ids, frame offsets, id counts), and at its
end where the index starts. A document is read alone by its index entry: one short read, one frame.
The dictionary is trained on serialized id arrays of a bounded sample; it changes sizes, never contents.

Tasks write under a name of their own attempt and move the file when it is whole, so a repeated task
replaces a file by an equal one. Files lie in the shared folder, by any file system that Arrow knows.

Defined cases: a null or empty text holds the end id alone; documents without doc_id come first; rows that
repeat a doc_id follow each other in the order of their texts, across files if they are many (equal rows
stay in one); no documents make files without frames; very long texts are one frame; further columns, whatever their
names, are not read.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from walletgraph.llm.buckets import input_bytes
from walletgraph.llm.tokens import IdEncoder, groups, kept
from walletgraph.shared import Table

END_ID = 1
#: Documents and bytes of each that the dictionary is trained on, and its size.
SAMPLE_DOCS, SAMPLE_BYTES, DICTIONARY_BYTES = 1000, 16 << 10, 64 << 10
#: Input bytes for each file.
FILE_BYTES = 32 << 20
#: Characters of texts that tell apart the ranges of rows with one doc_id.
RANGE_CHARS = 64
#: Files whose sums are taken together: of 2^24 files at most 2^12 such sums.
TOGETHER_SHIFT = 12
LEVEL = 3
MAGIC = b"IDSHARD1"
_HEAD, _TAIL = "<8sI32s", "<QQ8s"
_NO_ID = -(1 << 63)


def _train(samples: list[bytes]) -> bytes:
    """Empty if there is too little to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if len(samples) >= 16 else b""
    except zstandard.ZstdError:
        return b""


def _dictionary(data: bytes):
    return zstandard.ZstdCompressionDict(data) if data else None


def train(docs: DataFrame, path: str) -> bytes:
    """A dictionary from the documents of least hash; what is read of them is bounded."""
    ids = docs.select("doc_id").where("doc_id is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)

    def encode(batches):
        with kept(("ids", path), lambda: IdEncoder(path)) as encoder:
            for batch in batches:
                for _, texts in groups(batch["text"]):
                    yield pa.RecordBatch.from_arrays([pa.array([x[:SAMPLE_BYTES] for x in encoder.encode(texts)], pa.binary())], ["ids"])

    sample = docs.join(F.broadcast(ids.distinct()), "doc_id", "left_semi").select("text").mapInArrow(encode, "ids binary").limit(2 * SAMPLE_DOCS)
    return _train([x for x in sample.toArrow()["ids"].to_pylist() if x])


class Writer:
    def __init__(self, stream, width: int, dictionary: bytes):
        self.stream, self.at = stream, struct.calcsize(_HEAD)
        self.compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary)).compress
        self.docs, self.offsets, self.counts, self.width = [], [], [], width
        stream.write(struct.pack(_HEAD, MAGIC, width, hashlib.sha256(dictionary).digest()))

    def add(self, doc: int | None, ids: bytes) -> None:
        frame = self.compress(ids)
        self.stream.write(frame)
        self.docs.append(_NO_ID if doc is None else doc), self.offsets.append(self.at), self.counts.append(len(ids) // self.width)
        self.at += len(frame)

    def end(self) -> None:
        for x in (self.docs, [*self.offsets, self.at], self.counts):
            self.stream.write(np.array(x, "<i8").tobytes())
        self.stream.write(struct.pack(_TAIL, self.at, len(self.docs), MAGIC))


class Reader:
    """file: a seekable Arrow file."""

    def __init__(self, file, dictionary: bytes):
        self.file = file
        magic, self.width, digest = struct.unpack(_HEAD, file.read_at(struct.calcsize(_HEAD), 0))
        size = file.size()
        index, n, tail = struct.unpack(_TAIL, file.read_at(struct.calcsize(_TAIL), size - struct.calcsize(_TAIL)))
        if magic != MAGIC or tail != MAGIC:
            raise ValueError("not a file of ids, or not whole")
        if digest != hashlib.sha256(dictionary).digest():
            raise ValueError("the file was written with another dictionary")
        numbers = np.frombuffer(file.read_at(size - struct.calcsize(_TAIL) - index, index), "<i8")
        self.docs, self.offsets, self.counts = numbers[:n], numbers[n : 2 * n + 1], numbers[2 * n + 1 :]
        self.expand = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary)).decompress

    def _ids(self, frame: bytes, i: int) -> np.ndarray:
        return np.frombuffer(self.expand(frame, max_output_size=int(self.counts[i]) * self.width), f"<u{self.width}")

    def document(self, doc: int) -> list[np.ndarray]:
        """Ids of the rows of one doc_id, each by one short read."""
        lo, hi = np.searchsorted(self.docs, doc, side="left"), np.searchsorted(self.docs, doc, side="right")
        return [self._ids(self.file.read_at(int(self.offsets[i + 1] - self.offsets[i]), int(self.offsets[i])), i) for i in range(lo, hi)]

    def all(self, block: int = 8 << 20):
        """(index, ids) of all documents, read in blocks."""
        at, n = 0, len(self.docs)
        while at < n:
            to = max(at + 1, int(np.searchsorted(self.offsets, self.offsets[at] + block, side="right")) - 1)
            base = int(self.offsets[at])
            data = self.file.read_at(int(self.offsets[to]) - base, base)
            for i in range(at, to):
                yield i, self._ids(data[int(self.offsets[i]) - base : int(self.offsets[i + 1]) - base], i)
            at = to


def write(docs: DataFrame, path: str, folder: str, end_id: int = END_ID) -> tuple[DataFrame, bytes]:
    """Writes the files; (shard, file, n_docs, n_ids) of each, and the dictionary, which is written beside them."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dictionary = train(docs, path)
    system, place = pafs.FileSystem.from_uri(folder)
    system.create_dir(place, recursive=True)
    with system.open_output_stream(f"{place}/dictionary") as stream:
        stream.write(dictionary)
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(input_bytes(docs) // FILE_BYTES, 1 << 24))

    def run(batches):
        task = TaskContext.get()
        system, place = pafs.FileSystem.from_uri(folder)
        system.create_dir(place, recursive=True)
        name = f"{task.partitionId():06d}.ids"
        own = f"{place}/.{name}-{task.taskAttemptId()}"
        with system.open_output_stream(own) as stream, kept(("ids", path), lambda: IdEncoder(path)) as encoder:
            end = np.array([end_id], f"<u{encoder.width}").tobytes()
            writer = Writer(stream, encoder.width, dictionary)
            for batch in batches:
                for at, texts in groups(batch["text"]):
                    for doc, ids in zip(batch["doc_id"][at : at + len(texts)].to_pylist(), encoder.encode(texts), strict=True):
                        writer.add(doc, ids + end)
            writer.end()
        system.move(own, f"{place}/{name}")
        yield pa.RecordBatch.from_arrays([pa.array([task.partitionId()], pa.int32()), pa.array([name]), pa.array([len(writer.docs)], pa.int64()), pa.array([sum(writer.counts)], pa.int64())], ["shard", "file", "n_docs", "n_ids"])

    # By how texts start, too, so that the many rows of one id, or of none, are dealt out; whole texts are sorted.
    files = docs.repartitionByRange(n, F.col("doc_id"), F.substring("text", 1, RANGE_CHARS)).sortWithinPartitions("doc_id", "text").mapInArrow(run, "shard int, file string, n_docs long, n_ids long")
    return Table(files, "manifest").df, dictionary


def read(files: DataFrame, folder: str, dictionary: bytes) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids_crc32 of every document, from the files."""
    # Ids before a file: those of the runs of files before its own, and of the files before it in its run.
    run_of = F.shiftright("shard", TOGETHER_SHIFT)
    sums = files.groupBy(run_of.alias("together")).agg(F.sum("n_ids").alias("ids")).orderBy("together").collect()  # 2^12 rows at most
    starts, at = [], 0
    for row in sums:
        starts.append((row.together, at))
        at += row.ids
    first = files.sparkSession.createDataFrame(starts, "together int, first long")
    before = Window.partitionBy("together").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.withColumn("together", run_of).withColumn("inside", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).join(F.broadcast(first), "together").withColumn("start", F.col("first") + F.col("inside"))
    n = max(1, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def run(batches):
        system, place = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, start in zip(batch["file"].to_pylist(), batch["start"].to_pylist(), strict=True):
                with system.open_input_file(f"{place}/{name}") as file:
                    reader = Reader(file, dictionary)
                    crc = np.zeros(len(reader.docs), np.int64)
                    for i, ids in reader.all():
                        crc[i] = zlib.crc32(ids.astype("<u4").tobytes())
                    starts = start + np.r_[0, np.cumsum(reader.counts)][:-1] if len(crc) else crc
                    yield pa.RecordBatch.from_arrays([pa.array(reader.docs, mask=reader.docs == _NO_ID), pa.array(starts.astype(np.int64)), pa.array(reader.counts), pa.array(crc)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return placed.select("shard", "file", "start").repartition(n, "shard").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
