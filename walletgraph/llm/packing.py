"""Best-fit decreasing packing of tokenized documents into sequences of one length.

Pieces of one length are alike, so the packing is made for the histogram of lengths, which has at most
`capacity` rows however large the corpus is: for each length, longest first, a segment tree over the
remaining capacities finds the tightest open bins, and all bins of one remaining capacity are filled
at once as document after document would fill them. The result is a list of ranges (the r-th piece of a
length goes to such a bin at such a place). Pieces learn their rank among all pieces of their length from
counts by task, summed over the tasks before.

Defined cases: a null or empty text is one piece that holds the end id alone; rows that repeat a doc_id or
lack one are packed like any other; no documents make no pieces; very long texts are tokenized whole and cut into pieces;
of equally tight bins any is right; further columns, whatever their names, are not read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walletgraph.llm.tokens import IdEncoder, groups, kept
from walletgraph.shared import Table

CAPACITY, END_ID = 2048, 0
#: Lengths in one group when ranks are summed.
LENGTHS = 16
_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("task", pa.int32()), ("lengths", pa.int32()), ("rank", pa.int64())])
_COUNTS = pa.schema([("task", pa.int32()), ("lengths", pa.int32()), ("counts", pa.binary())])


class SegmentTree:
    """Open bins by remaining capacity; finds the smallest open capacity that is large enough."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.open = [False] * (2 * self.size)

    def put(self, remaining: int, is_open: bool) -> None:
        at = self.size + remaining
        self.open[at] = is_open
        while at > 1:
            at //= 2
            self.open[at] = self.open[2 * at] or self.open[2 * at + 1]

    def tightest(self, least: int) -> int | None:
        at = self.size + least
        if self.open[at]:
            return least
        while at > 1:
            if at % 2 == 0 and self.open[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.open[2 * at] else 2 * at + 1
                return at - self.size
            at //= 2
        return None


def best_fit(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Rows (length, first rank, first bin, pieces a bin, place in the bin), by length and rank."""
    tree, bins, used = SegmentTree(capacity), defaultdict(list), 0
    out: list[tuple[int, int, int, int, int]] = []

    def leave(remaining: int, first: int, many: int) -> None:
        if many and remaining:
            bins[remaining].append((first, many))
            tree.put(remaining, True)

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first = capacity, used
                many = -(-left // (capacity // length))
                used += many
            else:
                first, many = bins[room].pop()
                if not bins[room]:
                    tree.put(room, False)
            each = room // length
            full = min(many, left // each)
            rest = left - full * each if full < many else 0
            rest = min(rest, each)
            out.append((length, rank, first, each, capacity - room))
            leave(room - each * length, first, full)
            if rest:
                leave(room - rest * length, first + full, 1)
            leave(room, first + full + (rest > 0), many - full - (rest > 0))
            left -= full * each + rest
            rank += full * each + rest
    return np.array(out, np.int64).reshape(-1, 5)


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset."""

    def cut(batches):
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        with kept(("ids", path), lambda: IdEncoder(path)) as encoder:
            end, kind = np.array([end_id], f"<u{encoder.width}").tobytes(), f"<u{encoder.width}"
            for batch in batches:
                for at, texts in groups(batch["text"]):
                    rows = []
                    for doc, own in zip(batch["doc_id"][at : at + len(texts)].to_pylist(), encoder.encode(texts), strict=True):
                        ids = np.frombuffer(own + end, kind).astype("<u4")
                        for piece, start in enumerate(range(0, len(ids), capacity)):
                            part = ids[start : start + capacity]
                            n = len(part)
                            rows.append((doc, piece, start, n, zlib.crc32(part.tobytes()), task, n // LENGTHS, int(seen[n])))
                            seen[n] += 1
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PIECES, strict=True)], schema=_PIECES)
        yield pa.RecordBatch.from_arrays([pa.array([], f.type) for f in _PIECES], schema=_PIECES)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, lengths int, rank long"
    pieces = Table(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, schema), "pieces").df

    def before(table: pa.Table) -> pa.Table:
        """Of a group of lengths: for each task, pieces of each length in the tasks before it; the last row: of all."""
        task = table["task"].to_numpy()
        order = np.argsort(task, kind="stable")
        tasks, at = np.unique(task[order], return_inverse=True)
        counts = np.zeros((len(tasks) + 1, LENGTHS), np.int64)
        counts[at + 1, table["length"].to_numpy()[order] % LENGTHS] = table["n"].to_numpy()[order]
        sums = np.cumsum(counts, axis=0)
        return pa.table({"task": pa.array([*tasks.tolist(), -1], pa.int32()), "lengths": pa.array([table["lengths"][0].as_py()] * len(sums), pa.int32()), "counts": pa.array([x.tobytes() for x in sums], pa.binary())})

    counted = pieces.groupBy("task", "lengths", "length").agg(F.count("*").alias("n"))
    ranks = Table(counted.groupBy("lengths").applyInArrow(before, "task int, lengths int, counts binary"), "ranks").df
    totals = {r.lengths * LENGTHS + i: int(n) for r in ranks.where("task = -1").collect() for i, n in enumerate(np.frombuffer(r.counts, np.int64)) if n}
    plan = docs.sparkSession.sparkContext.broadcast(best_fit(totals, capacity))

    def place(batches):
        rows = plan.value
        key = rows[:, 0] << 44 | rows[:, 1] if len(rows) else np.zeros(0, np.int64)
        order = np.argsort(key, kind="stable")
        rows, key = rows[order], key[order]
        for batch in batches:
            if not batch.num_rows:
                continue
            length = batch["length"].to_numpy()
            base = np.frombuffer(b"".join(batch["counts"].to_pylist()), np.int64).reshape(-1, LENGTHS)
            rank = batch["rank"].to_numpy() + base[np.arange(len(length)), length % LENGTHS]
            row = rows[np.searchsorted(key, length << 44 | rank, side="right") - 1]
            nth = rank - row[:, 1]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(row[:, 2] + nth // row[:, 3]), pa.array(row[:, 4] + nth % row[:, 3] * length)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return pieces.join(ranks, ["task", "lengths"]).mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
