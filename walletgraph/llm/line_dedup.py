"""Lines that many documents share, dropped from all of them but the last.

A line's key is the line without white space at its ends, A-Z lower-cased; equal keys are equal 128-bit hashes. Each
batch sends the keys of its documents, of one key `least_docs` documents at most, those with the largest ids: enough
to tell whether so many have it and which is the largest, however many rows repeat a doc_id. In each shard the
distinct hashes of lines that two documents have get a minimal perfect hash, which indexes plain arrays: a
fingerprint (the hash's other half), the number of documents up to `least_docs`, and the largest doc_id.

Documents probe the arrays:

* Up to `most` bytes of them are broadcast, and lines never leave their task.
* More stay where they are, and the lines' hashes are sent to their shards, those of a shard with very many to several
  copies of it by document; documents then get back the hashes that they lose. A line that a third of all documents
  have is so probed by as many tasks as its postings ask for.

Defined cases: null and empty texts are one empty line; very long texts are read whole, in pieces; a line has no key if
that is shorter than `least_chars` code points; rows with a null doc_id are counted nowhere and stay whole; rows that
repeat a doc_id count as one document, and all of the largest doc_id keep their lines; equal lines of one document
go or stay together; a text that loses all lines is ''; an empty table gives no rows; further columns, whatever
their names, are carried along by remove() (n_chars is kept right) and not read by digests().
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walletgraph.llm.buckets import bucket_count, gather, input_bytes, key_bucket, nest, nested, part_count, runs
from walletgraph.llm.passages import fresh
from walletgraph.llm.perfect_hash import PerfectHash
from walletgraph.llm.words import mix
from walletgraph.shared import Table, received, send

LEAST_CHARS, LEAST_DOCS = 40, 5
#: Bytes of arrays that are broadcast; a text's bytes that are split at a time; postings that a task gathers before it sends them.
MOST, PIECE, FLUSH = 64 << 20, 1 << 20, 1 << 18
#: Postings that one copy of a shard gets, more in very large inputs: keys have 40 bytes, so 2^24 / 40 shards at most have copies.
LOAD, LOAD_SHIFT = 1 << 20, 24


def keys(data: bytes, least: int) -> Iterator[tuple[int, bytes]]:
    """Number and hash of each line that has a key."""
    at = nth = 0
    while at <= len(data):
        cut = data.find(b"\n", at + PIECE)
        cut = len(data) if cut < 0 else cut
        lines = data[at:cut].lower().split(b"\n")
        for i, line in enumerate(lines, nth):
            if len(line) >= least:
                line = line.strip()
                if len(line) >= 4 * least or len(line) >= least and len(line.decode()) >= least:
                    yield i, xxhash.xxh3_128_digest(line)
        nth += len(lines)
        at = cut + 1


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    for x in batch["text"]:
        yield x.as_buffer().to_pybytes() if x.is_valid else b""


def _halves(hashes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(hashes), np.uint64).reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def _heads(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Where each key of sorted postings starts."""
    return np.flatnonzero(np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])][: len(high)])


def _distinct(high: np.ndarray, low: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """In order, each posting once."""
    order = np.lexsort((doc, low, high))
    high, low, doc = high[order], low[order], doc[order]
    new = np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1]) | (doc[1:] != doc[:-1])][: len(high)]
    return high[new], low[new], doc[new]


def _postings(batches, least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Distinct (high, low, document) of some documents at a time."""
    hashes, docs = [], []

    def out():
        rows = _distinct(*_halves(hashes), np.array(docs, np.int64))
        hashes.clear(), docs.clear()
        return rows

    for batch in batches:
        for doc, text in zip(batch["doc_id"].to_pylist(), _texts(batch), strict=True):
            for _, own in keys(text, least):
                hashes.append(own), docs.append(doc)
                if len(hashes) >= FLUSH:
                    yield out()
    if hashes:
        yield out()


def _latest(high: np.ndarray, low: np.ndarray, doc: np.ndarray, most: int) -> np.ndarray:
    """Of distinct postings in order, those of the `most` largest documents of each key."""
    first = _heads(high, low)
    many = np.diff(np.r_[first, len(high)])
    return np.flatnonzero(np.repeat(first + many, many) - np.arange(len(high)) <= most)


def index(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> tuple[Table, int]:
    """Written arrays of each shard, and the number of shards: (bucket, n, load, hash, prints, counts, largest)."""
    own = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n, parts = bucket_count(own), part_count(own)

    def post(batches):
        for high, low, doc in _postings(batches, least_chars):
            load = np.ones(len(doc), np.int64)
            stay = _latest(high, low, doc, least_docs)
            first = np.r_[0, stay[:-1] + 1] if len(stay) else stay
            load = np.add.reduceat(load, first) if len(stay) else load[:0]  # what was left out is counted with the next one that stays
            yield nest(key_bucket(high[stay], n), parts, high=high[stay], low=low[stay], docs=doc[stay], load=load)

    def meet(table: pa.Table) -> pa.Table:
        high, low, doc = _distinct(*(gather(table, c, t) for c, t in (("high", np.uint64), ("low", np.uint64), ("docs", np.int64))))
        first = _heads(high, low)
        many = np.diff(np.r_[first, len(high)])
        last, first, many = (first + many - 1)[many > 1], first[many > 1], np.minimum(many[many > 1], least_docs)
        machine = PerfectHash.of(high[first], low[first])
        at = np.argsort(machine.find(high[first], low[first]))
        count = many[at].astype(np.uint16 if least_docs > 255 else np.uint8)
        return pa.table({"bucket": table["bucket"][:1], "n": [len(first)], "load": [int(gather(table, "load", np.int64).sum())], "hash": [machine.to_bytes()], "prints": [low[first[at]].tobytes()], "counts": [count.tobytes()], "largest": [doc[last[at]].tobytes()]})

    posted = nested(own.mapInArrow(post, "part int, cells array<struct<bucket: int, high: binary, low: binary, docs: binary, load: binary>>"))
    return Table(posted.groupBy("part", "bucket").applyInArrow(meet, _SHARD), "lines", rebalance=False), n


_SHARD = "bucket int, n long, load long, hash binary, prints binary, counts binary, largest binary"


class Shard:
    def __init__(self, hash: bytes, prints: bytes, counts: bytes, largest: bytes):
        self.hash, self.prints, self.largest = PerfectHash.from_bytes(hash), np.frombuffer(prints, np.uint64), np.frombuffer(largest, np.int64)
        self.counts = np.frombuffer(counts, np.uint8 if len(counts) == len(self.prints) else np.uint16)

    def loses(self, high: np.ndarray, low: np.ndarray, doc: np.ndarray, least_docs: int) -> np.ndarray:
        """Whether the document loses the line."""
        slot = self.hash.find(high, low)
        at = np.flatnonzero(slot >= 0)
        at = at[self.prints[slot[at]] == low[at]]
        at = at[(self.counts[slot[at]] >= least_docs) & (self.largest[slot[at]] != doc[at])]
        out = np.zeros(len(high), bool)
        out[at] = True
        return out


def _gone(batch: pa.RecordBatch, ids: str, shards: list[Shard | None], least_chars: int, least_docs: int) -> dict[int, list[int]]:
    """By row the numbers of the lines that it loses, from arrays at hand."""
    row, line, hashes = [], [], []
    for i, (doc, text) in enumerate(zip(batch[ids], _texts(batch), strict=True)):
        for nth, own in keys(text, least_chars) if doc.is_valid else ():
            row.append(i), line.append(nth), hashes.append(own)
    if not row:
        return {}
    high, low = _halves(hashes)
    doc = batch[ids].fill_null(0).to_numpy(zero_copy_only=False)[row]
    bucket, lost = key_bucket(high, len(shards)), np.zeros(len(row), bool)
    order = np.argsort(bucket, kind="stable")
    for some in np.split(order, runs(bucket[order])[1:]):
        shard = shards[bucket[some[0]]]
        if shard:
            lost[some] = shard.loses(high[some], low[some], doc[some], least_docs)
    out: dict[int, list[int]] = {}
    for i in np.flatnonzero(lost).tolist():
        out.setdefault(row[i], []).append(line[i])
    return out


def _answers(docs: DataFrame, shards: DataFrame, n: int, least_chars: int, least_docs: int) -> DataFrame:
    """(doc_id, lost): hashes of the lines that a document loses, from arrays that stay in their shards."""
    own = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    load, parts = max(LOAD, input_bytes(own) >> LOAD_SHIFT), part_count(own)
    copies = F.ceil(F.greatest(F.col("load"), F.lit(1)) / load).cast("int")
    held = shards.where("n > 0").withColumn("copies", copies)
    some = held.where("copies > 1").select("bucket", "copies").toArrow()  # 2^24 / 40 rows at most
    split = send(docs.sparkSession, (some["bucket"].to_numpy(), some["copies"].to_numpy()))

    def post(batches):
        hot, many = received(split)
        order = np.argsort(hot)
        hot, many = hot[order], many[order]
        for high, low, doc in _postings(batches, least_chars):
            bucket = key_bucket(high, n)
            copy = np.zeros(len(bucket), np.int64)
            if len(hot):
                at = np.minimum(np.searchsorted(hot, bucket), len(hot) - 1)
                of = np.where(hot[at] == bucket, many[at], 1).astype(np.uint64)
                copy = (mix(doc.view(np.uint64)) % of).astype(np.int64)
            yield nest(bucket.astype(np.int64) | copy << 32, parts, high=high, low=low, docs=doc, hash=None, counts=None)

    kind = "part int, cells array<struct<bucket: long, high: binary, low: binary, docs: binary, hash: binary, counts: binary>>"
    asked = own.mapInArrow(post, kind)
    copy = held.select(F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), "*")
    bucket = F.col("bucket").cast("long").bitwiseOR(F.shiftleft(F.col("copy").cast("long"), 32))
    cell = F.struct(bucket.alias("bucket"), F.lit(None).cast("binary").alias("high"), F.col("prints").alias("low"), F.col("largest").alias("docs"), "hash", "counts")
    kept = copy.select(F.pmod(bucket, F.lit(parts)).cast("int").alias("part"), F.array(cell).alias("cells"))

    def probe(table: pa.Table) -> pa.Table:
        holds = table["hash"].is_valid()
        shard, table = table.filter(holds), table.filter(pc.invert(holds))
        if not shard.num_rows or not table.num_rows:
            return pa.table({"doc_id": pa.array([], pa.int64()), "lost": pa.array([], pa.binary())})
        x = shard.slice(0, 1).to_pylist()[0]
        high, low, doc = gather(table, "high", np.uint64), gather(table, "low", np.uint64), gather(table, "docs", np.int64)
        lost = Shard(x["hash"], x["low"], x["counts"], x["docs"]).loses(high, low, doc, least_docs)
        order = np.flatnonzero(lost)
        order = order[np.argsort(doc[order], kind="stable")]
        doc, both = doc[order], np.stack([high[order], low[order]], 1)
        first = runs(doc)
        cells = [both[lo:hi].tobytes() for lo, hi in zip(first.tolist(), np.r_[first, len(doc)][1:].tolist(), strict=True)]
        return pa.table({"doc_id": pa.array(doc[first]), "lost": pa.array(cells, pa.binary())})

    found = nested(asked.unionByName(kept)).groupBy("part", "bucket").applyInArrow(probe, "doc_id long, lost binary")
    return found.groupBy("doc_id").agg(F.collect_list("lost").alias("lost"))  # as many as the document has lines


def _without(docs: DataFrame, finish: Callable, schema, least_chars: int, least_docs: int, most: int) -> DataFrame:
    """finish(rows, gone) over Arrow batches of the documents' columns; gone: by row the numbers of lines to drop."""
    names, spark = docs.columns, docs.sparkSession
    ids, lost = fresh(names, "own_id"), fresh(names, "own_lost")
    shards, n = index(docs, least_chars, least_docs)
    keyed = docs.withColumn(ids, F.col("doc_id").cast("long"))
    bytes_held = shards.df.select(F.sum(F.length("hash") + F.length("prints") + F.length("counts") + F.length("largest"))).first()[0] or 0
    plain = lambda batch: pa.RecordBatch.from_arrays([batch[c] for c in names], names)
    if bytes_held <= most:
        rows = shards.df.where("n > 0").select("bucket", "hash", "prints", "counts", "largest").toArrow().to_pylist()
        sent = send(spark, (n, {r.pop("bucket"): r for r in rows}))

        def here(batches):
            many, arrays = received(sent)
            own = [Shard(**arrays[b]) if b in arrays else None for b in range(many)]
            for batch in batches:
                yield from finish(plain(batch), _gone(batch, ids, own, least_chars, least_docs))

        return keyed.mapInArrow(here, schema)
    answers = Table(_answers(docs, shards.df, n, least_chars, least_docs).withColumnsRenamed({"doc_id": ids, "lost": lost}), "lost")

    def apply(batches):
        for batch in batches:
            gone: dict[int, list[int]] = {}
            for i, (cells, text) in enumerate(zip(batch[lost], _texts(batch), strict=True)):
                if cells.is_valid:
                    known = {c[at : at + 16] for c in cells.as_py() for at in range(0, len(c), 16)}
                    gone[i] = [nth for nth, own in keys(text, least_chars) if own in known]
            yield from finish(plain(batch), gone)

    some = keyed.where(F.col(ids).isNotNull()).join(answers.df, ids, "left")
    whole = keyed.where(F.col(ids).isNull()).withColumn(lost, F.lit(None).cast("array<binary>"))
    return some.unionByName(whole).select(*names, lost).mapInArrow(apply, schema)


def _kept(text: str, gone: list[int]) -> tuple[str, int]:
    """The text without some lines, and how many it had."""
    lines = text.split("\n")
    drop = set(gone)
    return "\n".join(x for i, x in enumerate(lines) if i not in drop) if drop else text, len(lines)


def digests(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS, most: int = MOST) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_sha256 (of the kept lines joined by a newline) of every document."""

    def finish(rows: pa.RecordBatch, gone: dict[int, list[int]]):
        many, shas = [], []
        for i, text in enumerate(rows["text"]):
            kept, lines = _kept(text.as_py() or "", gone.get(i, []))
            many.append(lines), shas.append(hashlib.sha256(kept.encode()).hexdigest())
        yield pa.RecordBatch.from_arrays([rows["doc_id"], pa.array(many, pa.int64()), pa.array([len(gone.get(i, ())) for i in range(len(many))], pa.int64()), pa.array(shas, pa.string())], ["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _without(own, finish, "doc_id long, n_lines long, n_dropped long, kept_sha256 string", least_chars, least_docs, most)


def remove(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS, most: int = MOST) -> DataFrame:
    """The documents, all columns and rows kept, without such lines in text; n_chars, where there is such a column, follows it."""
    names = docs.columns

    def finish(rows: pa.RecordBatch, gone: dict[int, list[int]]):
        if gone := {i: x for i, x in gone.items() if x}:
            texts = rows["text"].to_pylist()
            for i, own in gone.items():
                texts[i] = _kept(texts[i], own)[0]
            new = {"text": pa.array(texts, rows["text"].type)}
            if "n_chars" in names:
                sizes = rows["n_chars"].to_pylist()
                for i in gone:
                    sizes[i] = len(texts[i])
                new["n_chars"] = pa.array(sizes, rows["n_chars"].type)
            rows = pa.RecordBatch.from_arrays([new.get(c, rows[c]) for c in names], names)
        yield rows

    return _without(docs, finish, docs.schema, least_chars, least_docs, most)
