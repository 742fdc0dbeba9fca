"""What both ways to find repeated passages share: segments of documents around chosen phrases, and cutting.

In each window of `size` words one phrase of `k` words is chosen, the one with the least hash, the leftmost of
equal ones: equal windows choose alike. Consecutive windows with one choice make a segment: the words from the
first window's start to the last one's end, and where in it the phrase stands. Segments whose phrase two
documents choose go to buckets of their phrase, where a matcher says which windows also start in a document
with a smaller doc_id. So every pair of equal windows meets, in one bucket, with all their words.

Phrases that very many documents have are chosen only in windows that have no other (as in weighted
minimisers): a passage that a third of all documents share then has segments of its own words only, which
are alike, and the windows on its edges are dealt by the words beside it. Each batch sends alike segments
once, with their smallest doc_id: those of its other documents are settled at once.

Matchers return, for each segment, a mask of the offsets of its phrase in its repeated windows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walletgraph.llm.buckets import KeyFilter, bucket_count, deal, gather, input_bytes, key_bucket, nest_rows, nest_schema, nested, part_count, runs
from walletgraph.llm.words import SPACED, Hasher, mix, sliding_min, within
from walletgraph.shared import Table

#: Words in a window, and in a phrase.
SIZE, PHRASE = 50, 10
#: A phrase of so many documents is chosen only for want of another; at most 4 M phrases are, whatever the input.
HOT, HOT_SHIFT = 4096, 29
#: Times that such phrases are looked for; what is left after that costs time only.
ROUNDS = 4
#: Phrases, and words, that a task gathers before it sends them.
FLUSH, FLUSH_WORDS = 1 << 20, 1 << 21
_BITS = 24


@dataclass
class Segments:
    """Of one group of documents, an entry a segment: index of the document, phrase, where it stands in the document, first and last window, hash of all words."""

    doc: np.ndarray
    key: np.ndarray
    at: np.ndarray
    place: np.ndarray
    first: np.ndarray
    last: np.ndarray

    def take(self, which: np.ndarray) -> Segments:
        return Segments(*(getattr(self, f.name)[which] for f in fields(self)))


class Hot:
    """A set of phrases, asked for by many at a time."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys)
        self.some = np.zeros(1 << 20, bool)
        self.some[(self.keys & np.uint64(0xFFFFF)).astype(np.int64)] = True

    def has(self, keys: np.ndarray) -> np.ndarray:
        out = self.some[(keys & np.uint64(0xFFFFF)).astype(np.int64)] if len(self.keys) else np.zeros(len(keys), bool)
        at = np.flatnonzero(out)
        near = np.minimum(np.searchsorted(self.keys, keys[at]), len(self.keys) - 1)
        out[at] = self.keys[near] == keys[at] if len(at) else False
        return out


def choose(keys: np.ndarray, width: int, hot: Hot) -> np.ndarray:
    """Where each `width` consecutive phrases have the one that is chosen."""
    n, step = len(keys) - width + 1, 1 << _BITS - 1
    low, out = np.uint64((1 << _BITS) - 1), np.zeros(max(n, 0), np.int64)
    for lo in range(0, n, step):
        own = keys[lo : min(n, lo + step) + width - 1]
        order = own >> np.uint64(_BITS + 1) << np.uint64(_BITS) | hot.has(own).astype(np.uint64) << np.uint64(63) | np.arange(len(own), dtype=np.uint64)
        out[lo : lo + step] = lo + (sliding_min(order, width) & low).astype(np.int64)
    return out


def segments(hasher: Hasher, counts: np.ndarray, hashes: np.ndarray, size: int, k: int, hot: Hot) -> tuple[Segments, np.ndarray]:
    """Of consecutive documents' words: their segments, and the phrase at each word."""
    ok = within(counts, size)
    keys = hasher.grams(hashes, k)
    start = np.flatnonzero(ok)
    if not len(start):
        none = np.zeros(0, np.int64)
        return Segments(none, none.view(np.uint64), none, none, none, none), keys
    place = choose(keys, size - k + 1, hot)[start]
    head = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)])
    tail = np.r_[head[1:], len(start)] - 1
    place, first, last = place[head], start[head], start[tail]
    ends = np.cumsum(counts)
    doc = np.searchsorted(ends, first, side="right")
    return Segments(doc, keys[place], place - (ends[doc] - counts[doc]), place, first, last), keys


def spread(first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """first, first + 1 ... of each entry, `many` of them, one entry after the other."""
    return np.repeat(first - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))


_SEEN = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("docs", pa.binary()), ("low", pa.binary()), ("high", pa.binary())])


def _seen(own: DataFrame, n: int, size: int, k: int, hot, least: int, around=None) -> DataFrame:
    """(kind, key): 0 for phrases that two documents choose, 1 for those of `least` documents and more.

    around: phrases; instead of the chosen ones all in segments around these count, if a batch has them twice."""
    parts = part_count(own)

    def send(batches):
        hasher, known, held, ids = Hasher(SPACED), Hot(hot.value), [], []
        near = None if around is None else Hot(around.value)

        def out():
            key, doc = np.concatenate(held), np.concatenate(ids)
            held.clear(), ids.clear()
            order = np.lexsort((doc, key))
            key, doc = key[order], doc[order]
            new = np.r_[True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])][: len(key)]
            key, doc = key[new], doc[new]
            first = runs(key)
            many = np.diff(np.r_[first, len(key)])
            low, high, key = doc[first], doc[first + many - 1], key[first]
            if near is not None:
                key, many, low, high = (x[many > 1] for x in (key, many, low, high))
            return nest_rows(list(deal(key_bucket(key, n), key, many, low, high)), parts, _SEEN)

        for batch in batches:
            doc_ids = batch["doc_id"].to_numpy(zero_copy_only=False)
            for at, counts, hashes in hasher.words(batch["text"]):
                own, keys = segments(hasher, counts, hashes, size, k, known)
                if near is None:
                    key, doc = own.key, own.doc
                else:
                    own = own.take(near.has(own.key))
                    many = own.last - own.first + size - k + 1
                    key, doc = keys[spread(own.first, many)], np.repeat(own.doc, many)
                held.append(key), ids.append(doc_ids[at + doc])
                if sum(map(len, held)) > FLUSH:
                    yield out()
        if held:
            yield out()

    def meet(table: pa.Table) -> pa.Table:
        key, many, low, high = (gather(table, c, t) for c, t in (("keys", np.uint64), ("docs", np.int64), ("low", np.int64), ("high", np.int64)))
        order = np.argsort(key, kind="stable")
        key, first = key[order], runs(key[order])
        if not len(first):
            return pa.table({"kind": pa.array([], pa.int32()), "key": pa.array([], pa.int64())})
        twice = np.minimum.reduceat(low[order], first) != np.maximum.reduceat(high[order], first)
        often = np.add.reduceat(many[order], first) >= least
        key = key[first].view(np.int64)
        return pa.table({"kind": pa.array(np.repeat([0, 1], [twice.sum(), often.sum()]), pa.int32()), "key": pa.array(np.r_[key[twice], key[often]])})

    return nested(own.mapInArrow(send, nest_schema(_SEEN))).groupBy("part", "bucket").applyInArrow(meet, "kind int, key long")


_PARTS = pa.schema([("bucket", pa.int32()), *((c, pa.binary()) for c in ("docs", "offsets", "lengths", "words", "of", "prints", "at", "settled"))])


@dataclass
class Context:
    """Alike segments as one entry: smallest doc_id, words before the phrase, number of words, and all words, one entry after the other."""

    doc: np.ndarray
    offset: np.ndarray
    length: np.ndarray
    words: np.ndarray

    @property
    def start(self) -> np.ndarray:
        return np.cumsum(self.length) - self.length

    def take(self, which: np.ndarray) -> Context:
        return Context(self.doc[which], self.offset[which], self.length[which], self.words[spread(self.start[which], self.length[which])])


def _sent(own: DataFrame, n: int, size: int, k: int, hot, recurring) -> DataFrame:
    """Segments whose phrase recurs, by bucket of the phrase; settled: repeated ones of this batch as (doc, print, at, mask)."""
    parts = part_count(own)

    def send(batches):
        hasher, chosen, known, held = Hasher(SPACED), Hot(hot.value), KeyFilter(recurring.value), []

        def out():
            key, print_, at, doc, offset, length, digest, words = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            if not len(key):
                return nest_rows([], parts, _PARTS)
            begin = np.cumsum(length) - length
            bucket = key_bucket(key, n)
            order = np.lexsort((doc, digest, bucket))
            head = np.flatnonzero(np.r_[True, (digest[order][1:] != digest[order][:-1]) | (bucket[order][1:] != bucket[order][:-1])])
            many = np.diff(np.r_[head, len(order)])
            later = doc[order] > np.repeat(doc[order[head]], many)
            gone = order[later]
            windows = length[gone] - size + 1
            mask = (np.uint64(1) << windows.astype(np.uint64)) - np.uint64(1) << (offset[gone] - windows + 1).astype(np.uint64)
            settled = np.stack([doc[gone], print_[gone], at[gone], mask.view(np.int64)], 1)
            own, of = order[~later], np.repeat(np.arange(len(head)), many)[~later]
            heads = order[head]
            found, first = np.unique(bucket[heads], return_index=True)
            inner = np.searchsorted(of, np.r_[first, len(heads)])
            rows = []
            for i, (b, lo, hi) in enumerate(zip(found.tolist(), first.tolist(), [*first[1:].tolist(), len(heads)], strict=True)):
                c, o = heads[lo:hi], slice(inner[i], inner[i + 1])
                rows.append((b, doc[c].tobytes(), offset[c].astype(np.int32).tobytes(), length[c].astype(np.int32).tobytes(), words[spread(begin[c], length[c])].tobytes(), (of[o] - lo).astype(np.int32).tobytes(), print_[own[o]].tobytes(), at[own[o]].tobytes(), b""))
            if len(settled):
                rows.append((int(mix(digest[gone[:1]])[0] % np.uint64(n)), *[b""] * 7, settled.tobytes()))
            return nest_rows(rows, parts, _PARTS)

        total = 0
        for batch in batches:
            ids, prints = batch["doc_id"].to_numpy(zero_copy_only=False), batch["print"].to_numpy(zero_copy_only=False)
            once = np.unique(np.stack([ids, prints], 1), axis=0, return_index=True)[1] if len(ids) else np.zeros(0, np.int64)
            for lo, counts, hashes in hasher.words(batch["text"].take(pa.array(once))):
                x = segments(hasher, counts, hashes, size, k, chosen)[0]
                x = x.take(known.has(x.key))
                row, length, offset = once[lo + x.doc], x.last - x.first + size, x.place - x.first
                digest = mix(hasher.spans(hashes, x.first, x.first + length) + offset.astype(np.uint64))
                held.append((x.key, prints[row], x.at, ids[row], offset, length, digest, hashes[spread(x.first, length)]))
                total += len(held[-1][-1])
                if total > FLUSH_WORDS:
                    yield out()
                    total = 0
        if held:
            yield out()

    return nested(own.mapInArrow(send, nest_schema(_PARTS)))


def _groups(context: Context, keys: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Entries in groups of whole phrases that two documents have, of about `most` words."""
    order = np.lexsort((context.doc, keys))
    first = runs(keys[order])
    if not len(first):
        return
    many = np.diff(np.r_[first, len(order)])
    two = context.doc[order][first] != context.doc[order][first + many - 1]
    order, first, many = order[np.repeat(two, many)], first[two], many[two]
    if not len(first):
        return
    ends = np.cumsum(many)
    size = np.cumsum(context.length[order])[ends - 1]
    lo = 0
    while lo < len(ends):
        base = size[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(size, base + most, side="right")))
        yield order[ends[lo - 1] if lo else 0 : ends[hi - 1]]
        lo = hi


def found(docs: DataFrame, match: Callable[[Context, int, int], np.ndarray], most: int, size: int = SIZE, k: int = PHRASE) -> DataFrame:
    """(doc_id, print, at, mask): windows that also start in a document with a smaller id, by the phrase's place and its offsets in them.

    docs: (doc_id, text, print). match: masks of a context's entries; it gets about `most` words at a time."""
    k = min(k, size)
    if size - k >= 63:
        raise ValueError("the phrase is too short for so long a window")
    spark, own = docs.sparkSession, docs.where("doc_id is not null")
    n, least = bucket_count(own), max(HOT, input_bytes(own) >> HOT_SHIFT)
    send = spark.sparkContext.broadcast
    hot = np.zeros(0, np.uint64)
    for turn in range(ROUNDS):
        sent = send(hot)
        seen = Table(_seen(own, n, size, k, sent, least), "phrases")
        new = np.setdiff1d(_keys(seen.df), hot)
        if not len(new) or turn == ROUNDS - 1:
            break
        seen.drop()
        hot = np.union1d(np.r_[hot, new], _keys(_seen(own, n, size, k, sent, least, send(new))))
    recurring = send(KeyFilter.of(seen.df.where("kind = 0"), "key")[0].bits)
    seen.drop()

    def meet(table: pa.Table) -> pa.Table:
        context = Context(gather(table, "docs", np.int64), gather(table, "offsets", np.int32).astype(np.int64), gather(table, "lengths", np.int32).astype(np.int64), gather(table, "words", np.uint64))
        entries = np.array([len(x.as_buffer()) // 8 for x in table["docs"]], np.int64)
        places = np.array([len(x.as_buffer()) // 8 for x in table["prints"]], np.int64)
        of = gather(table, "of", np.int32) + np.repeat(np.cumsum(entries) - entries, places)
        mask = np.zeros(len(context.doc), np.uint64)
        hasher = Hasher(SPACED)
        place = context.start + context.offset
        keys = hasher.spans(context.words, place, place + k)
        for which in _groups(context, keys, most):
            mask[which] = match(context.take(which), size, k)
        settled = gather(table, "settled", np.int64).reshape(-1, 4)
        hit = np.flatnonzero(mask[of])
        columns = context.doc[of[hit]], gather(table, "prints", np.int64)[hit], gather(table, "at", np.int64)[hit], mask[of[hit]].view(np.int64)
        return pa.table({c: pa.array(np.r_[x, settled[:, i]]) for i, (c, x) in enumerate(zip(("doc_id", "print", "at", "mask"), columns, strict=True))})

    return _sent(own, n, size, k, sent, recurring).groupBy("part", "bucket").applyInArrow(meet, "doc_id long, print long, at long, mask long")


def _keys(df: DataFrame) -> np.ndarray:
    return df.where("kind = 1").select("key").toArrow()["key"].to_numpy().view(np.uint64)


def cover(n: int, at: np.ndarray, mask: np.ndarray, size: int) -> np.ndarray:
    """Whether each of n words is in one of the windows."""
    row, offset = np.nonzero(mask.view(np.uint64)[:, None] >> np.arange(64, dtype=np.uint64) & np.uint64(1))
    start = at[row] - offset
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, start, 1), np.add.at(depth, start + size, -1)
    return np.cumsum(depth[:-1]) > 0


def fresh(names: list[str], wish: str) -> str:
    """A column name that is not taken, whatever case the session tells apart."""
    taken = {x.lower() for x in names}
    while wish in taken:
        wish += "_"
    return wish


def cut(docs: DataFrame, windows: DataFrame, size: int, finish: Callable, schema) -> DataFrame:
    """finish(rows, gone) over Arrow batches of the documents' columns; gone: by row, whether each word is in a found window.

    Only documents that have windows are joined with them; all others, those without an id among them, pass by."""
    names = docs.columns
    own, mark = fresh(names, "own_id"), fresh(names, "own_print")
    spots = fresh(names, "own_spots")
    keyed = docs.withColumns({own: F.col("doc_id").cast("long"), mark: F.xxhash64("text")})
    held = Table(windows, "windows")
    spans = held.df.groupBy(F.col("doc_id").alias(own), F.col("print").alias(mark)).agg(F.collect_set(F.struct("at", "mask")).alias(spots))
    ids = docs.sparkSession.sparkContext.broadcast(KeyFilter.of(held.df, "doc_id")[0].bits)

    def side(inside: bool):
        def run(batches):
            known = KeyFilter(ids.value)
            for batch in batches:
                no = batch[own].is_null().to_numpy(zero_copy_only=False)
                hit = known.has(batch[own].fill_null(0).to_numpy(zero_copy_only=False)) & ~no
                if inside:
                    yield batch.filter(pa.array(hit))
                else:
                    yield from finish(pa.RecordBatch.from_arrays([batch[c] for c in names], names).filter(pa.array(~hit)), {})

        return run

    def apply(batches):
        for batch in batches:
            gone = {}
            for i, cell in enumerate(batch[spots]):
                if cell.is_valid:
                    flat = cell.values
                    gone[i] = (flat.field("at").to_numpy(zero_copy_only=False), flat.field("mask").to_numpy(zero_copy_only=False))
            yield from finish(pa.RecordBatch.from_arrays([batch[c] for c in names], names), gone)

    joined = keyed.mapInArrow(side(True), keyed.schema).join(spans, [own, mark], "left").select(*names, spots)
    return keyed.mapInArrow(side(False), schema).unionByName(joined.mapInArrow(apply, schema))
