"""Exact join of documents by the Jaccard similarity of their word n-gram sets, and its components.

A size-aware heavy-light join. All sets order their n-grams alike, rare ones first. With a threshold t, two
similar sets share an n-gram among the first n - ceil(t n) + 1 of each, and two n-grams (if they share two
at all) among the first n - ceil(t n) + 2.

* Small sets, up to a boundary, enumerate the 2-subsets of the longer prefix as keys.
* Large sets, small ones that a large one may be similar to, and those that may be similar to a set by one
  common n-gram put the n-grams of the shorter prefix into inverted lists, which are then scanned.
* The boundary is the one of least cost for the histogram of set sizes: subsets that would be made
  against postings made and scanned.

N-grams of which a first pass over all sets shows that one set alone has them come first in the order, and
need no key: a document unlike all others makes none.

Equal sets are one class from the start, so copies make one posting a batch. Keys that only one class has
are dropped. The others' lists are scanned in rounds: a bound from 512-bit parity sketches, never below the
true overlap, rules pairs out; of those left each document's most promising partner is verified on the
whole sets, and verified links are contracted to components. A last round verifies every remaining pair
between different components, so no link is lost, while groups of near copies never make all their pairs.
Lists of very frequent keys are split: each pair of their parts meets in a bucket of its own. Keys are known
to be frequent from the first pass, or from the lists themselves: where one is too long, keys are made anew.

Defined cases: null or empty texts have an empty set and are linked with nothing; texts of fewer than k
words have their whole sequence as one n-gram; rows with a null doc_id get a null component; rows that
repeat a doc_id count as one node with several texts. Very long texts are read whole. Which of equally similar
partners is looked at first changes no component. An empty table gives no rows. Further columns, whatever their names,
are not read by near_duplicates() and carried along by representatives().
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walletgraph.llm.buckets import PIECE_BITS, KeyFilter, bucket_count, deal, filter_bits, gather, input_bytes, key_bucket, nest, nest_rows, nest_schema, nested, part_count, record_batch, runs
from walletgraph.llm.words import SPACED_LOWER, Hasher, mix
from walletgraph.operators.graph import connected_components
from walletgraph.shared import Table, received, send

#: N-grams whose frequency orders the prefixes: at most so many, sent to all tasks (16 bytes each); the rest count as rare.
FREQUENT = 200_000
#: An n-gram is counted if a batch of documents has it so often.
BATCH_LEAST = 3
#: The share of n-grams, in multiples of 1 - t, whose being in one set only is known; by hash, so any n-gram may be among them.
LOW = 2
#: Members of one part of a very frequent key's list; more where the input is so large that a million keys might be split.
PART, PART_SHIFT = 4096, 26
#: Times that keys are made, for the lists that turn out too long; what is left after that costs time only.
TURNS = 3
#: Largest boundary that is weighed, and the cost of scanning a posting against making one.
MOST_SMALL, SCAN = 64, 3.0
SKETCH_BITS = 512
FLUSH = 1 << 19
ROUNDS = ("best", "best", "all")


def need(n, num: int, den: int):
    """Smallest overlap that a set of n can have with a similar one."""
    return -(-num * n // den)


def sets(hasher: Hasher, texts: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """Index and sorted n-gram hashes of every document."""
    for at, counts, hashes in hasher.words(texts):
        grams = hasher.grams(hashes, k)
        ends = np.cumsum(counts)
        for i, (n, hi) in enumerate(zip(counts.tolist(), ends.tolist(), strict=True)):
            if n >= k:
                yield at + i, np.unique(grams[hi - n : hi - k + 1])
            elif n:
                yield at + i, np.array([hasher.sequence(hashes[hi - n : hi])], np.uint64)
            else:
                yield at + i, np.zeros(0, np.uint64)


_SUMS = pa.schema([("kind", pa.int32()), ("piece", pa.int64()), ("a", pa.binary()), ("b", pa.binary())])
_COUNTS = pa.schema([("bucket", pa.int32()), ("once", pa.binary()), ("twice", pa.binary()), ("keys", pa.binary()), ("counts", pa.binary())])


def _statistics(docs: DataFrame, k: int, cut: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[int, int]]:
    """Places of n-grams below the cut that two sets have; the most frequent n-grams and their counts; sets by size.

    Places are 32 bits of an n-gram. They are dealt by the part of the filter's bitmap that they fall into, so
    each bucket makes its part; bucket -1 has the sizes. The driver gets 4,096 pieces, 2,048 steps of frequency
    and FREQUENT n-grams at most, however many buckets and texts there are."""
    parts, power = part_count(docs), filter_bits(input_bytes(docs) // 2)  # a byte has less than half an n-gram below the cut

    def count(batches):
        hasher = Hasher(SPACED_LOWER)

        def out(grams, sizes):
            key, many = np.unique(np.concatenate(grams), return_counts=True)
            low = key < np.uint64(cut)
            place, first, again = np.unique((key[low] & np.uint64(0xFFFFFFFF)).astype(np.uint32), return_index=True, return_counts=True)
            twice = (again > 1) | (many[low][first] > 1)
            often = many >= BATCH_LEAST
            key, many = key[often], many[often].astype(np.int64)
            size, sets_of = np.unique(np.minimum(sizes, MOST_SMALL * 4), return_counts=True)
            cells: dict[int, list[bytes]] = {-1: [b"", b"", size.astype(np.int64).tobytes(), sets_of.astype(np.int64).tobytes()]}
            part = lambda own: ((own.astype(np.int64) & ((1 << power) - 1)) * n >> power).astype(np.int32)
            for i, own in enumerate((place[~twice], place[twice])):
                for b, cell in deal(part(own), own):
                    cells.setdefault(b, [b""] * 4)[i] = cell
            for b, *cell in deal(key_bucket(key, n), key, many):
                cells.setdefault(b, [b""] * 4)[2:] = cell
            return nest_rows([(b, *x) for b, x in cells.items()], parts, _COUNTS)

        for batch in batches:
            grams, sizes, held = [], [], 0
            for _, own in sets(hasher, batch["text"], k):
                grams.append(own), sizes.append(len(own))
                held += len(own)
                if held > 4 * FLUSH:
                    yield out(grams, sizes)
                    grams, sizes, held = [], [], 0
            if sizes:
                yield out(grams, sizes)

    def meet(table: pa.Table) -> pa.Table:
        """kind 0: pieces of the bitmap; kind 1: n-grams and counts; kind 2: sizes and counts."""
        once = np.sort(gather(table, "once", np.uint32))
        place = np.unique(np.r_[once[1:][once[1:] == once[:-1]], gather(table, "twice", np.uint32)] & np.uint32((1 << power) - 1)).astype(np.int64)
        keys, at = np.unique(gather(table, "keys", np.int64), return_inverse=True)
        counts = np.bincount(at, gather(table, "counts", np.int64), len(keys)).astype(np.int64)
        size = table.num_rows > 0 and table["bucket"][0].as_py() == -1
        if not size:
            keys, counts = keys[counts >= 2 * BATCH_LEAST], counts[counts >= 2 * BATCH_LEAST]
        pieces = []
        for lo in runs(place >> PIECE_BITS):
            own = place[lo : np.searchsorted(place, (place[lo] >> PIECE_BITS) + 1 << PIECE_BITS)]
            bits = np.zeros(1 << PIECE_BITS, np.uint8)
            bits[own & (1 << PIECE_BITS) - 1] = 1
            pieces.append((0, int(place[lo] >> PIECE_BITS), np.packbits(bits, bitorder="little").tobytes(), b""))
        pieces.append((2 if size else 1, 0, keys.tobytes(), counts.tobytes()))
        return pa.Table.from_batches([record_batch(pieces, _SUMS)], schema=_SUMS)

    dealt = nested(docs.mapInArrow(count, nest_schema(_COUNTS)))
    found = Table(dealt.groupBy("part", "bucket").applyInArrow(meet, "kind int, piece long, a binary, b binary"), "statistics", rebalance=False)
    twice = KeyFilter.empty(power)
    for piece, own in zip(*(c.to_pylist() for c in _pieces(found.df).columns), strict=True):
        twice.add(piece, own)
    often = _most_frequent(found.df)
    keys, counts = often["key"].to_numpy().view(np.uint64), often["n"].to_numpy()
    size = found.df.where("kind = 2").select("a", "b").toArrow().to_pylist()
    found.drop()
    sizes = {k: v for row in size for k, v in zip(np.frombuffer(row["a"], np.int64).tolist(), np.frombuffer(row["b"], np.int64).tolist(), strict=True)}
    return twice.bits, keys, counts, sizes


def _pieces(found: DataFrame) -> pa.Table:
    """The bitmap in pieces of 4 KB, each put together from the buckets that own some of it."""
    return found.where("kind = 0").groupBy("piece").agg(F.bitmap_or_agg("a").alias("a")).toArrow()


def _most_frequent(found: DataFrame) -> pa.Table:
    """(key, n) of the most frequent n-grams, FREQUENT at most: those above the least step of frequency that leaves no more."""

    def rows(batches):
        for batch in batches:
            for a, b in zip(batch["a"], batch["b"], strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(a.as_buffer(), np.int64)), pa.array(np.frombuffer(b.as_buffer(), np.int64))], ["key", "n"])

    known = found.where("kind = 1").select("a", "b").mapInArrow(rows, "key long, n long").withColumn("step", F.floor(F.log2("n") * 32).cast("int"))
    total, least = 0, 1 << 30
    for step, many in sorted(map(tuple, known.groupBy("step").count().collect()), reverse=True):  # 2,048 steps at most
        total += many
        if total > FREQUENT:
            break
        least = step
    return known.where(F.col("step") >= least).select("key", "n").toArrow()


def boundary(sizes: dict[int, int], num: int, den: int) -> int:
    """The size up to which sets enumerate subsets; 0: none do."""

    def cost(b: int) -> float:
        total = 0.0
        for n, many in sizes.items():
            if 2 <= n <= b:
                p = n - need(n, num, den) + 2
                total += many * min(n, p) * (min(n, p) - 1) / 2
            if n * den > num * b:
                total += many * (n - need(n, num, den) + 1) * (1 + SCAN)
        return total

    return min(range(MOST_SMALL + 1), key=cost)


class Prefixes:
    """Keys of a set: in the order of all sets, subsets of small sets' prefixes and n-grams of large ones'.

    First come n-grams below the cut that only one set has; they need no key. Then the rest, rare ones first."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, twice: np.ndarray, cut: int, small: int, num: int, den: int, part: int):
        order = np.argsort(keys)
        self.keys, self.counts, self.small, self.num, self.den = keys[order], counts[order], small, num, den
        self.twice, self.cut, self.part = KeyFilter(twice), np.uint64(cut), part

    def order(self, own: np.ndarray, p: int) -> np.ndarray:
        """Of the first p n-grams, those that another set may have."""
        low = int(np.searchsorted(own, self.cut))
        alone = np.zeros(len(own), bool)
        alone[:low] = ~self.twice.has(own[:low])
        left = p - int(alone.sum())
        if left <= 0:
            return own[:0]
        own = own[~alone]
        if not len(self.keys):
            return own[:left]
        at = np.minimum(np.searchsorted(self.keys, own), len(self.keys) - 1)
        often = self.keys[at] == own
        rare = own[~often]
        if len(rare) >= left:
            return rare[:left]
        known = own[often]
        return np.r_[rare, known[np.lexsort((known, self.counts[at[often]]))][: left - len(rare)]]

    def of(self, own: np.ndarray) -> np.ndarray:
        n = len(own)
        least = need(n, self.num, self.den)
        out = []
        if 2 <= n <= self.small:
            first = self.order(own, min(n, n - least + 2))
            i, j = np.triu_indices(len(first), 1)
            out.append(mix(mix(first[i]) + first[j]))
        if n and (n * self.den > self.num * self.small or least < 2):
            out.append(self.order(own, n - least + 1))
        return np.concatenate(out) if out else np.zeros(0, np.uint64)

    def parts(self, keys: np.ndarray) -> np.ndarray:
        """Into how many parts each key's list is split."""
        if not len(self.keys):
            return np.ones(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[at] == keys) & (self.counts[at] > 2 * self.part), -(-self.counts[at] // self.part), 1)

    def split(self, keys: np.ndarray, who: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys, and which postings they are of: a posting of a split list goes to each pair of parts that has its own."""
        parts = self.parts(keys)
        if (parts == 1).all():
            return keys, np.arange(len(keys))
        index = np.repeat(np.arange(len(keys)), parts)
        other = np.arange(len(index)) - np.repeat(np.cumsum(parts) - parts, parts)
        many = parts[index]
        mine = (mix(who.view(np.uint64)) % parts.astype(np.uint64)).astype(np.int64)[index]
        pair = np.minimum(mine, other) * many + np.maximum(mine, other)
        return np.where(many > 1, mix(keys[index] + mix(pair.astype(np.uint64))), keys[index]), index


def fingerprint(own: np.ndarray) -> int:
    return int(mix(np.array([mix(own).sum(dtype=np.uint64) + np.uint64(len(own))]))[0].view(np.int64))


def sketch(own: np.ndarray) -> bytes:
    return np.packbits((np.bincount((own % np.uint64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS) & 1).astype(np.uint8)).tobytes()


_POSTINGS = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("prints", pa.binary()), ("docs", pa.binary()), ("sizes", pa.binary())])
_LISTS = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("docs", pa.binary()), ("sizes", pa.binary()), ("labels", pa.binary()), ("sketches", pa.binary())])
_SETS = pa.schema([("doc_id", pa.int64()), ("n", pa.int32()), ("grams", pa.binary()), ("sketch", pa.binary()), ("keys", pa.binary())])


def _postings(docs: DataFrame, k: int, prefixes, n: int) -> DataFrame:
    """Keys by bucket, a posting for each key and class of equal sets; part -1: (prints, docs, sizes) of all documents."""
    parts = part_count(docs)

    def send(batches):
        hasher, pre = Hasher(SPACED_LOWER), received(prefixes)

        def out(keys, who, prints, ids, sizes):
            rows = [(-1, b"", prints.tobytes(), ids.tobytes(), sizes.tobytes())]
            if keys:
                key, own = np.concatenate(keys), np.repeat(np.array(who), list(map(len, keys)))
                order = np.lexsort((ids[own], prints[own], key))
                key, own = key[order], own[order]
                new = np.r_[True, (key[1:] != key[:-1]) | (prints[own[1:]] != prints[own[:-1]])][: len(key)]
                key, own = key[new], own[new]
                key, index = pre.split(key, prints[own])
                own = own[index]
                rows += deal(key_bucket(key, n), key, prints[own], ids[own], sizes[own])
            return nest_rows(rows, parts, _POSTINGS)

        for batch in batches:
            doc_ids = batch["doc_id"].to_numpy(zero_copy_only=False)
            keys, who, prints, sizes, held, start = [], [], [], [], 0, 0
            for i, own in sets(hasher, batch["text"], k):
                sizes.append(len(own)), prints.append(fingerprint(own))
                if len(own):
                    keys.append(pre.of(own)), who.append(i - start)
                    held += len(keys[-1])
                if held > FLUSH or i == len(doc_ids) - 1:
                    yield out(keys, who, np.array(prints, np.int64), doc_ids[start : i + 1].astype(np.int64), np.array(sizes, np.int32))
                    keys, who, prints, sizes, held, start = [], [], [], [], 0, i + 1

    return docs.mapInArrow(send, nest_schema(_POSTINGS))


def _shared_keys(most: int):
    def meet(table: pa.Table) -> pa.Table:
        """(kind, value, many): documents (0) and keys (1) of lists that have two classes of equal sets; keys (2) of lists of more than `most`."""
        key, print_, doc = gather(table, "keys", np.uint64), gather(table, "prints", np.int64), gather(table, "docs", np.int64)
        order = np.lexsort((doc, print_, key))
        key, print_, doc = key[order], print_[order], doc[order]
        new = np.r_[True, (key[1:] != key[:-1]) | (print_[1:] != print_[:-1])][: len(key)]
        key, doc = key[new], doc[new]
        first = runs(key)
        size = np.diff(np.r_[first, len(key)])
        docs, keys, long = np.unique(doc[np.repeat(size > 1, size)]), key[first][size > 1].view(np.int64), size > most
        kind = np.repeat(np.arange(3, dtype=np.int32), [len(docs), len(keys), int(long.sum())])
        return pa.table({"kind": pa.array(kind), "value": pa.array(np.r_[docs, keys, key[first][long].view(np.int64)].astype(np.int64)), "many": pa.array(np.r_[np.zeros(len(docs) + len(keys), np.int64), size[long]])})

    return meet


def _candidate_sets(docs: DataFrame, k: int, prefixes, ids, keys) -> DataFrame:
    def pick(batches):
        hasher, pre, known, shared = Hasher(SPACED_LOWER), received(prefixes), KeyFilter(ids.value), KeyFilter(keys.value)
        for batch in batches:
            doc_ids = batch["doc_id"].to_numpy(zero_copy_only=False).astype(np.int64)
            some = np.flatnonzero(known.has(doc_ids))
            rows, held = [], 0
            for i, own in sets(hasher, batch["text"].take(pa.array(some)), k) if len(some) else ():
                key = pre.of(own)
                doc = doc_ids[some[i] : some[i] + 1]
                key, index = pre.split(key, np.full(len(key), fingerprint(own), np.int64))
                key = key[shared.has(key)] if len(key) else key
                if len(key):
                    rows.append((int(doc[0]), len(own), own.tobytes(), sketch(own), key.tobytes()))
                    held += len(own)
                if held > FLUSH:
                    yield record_batch(rows, _SETS)
                    rows, held = [], 0
            if rows:
                yield record_batch(rows, _SETS)

    return docs.mapInArrow(pick, "doc_id long, n int, grams binary, sketch binary, keys binary")


def _lists(found: DataFrame, n: int) -> DataFrame:
    parts = part_count(found)

    def send(batches):
        for batch in batches:
            keys = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch["keys"]]
            if not keys:
                continue
            own = np.repeat(np.arange(len(keys)), list(map(len, keys)))
            key = np.concatenate(keys)
            marks = np.frombuffer(b"".join(batch["sketch"].to_pylist()), np.uint8).reshape(len(keys), -1)
            yield nest(key_bucket(key, n), parts, keys=key, docs=batch["doc_id"].to_numpy()[own], sizes=batch["n"].to_numpy()[own], labels=batch["label"].to_numpy()[own], sketches=marks[own])

    return nested(found.select("keys", "sketch", "doc_id", "n", "label").mapInArrow(send, nest_schema(_LISTS)))


def _pairs(num: int, den: int, mode: str):
    """Of a bucket's lists: pairs of documents of different labels that the bounds allow; best: one for each document."""
    small_list, block = 48, 1 << 18

    def scan(table: pa.Table) -> pa.Table:
        key, doc = gather(table, "keys", np.uint64), gather(table, "docs", np.int64)
        size, label = gather(table, "sizes", np.int32).astype(np.int64), gather(table, "labels", np.int64)
        marks = gather(table, "sketches", np.uint64).reshape(-1, SKETCH_BITS // 64)
        node, first_at, local = np.unique(np.rec.fromarrays([doc, size]), return_index=True, return_inverse=True)
        doc, size, label, marks = doc[first_at], size[first_at], label[first_at], marks[first_at]
        order = np.lexsort((local, key))
        key, local = key[order], local[order]
        new = np.r_[True, (key[1:] != key[:-1]) | (local[1:] != local[:-1])][: len(key)]
        key, local = key[new], local[new]
        start = runs(key)
        length = np.diff(np.r_[start, len(key)])
        total = len(doc)
        kept: list[np.ndarray] = []
        best = np.full(total, -1.0), np.zeros(total, np.int64)

        def weigh(a: np.ndarray, b: np.ndarray) -> None:
            """Takes pairs of local indices, a < b, that may repeat."""
            fits = (label[a] != label[b]) & (np.minimum(size[a], size[b]) * den >= num * np.maximum(size[a], size[b]))
            code = np.unique(a[fits] * total + b[fits])
            for at in range(0, len(code), block):
                a, b = code[at : at + block] // total, code[at : at + block] % total
                apart = np.bitwise_count(marks[a] ^ marks[b]).sum(axis=1, dtype=np.int64)
                both = size[a] + size[b]
                overlap = (both - apart) // 2
                ok = overlap * (num + den) >= num * both
                a, b, guess = a[ok], b[ok], (overlap[ok] / np.maximum(1, both[ok] - overlap[ok]))
                if mode == "all":
                    kept.append(a * total + b)
                    continue
                for x, y in ((a, b), (b, a)):
                    turn = np.lexsort((-y, guess))  # the best partner of each comes last, the smallest of equal ones
                    x, y, g = x[turn], y[turn], guess[turn]
                    more = g > best[0][x]
                    best[0][x[more]], best[1][x[more]] = g[more], y[more]

        for m in np.unique(length[(length > 1) & (length <= small_list)]).tolist():
            heads = start[length == m]
            i, j = np.triu_indices(m, 1)
            step = max(1, block // len(i))
            for at in range(0, len(heads), step):
                rows = local[heads[at : at + step, None] + np.arange(m)]
                weigh(rows[:, i].ravel(), rows[:, j].ravel())
        for head, m in zip(start[length > small_list].tolist(), length[length > small_list].tolist(), strict=True):
            rows = local[head : head + m]
            step = max(1, block // m)
            for at in range(0, m, step):
                i, j = np.nonzero(np.arange(m)[None, :] > np.arange(at, min(m, at + step))[:, None])
                weigh(rows[at + i], rows[j])
        if mode == "all":
            code = np.unique(np.concatenate(kept)) if kept else np.zeros(0, np.int64)
        else:
            x = np.flatnonzero(best[0] >= 0)
            code = np.unique(np.minimum(x, best[1][x]) * total + np.maximum(x, best[1][x]))
        a, b = doc[code // max(total, 1)], doc[code % max(total, 1)]
        return pa.table({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b))})

    return scan


def _verified(pairs: DataFrame, found: DataFrame, num: int, den: int) -> Table:
    """Pairs that link, written. Only sets that a pair names on that side are moved."""
    ends = KeyFilter.of(pairs.select(F.posexplode(F.array("a", "b")).alias("side", "doc_id")), "doc_id", 2, "side")

    def named(ids):
        def run(batches):
            known = KeyFilter(ids.value)
            for batch in batches:
                yield batch.filter(pa.array(known.has(batch["doc_id"].to_numpy())))

        return run

    def test(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch["x"], batch["y"], strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(den * both >= num * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    sent = [found.sparkSession.sparkContext.broadcast(end.bits) for end in ends]
    x, y = (found.select("doc_id", "grams").mapInArrow(named(ids), "doc_id long, grams binary").toDF(i, g) for ids, i, g in zip(sent, ("a", "b"), ("x", "y"), strict=True))
    out = Table(pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(test, "a long, b long"), "links")
    for ids in sent:
        ids.destroy()
    return out


def near_duplicates(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id): documents link when den * intersection >= num * union of their k-word n-gram sets."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    own = docs.where("doc_id is not null")
    n = bucket_count(own)

    cut = min((1 << 64) - 1, (1 << 64) * LOW * (den - num) // den)
    twice, often, counts, sizes = _statistics(own, k, cut, n)
    part, small = max(PART, input_bytes(own) >> PART_SHIFT), boundary(sizes, num, den)
    for turn in range(TURNS):
        prefixes = send(spark, Prefixes(often, counts, twice, cut, small, num, den, part))
        posted = Table(_postings(own, k, prefixes, n), "postings", rebalance=False)
        shared = Table(nested(posted.df.where("part >= 0")).groupBy("part", "bucket").applyInArrow(_shared_keys(4 * part), "kind int, value long, many long"), "shared")
        long = shared.df.where("kind = 2").select("value", "many").toArrow()
        keys, many = long["value"].to_numpy().view(np.uint64), long["many"].to_numpy()
        new = ~np.isin(keys, often)
        if not new.any() or turn == TURNS - 1:
            break
        posted.drop(), shared.drop(), prefixes.destroy()
        often, counts = np.r_[often, keys[new]], np.r_[counts, many[new]]
    ids, keys = (spark.sparkContext.broadcast(x.bits) for x in KeyFilter.of(shared.df.where("kind < 2"), "value", 2, "kind"))
    shared.drop()
    found = Table(_candidate_sets(own, k, prefixes, ids, keys), "sets", rebalance=False)
    for sent in (prefixes, ids, keys):
        sent.destroy()

    links: list[Table] = []
    labels = None
    for mode in ROUNDS:
        labelled = found.df.withColumn("label", F.col("doc_id")) if labels is None else found.df.join(labels.select(F.col("node").alias("doc_id"), F.col("component").alias("label")), "doc_id", "left").withColumn("label", F.coalesce("label", "doc_id"))
        pairs = _lists(labelled, n).groupBy("part", "bucket").applyInArrow(_pairs(num, den, mode), "a long, b long").distinct()
        pairs = Table(pairs, "pairs")
        links.append(_verified(pairs.df, found.df, num, den))
        pairs.drop()
        labels = connected_components(reduce(DataFrame.unionByName, (x.df for x in links)))
    found.drop()

    digests = _digests(posted.df.where("part = -1").select(F.inline("cells")))
    classes = digests.where("n > 0").groupBy("print").agg(F.min("doc_id").alias("node"))
    classes = Table(classes.join(labels, "node", "left").select("print", F.coalesce("component", "node").alias("component")), "classes")
    for x in links:
        x.drop()
    out = digests.join(classes.df, "print", "left").select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))

    def count_only(batches):
        hasher = Hasher(SPACED_LOWER)
        for batch in batches:
            size = [len(x) for _, x in sets(hasher, batch["text"], k)]
            yield pa.RecordBatch.from_arrays([pa.nulls(len(size), pa.int64()), pa.array(size, pa.int64()), pa.nulls(len(size), pa.int64())], ["doc_id", "n_shingles", "component_id"])

    return out.unionByName(docs.where("doc_id is null").mapInArrow(count_only, "doc_id long, n_shingles long, component_id long"))


def _digests(df: DataFrame) -> DataFrame:
    def rows(batches):
        for batch in batches:
            for p, d, s in zip(batch["prints"], batch["docs"], batch["sizes"], strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(x.as_buffer(), t)) for x, t in ((p, np.int64), (d, np.int64), (s, np.int32))], ["print", "doc_id", "n"])

    return df.select("prints", "docs", "sizes").mapInArrow(rows, "print long, doc_id long, n int")


def representatives(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The documents, all columns kept, without those that a smaller doc_id of their component stands for."""
    gone = near_duplicates(docs, k, num, den).where("component_id <> doc_id").select(F.col("doc_id").alias("gone")).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone["gone"], "left_anti")
