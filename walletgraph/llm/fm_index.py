"""Passages of a benchmark in documents, found with an FM-index of each shard of documents.

The benchmark's items give the phrases: each `size` consecutive words of an item, or a shorter item as a
whole. A shard is a batch of documents. Its text for the index is the words as numbers of the phrases'
vocabulary; no phrase holds a word outside it, so runs of such words only, at least as long as the shortest
phrase, go into the index, each ended by a separator of its own. The index is the Burrows-Wheeler
transform of that text as a wavelet matrix; all phrases are searched backward at once by its ranks, and
places are read from suffix positions sampled at every eighth word and at the starts of runs. Places
merge into spans of words to remove.

The benchmark's phrases are made by tasks in blocks of about `block_bytes` of text. A benchmark of one block is
broadcast (some ten times its text); more blocks are files in the shared folder, and a task opens one at a time.

Defined cases: null or empty texts have no words; items with a null id or without words take no part;
items that share an id count once; a null doc_id or a repeated row is treated like any other. Very long texts are
searched whole. A table without documents gives no rows; a benchmark without items hits nothing. Columns besides
doc_id and text, whatever their names, are not read by contamination() and carried along by decontaminate().
"""

from __future__ import annotations

import hashlib
import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walletgraph.llm.words import PLAIN_LOWER, Hasher
from walletgraph.shared import new_path

SIZE, SAMPLE = 10, 8
BLOCK_BYTES = 2 << 20
#: Words of a shard's index.
SHARD_WORDS = 4 << 20


@dataclass
class Phrases:
    """Distinct phrases as numbers of their words, by length: (length, numbers, where each one's items begin, items)."""

    vocabulary: np.ndarray
    names: list[str]
    groups: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]

    @staticmethod
    def of(items: list[tuple[str, str]], size: int) -> Phrases:
        hasher = Hasher(PLAIN_LOWER)
        names, words, holders = sorted({item for item, _ in items}), {}, {}
        number = {item: i for i, item in enumerate(names)}
        for at, counts, hashes in hasher.words(pa.array([text for _, text in items], pa.large_string())):
            for i, (n, hi) in enumerate(zip(counts.tolist(), np.cumsum(counts).tolist(), strict=True)):
                k = min(n, size)
                if k:
                    words.setdefault(k, []).append(np.lib.stride_tricks.sliding_window_view(hashes[hi - n : hi], k))
                    holders.setdefault(k, []).append(np.full(n - k + 1, number[items[at + i][0]]))
        vocabulary = np.unique(np.concatenate([x.ravel() for own in words.values() for x in own])) if words else np.zeros(0, np.uint64)
        groups = []
        for k in sorted(words):
            ids = np.searchsorted(vocabulary, np.concatenate(words[k])).astype(np.int32) + np.int32(1)
            found, which = np.unique(ids, axis=0, return_inverse=True)
            pairs = np.unique(np.stack([which.ravel(), np.concatenate(holders[k])], 1), axis=0)
            groups.append((k, found, np.searchsorted(pairs[:, 0], np.arange(len(found) + 1)), pairs[:, 1]))
        return Phrases(vocabulary, names, groups)

    @property
    def shortest(self) -> int:
        return min((k for k, *_ in self.groups), default=0)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """By doubling of prefixes; ends soon when each run ends in a symbol of its own."""
    rank, step, n = np.unique(text, return_inverse=True)[1].astype(np.int64), 1, len(text)
    while True:
        key = rank * (n + 1)
        key[: n - step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        new = np.cumsum(np.r_[0, key[order][1:] != key[order][:-1]])
        rank[order] = new
        if n < 2 or new[-1] == n - 1 or step >= n:
            return order
        step *= 2


class FMIndex:
    """text: symbols from 1; 0 ends each run and is never searched."""

    def __init__(self, text: np.ndarray, symbols: int):
        n = len(text)
        stops = text == 0
        unique = text + int(stops.sum())
        unique[stops] = np.arange(int(stops.sum()))
        suffixes = suffix_array(unique)
        self.last = text[suffixes - 1]  # of the first suffix: the final separator
        self.before = np.cumsum(np.r_[0, np.bincount(text, minlength=symbols + 1)])
        self.levels = []
        row = self.last
        for bit in range(int(symbols).bit_length() - 1, -1, -1):
            ones = (row >> bit & 1).astype(bool)
            self.levels.append((bit, np.r_[0, np.cumsum(ones)], n - int(ones.sum())))
            row = np.r_[row[~ones], row[ones]]
        sampled = (suffixes % SAMPLE == 0) | (self.last == 0)
        self.sampled, self.sample_rank, self.samples = sampled, np.cumsum(sampled) - 1, suffixes[sampled]
        self.n = n

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often symbol stands before place `at` of the transform."""
        lo, hi = np.zeros(len(at), np.int64), at.astype(np.int64)
        for bit, ones, zeros in self.levels:
            one = symbol >> bit & 1 == 1
            lo1, hi1 = ones[lo], ones[hi]
            lo, hi = np.where(one, zeros + lo1, lo - lo1), np.where(one, zeros + hi1, hi - hi1)
        return hi - lo

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [from, to) of the suffixes that start with each phrase."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        live = np.arange(len(phrases))
        for column in phrases.T[::-1]:
            symbol = column[live]
            low[live] = self.before[symbol] + self.rank(symbol, low[live])
            high[live] = self.before[symbol] + self.rank(symbol, high[live])
            live = live[high[live] > low[live]]
        found = np.zeros(len(phrases), bool)
        found[live] = True
        return np.where(found, low, 0), np.where(found, high, 0)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        out, rows, steps, who = np.zeros(len(rows), np.int64), rows.copy(), 0, np.arange(len(rows))
        while len(who):
            done = self.sampled[rows]
            out[who[done]] = self.samples[self.sample_rank[rows[done]]] + steps
            rows, who = rows[~done], who[~done]
            symbol = self.last[rows]
            rows = self.before[symbol] + self.rank(symbol, rows)
            steps += 1
        return out


def _places(hashes: np.ndarray, counts: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """Of consecutive documents' words: how many found phrases cover each, and (document, item) numbers found."""
    depth, none = np.zeros(len(hashes) + 1, np.int64), np.zeros((0, 2), np.int64)
    if not len(hashes) or not phrases.groups:
        return depth[:-1], none
    at = np.minimum(np.searchsorted(phrases.vocabulary, hashes), len(phrases.vocabulary) - 1)
    known = phrases.vocabulary[at] == hashes
    doc = np.repeat(np.arange(len(counts)), counts)
    edge = np.flatnonzero(np.r_[True, (known[1:] != known[:-1]) | (doc[1:] != doc[:-1])])
    size = np.diff(np.r_[edge, len(hashes)])
    use = known[edge] & (size >= phrases.shortest)
    edge, size = edge[use], size[use]
    if not len(edge):
        return depth[:-1], none
    ends = np.cumsum(size + 1) - 1
    source = np.arange(ends[-1] + 1) - np.repeat(ends - size, size + 1) + np.repeat(edge, size + 1)
    stop = np.zeros(len(source), bool)
    stop[ends] = True
    text = np.where(stop, 0, at[np.minimum(source, len(hashes) - 1)] + 1)
    index = FMIndex(text, len(phrases.vocabulary))
    pairs = [none]
    for k, ids, first, items in phrases.groups:
        low, high = index.search(ids)
        many = high - low
        which = np.repeat(np.arange(len(ids)), many)
        if not len(which):
            continue
        rows = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many) + low[which]
        word = source[index.locate(rows)]
        np.add.at(depth, word, 1), np.add.at(depth, word + k, -1)
        pair = np.unique(np.stack([doc[word], which], 1), axis=0)
        holders = first[pair[:, 1] + 1] - first[pair[:, 1]]
        own = np.repeat(np.arange(len(pair)), holders)
        nth = np.arange(len(own)) - np.repeat(np.cumsum(holders) - holders, holders)
        pairs.append(np.stack([pair[own, 0], items[first[pair[own, 1]] + nth]], 1))
    return np.cumsum(depth)[:-1], np.unique(np.concatenate(pairs), axis=0)


def _blocks(benchmark: DataFrame, size: int, block_bytes: int) -> list:
    """The phrases in blocks, each made by a task: one alone is broadcast, more stay as files in the shared folder."""
    spark = benchmark.sparkSession
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("string").alias("item"), "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // block_bytes)
    folder = None if blocks <= 1 else new_path(spark, "phrases")

    def build(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        own = Phrases.of(list(zip(table["item"].to_pylist(), table["text"].to_pylist(), strict=True)), size)
        data = pickle.dumps((own.vocabulary, own.names, own.groups))
        if folder:
            task = TaskContext.get()
            system, place = pafs.FileSystem.from_uri(folder)
            system.create_dir(place, recursive=True)
            with system.open_output_stream(f"{place}/.{block}-{task.taskAttemptId()}") as stream:
                stream.write(data)
            system.move(f"{place}/.{block}-{task.taskAttemptId()}", f"{place}/{block}")
            data = b""
        return pa.table({"block": pa.array([block], pa.int32()), "data": pa.array([data], pa.binary())})

    block = F.pmod(F.xxhash64("item", "text"), F.lit(max(blocks, 1)).cast("long")).cast("int").alias("block")
    made = items.select(block, "item", "text").groupBy("block").applyInArrow(build, "block int, data binary").collect()
    return [f"{folder}/{r.block}" if folder else spark.sparkContext.broadcast(r.data) for r in made]


def _open(block) -> Phrases:
    if isinstance(block, str):
        system, place = pafs.FileSystem.from_uri(block)
        with system.open_input_file(place) as file:
            return Phrases(*pickle.loads(file.read()))
    return Phrases(*pickle.loads(block.value))


def _hits(blocks: list):
    """For a batch of texts: yields of each group of documents (first, counts, covered words, sets of item names)."""
    held = [_open(blocks[0])] if len(blocks) == 1 else None

    def group(at, counts, parts):
        counts, hashes = np.concatenate(counts), np.concatenate(parts)
        covered, items = np.zeros(len(hashes), bool), [set() for _ in counts]
        for i, block in enumerate(blocks):
            phrases = held[i] if held else _open(block)
            depth, pairs = _places(hashes, counts, phrases)
            covered |= depth > 0
            for doc, item in pairs.tolist():
                items[doc].add(phrases.names[item])
        return at, counts, covered, items

    def of(hasher: Hasher, texts: pa.Array):
        start, counts, parts, held_words = 0, [], [], 0
        for at, n, hashes in hasher.words(texts):
            if held_words + len(hashes) > SHARD_WORDS and parts:
                yield group(start, counts, parts)
                start, counts, parts, held_words = at, [], [], 0
            counts.append(n), parts.append(hashes)
            held_words += len(hashes)
        if parts:
            yield group(start, counts, parts)

    return of


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated and spans ([from, to) of words) of every document."""
    blocks = _blocks(benchmark, size, block_bytes)

    def scan(batches):
        hasher, hits = Hasher(PLAIN_LOWER), _hits(blocks)
        for batch in batches:
            out = [[] for _ in range(6)]
            for _, counts, covered, items in hits(hasher, batch["text"]):
                ends = np.cumsum(counts)
                for n, hi, own in zip(counts.tolist(), ends.tolist(), items, strict=True):
                    hit = covered[hi - n : hi]
                    edge = np.flatnonzero(np.diff(np.r_[0, hit.astype(np.int8), 0])) if own else np.zeros(0, np.int64)
                    for x, v in zip(out, (n, int(hit.sum()), len(own), hashlib.sha256(",".join(sorted(own)).encode()).hexdigest(), bool(own), edge.reshape(-1, 2).tolist()), strict=True):
                        x.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.list_(pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array(x, t) for x, t in zip(out, kinds, strict=True))], ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, spans array<array<bigint>>")


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents, all columns kept, with the found spans cut out of text; those left without a word go.

    n_chars, where there is such a column, follows the text."""
    blocks, names = _blocks(benchmark, size, block_bytes), docs.columns

    def cut(batches):
        hasher, hits = Hasher(PLAIN_LOWER), _hits(blocks)
        for batch in batches:
            new, stay, texts = {}, np.ones(batch.num_rows, bool), batch["text"]
            for at, counts, covered, items in hits(hasher, texts):
                ends = np.cumsum(counts)
                for i, own in enumerate(items):
                    if own:
                        gone = covered[ends[i] - counts[i] : ends[i]]
                        data = texts[at + i].as_py().encode()
                        starts, stops, _ = hasher._piece(np.frombuffer(data, np.uint8), np.zeros(0, np.int64))
                        edge = np.flatnonzero(np.diff(np.r_[0, gone.astype(np.int8), 0]))
                        out, last = [], 0
                        for lo, hi in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                            out.append(data[last : starts[lo]])
                            last = int(stops[hi - 1])
                        new[at + i], stay[at + i] = b"".join([*out, data[last:]]).decode(), not gone.all()
            if not new:
                yield batch
                continue
            kept = texts.to_pylist()
            for i, text in new.items():
                kept[i] = text
            swap = {"text": pa.array(kept, texts.type)}
            if "n_chars" in names:
                sizes = batch["n_chars"].to_pylist()
                for i, text in new.items():
                    sizes[i] = len(text)
                swap["n_chars"] = pa.array(sizes, batch["n_chars"].type)
            yield pa.RecordBatch.from_arrays([swap.get(c, batch[c]) for c in names], schema=batch.schema).filter(pa.array(stay))

    return docs.mapInArrow(cut, docs.schema)
