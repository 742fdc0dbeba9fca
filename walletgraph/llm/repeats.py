"""Passages of at least `size` words that repeat across documents: found whole, removed from all but the first.

A word is removed if a window of `size` consecutive words covers it whose word sequence also starts in a
document with a smaller doc_id. Windows meet as segments around a chosen phrase (see passages); what in them
repeats is found in one of two ways:

* suffix_array: the sparse array of suffixes at the chosen phrases is sorted, neighbours are compared, and
  matches extended to both sides.
* automata: recurring passages are confirmed and compiled into Aho-Corasick automata, a shard of phrases at
  a time, through which all segments stream.

Defined cases: null or empty texts have no words and stay; texts shorter than a window stay; rows with a
null doc_id are never changed and never cause a removal; rows that repeat a doc_id don't remove each other's
words, whatever their texts; equal windows within one document don't either; an empty table gives no rows;
columns besides doc_id and text, whatever their names, are carried along untouched (n_chars is kept right).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walletgraph.llm import automata, passages, suffix_array
from walletgraph.llm.passages import SIZE, cover, cut
from walletgraph.llm.words import SPACED, Hasher

METHODS = {"suffix_array": suffix_array, "automata": automata}


def windows(docs: DataFrame, method: str, size: int = SIZE) -> DataFrame:
    """(doc_id, print, at, mask) of repeated windows; see passages.found."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("print"))
    how = METHODS[method]
    return passages.found(own, how.match, how.MOST, size)


def digests(docs: DataFrame, method: str, size: int = SIZE) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 (of the kept words joined by one space) of every document."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def finish(rows: pa.RecordBatch, gone: dict):
        counts, removed, shas = [], [], []
        for i, text in enumerate(rows["text"]):
            words = (text.as_py() or "").encode().split()
            counts.append(len(words))
            if i in gone:
                off = cover(len(words), *gone[i], size)
                words = [w for w, x in zip(words, off.tolist(), strict=True) if not x]
            removed.append(counts[-1] - len(words))
            shas.append(hashlib.sha256(b" ".join(words)).hexdigest())
        yield pa.RecordBatch.from_arrays([rows["doc_id"], pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(shas, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return cut(own, windows(own, method, size), size, finish, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove(docs: DataFrame, method: str, size: int = SIZE) -> DataFrame:
    """The documents, all columns kept, with repeated passages cut out of text; those left without a word go.

    n_chars, where there is such a column, follows the text."""
    names = docs.columns

    def finish(rows: pa.RecordBatch, gone: dict):
        if not gone:
            yield rows
            return
        hasher, kept = Hasher(SPACED), rows["text"].to_pylist()
        stay = np.ones(len(kept), bool)
        for i, spots in gone.items():
            data = kept[i].encode()
            starts, ends, _ = hasher._piece(np.frombuffer(data, np.uint8), np.zeros(0, np.int64))
            off = cover(len(starts), *spots, size)
            stay[i] = not off.all()
            edge = np.flatnonzero(np.diff(np.r_[0, off.astype(np.int8), 0]))
            out, at = [], 0
            for lo, hi in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                out.append(data[at : starts[lo]])
                at = int(ends[hi - 1])
            kept[i] = b"".join([*out, data[at:]]).decode()
        new = {"text": pa.array(kept, rows["text"].type)}
        if "n_chars" in names:
            sizes = rows["n_chars"].to_pylist()
            for i in gone:
                sizes[i] = len(kept[i])
            new["n_chars"] = pa.array(sizes, rows["n_chars"].type)
        yield pa.RecordBatch.from_arrays([new.get(c, rows[c]) for c in names], names).filter(pa.array(stay))

    return cut(docs, windows(docs, method, size), size, finish, docs.schema)
