"""How quality filters interact: what each would remove at each place of every order of them.

A text's failures are a mask of five bits. Counts of documents by mask, with those labelled good and toxic, are
the rows of a matrix, three for each part of the corpus; its products with fixed integer matrices of 32 masks by
600 places (five in each of the 120 orders) are all outcomes at once, so no order is run over the documents.

Texts are read once. That a text is the copy of an earlier one is told from counts: documents of one text in one
part and with the same labels become one row, which knows its smallest doc_id and how many rows have that. So a
text that a third of the corpus has costs a row for each task, and nothing is joined by text.

Defined cases: null texts are empty ones; empty texts have under 200 words and fail nothing else but E; very long
texts are read whole, in pieces; a null lang counts as part ''; rows with a null doc_id are copies of nothing, nothing
is a copy of them, and they have no labels; rows that repeat a doc_id each count, and are no copies of each other;
a document with several labels is good (toxic) if one of them says so; other labels than 1, null ones among them, say
nothing; an empty table gives no rows; further columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from walletgraph.llm.words import raw_bytes
from walletgraph.shared import Table

FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 3
CAPITALS = bytes(range(65, 91))
_MARKS, _SPACE = re.compile(rb"[#$%&*|]"), re.compile(rb"[\x20\x09-\x0D]")
#: Bytes of a text whose words are held at a time, and parts whose products are.
PIECE, PARTS = 1 << 20, 64


def words(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some at a time."""
    at = 0
    while at < len(data):
        gap = _SPACE.search(data, at + PIECE)
        end = gap.start() if gap else len(data)
        yield data[at:end].split()
        at = end


def failures(data: bytes, chars: int) -> int:
    """Bits 0 to 3 for filters A to D."""
    many, distinct = 0, set()
    for own in words(data):
        many += len(own)
        distinct.update(own)
    capitals = len(data) - len(data.translate(None, CAPITALS))
    return (many < LEAST_WORDS) | (100 * len(distinct) < LEAST_DISTINCT * many) << 1 | (100 * capitals > MOST_CAPITALS * chars) << 2 | bool(_MARKS.search(data)) << 3


def _marked(docs: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            data, offsets = raw_bytes(batch["text"])
            masks, digests = [], []
            for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                own = data[lo:hi]
                text = own.tobytes()
                masks.append(failures(text, int(np.count_nonzero(own & 0xC0 != 0x80))))
                digests.append(hashlib.sha256(text).digest())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["part"], pa.array(masks, pa.int32()), pa.array(digests, pa.binary())], ["doc_id", "part", "mask", "digest"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), "text")
    return own.mapInArrow(run, "doc_id long, part string, mask int, digest binary")


def histograms(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by failed filters, and those of them with each label."""
    said = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("int"))
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(said("quality").alias("good"), said("toxic").alias("toxic"))
    known = Table(known, "labels")  # a plain side of the join, so that a hot doc_id can be split
    rows = Table(_marked(docs), "marks", rebalance=False)  # texts are read once
    own = rows.df.where("doc_id is not null").groupBy("doc_id", "part", "mask", "digest").agg(F.count("*").alias("n"))
    own = own.join(known.df, "doc_id", "left").na.fill(0, ["good", "toxic"])
    alike = own.groupBy("digest", "part", "mask", "good", "toxic").agg(F.sum("n").alias("n"), F.min("doc_id").alias("least"), F.min_by("n", "doc_id").alias("at_least"))
    first = F.min("least").over(Window.partitionBy("digest"))
    alike = alike.withColumn("fresh", F.when(F.col("least") == first, F.col("at_least")).otherwise(F.lit(0)))
    kinds = F.array(F.struct("mask", F.col("fresh").alias("n")), F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("fresh")).alias("n")))
    alike = alike.select("part", "good", "toxic", F.explode(kinds).alias("k")).select("part", "k.mask", "k.n", "good", "toxic")
    rest = rows.df.where("doc_id is null").select("part", "mask", F.lit(1).cast("long").alias("n"), F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    return alike.unionByName(rest).groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def outcomes() -> dict[str, np.ndarray]:
    """By outcome a matrix of 32 masks by 600 places: 1 where a document of that mask has it there."""
    own = np.array([[1 << FILTERS.index(f) for f in order] for order in permutations(FILTERS)])
    before = (np.cumsum(own, axis=1) - own).ravel()
    own, mask = own.ravel(), np.arange(32)[:, None]
    fails, gone = mask & own != 0, mask & before != 0
    out = {"kept": ~fails & ~gone, "removed": fails & ~gone, "redundant": fails & gone, "unique_fails": mask == own}
    return {name: x.astype(np.int64) for name, x in out.items()}


_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley), 600 rows a part."""

    def multiply(batches):
        matrix, orders = outcomes(), ["".join(x) for x in permutations(FILTERS)]
        letter = np.array([FILTERS.index(f) for order in orders for f in order])
        names = np.repeat(orders, 5)
        for batch in batches:
            for at in range(0, batch.num_rows, PARTS):
                some = batch.slice(at, PARTS)
                cells = some["cells"].to_pylist()
                rows = np.zeros((3, len(cells), 32), np.int64)
                for i, own in enumerate(cells):
                    for x in own:
                        rows[:, i, x["mask"]] = x["n"], x["good"], x["toxic"]
                found = {name: rows[0] @ m for name, m in matrix.items()}
                found |= {"good_lost": rows[1] @ matrix["removed"], "toxic_lost": rows[2] @ matrix["removed"]}
                sums = np.stack([found["removed"][:, letter == f].sum(axis=1) for f in range(5)], axis=1)
                found["shapley"] = sums[:, letter]
                part = pa.array(np.repeat(np.arange(len(cells)), 600))
                columns = [some["part"].take(part), pa.array(np.tile(names, len(cells))), pa.array(np.tile(np.arange(1, 6, dtype=np.int32), 120 * len(cells)))]
                yield pa.RecordBatch.from_arrays([*columns, *(pa.array(found[c].ravel()) for c in _COUNTS)], ["part", "filter_order", "step", *_COUNTS])

    stacked = histograms(docs, labels).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))  # 32 masks a part at most
    return stacked.mapInArrow(multiply, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in _COUNTS))
