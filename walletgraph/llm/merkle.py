"""A Merkle manifest of a data set: a tree for each part, and one tree over the parts' roots.

Bottom up, every eight consecutive nodes of a level become one, and each level is written with its children.
Top down, each level joins its nodes to their parents: a node's path is its own siblings before what its parent
has inherited. A path is an array with an entry a level, of the siblings' digests to the left and to the right,
from which a proof is checked by folding a leaf's digest up to the root. Joins are on (tree, place), which are
unique, so no part is too large for a task; paths are moved once for eight leaves.

All of it is Spark's own functions. The driver learns the number of leaves of the largest part, no more.

Defined cases: null values are written as '-'; a null part comes first and is not the part ''; null doc_ids come first
in their part; rows that repeat a doc_id are leaves of their own, ordered by their digests; an empty table gives no
rows; a single leaf is its part's root, and the only part's root is the root; its proof is then the digest of
nothing; texts of any length are hashed whole; further columns, whatever their names, are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from walletgraph.shared import Table

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<left: string, right: string>>"


def leaf(values: dict[str, Column]) -> Column:
    """Digest of the fields, each '-' if null, else its length in bytes, ':' and itself."""
    own = [x.cast("string") for x in values.values()]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in own)), 256)


def _up(place: str) -> Column:
    return F.expr(f"({place}) DIV {FANOUT}")


def _placed(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """Rows with their place in their tree from 0 and `many`, the tree's number of rows; rows must be a written table.

    After one range sort each task knows its own counts; a tree's tasks are summed in a window of one row a task."""
    tied = rows.withColumn("__tie", F.monotonically_increasing_id())  # the same whenever it is read, and equal rows can be dealt out
    sorted_rows = Table(tied.orderBy(tree, *order, "__tie").drop("__tie").withColumn("__at", F.monotonically_increasing_id()), "sorted", rebalance=False).df
    sorted_rows = sorted_rows.withColumn("__task", F.shiftright("__at", 33))
    counts = sorted_rows.groupBy(tree, "__task").agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    of = Window.partitionBy(tree)
    earlier = F.coalesce(F.sum("__n").over(of.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = Table(counts.select(tree, "__task", (earlier - F.col("__first")).alias("__shift"), F.sum("__n").over(of).alias("many")), "starts").df
    return sorted_rows.join(starts, [tree, "__task"]).withColumn("place", F.col("__at") + F.col("__shift")).drop("__at", "__task", "__shift")


def _levels(leaves: DataFrame) -> list[DataFrame]:
    """Levels above the leaves, written: (tree, place, many, digest, children); a tree ends with its only node."""
    most, out, current = leaves.agg(F.max("many")).first()[0] or 0, [], leaves.select("tree", "place", "many", "digest")
    while most > 1:
        runs = current.where("many > 1").groupBy("tree", _up("place").alias("place"), _up(f"many + {FANOUT - 1}").alias("many"))
        children = runs.agg(F.sort_array(F.collect_list(F.struct(F.col("place").alias("p"), "digest"))).alias("c")).select("tree", "place", "many", F.col("c.digest").alias("children"))
        out.append(Table(children.withColumn("digest", F.sha2(F.array_join("children", ""), 256)), "level", rebalance=False).df)
        current, most = out[-1], -(-most // FANOUT)
    return out


def _roots(leaves: DataFrame, levels: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, (x.where("many = 1").select("tree", "digest") for x in [leaves, *levels]))


def _inherited(level: DataFrame, above: DataFrame | None, tops: DataFrame) -> DataFrame:
    """A level's nodes with their paths: its parents' (above) after the node's siblings, or the tree's own for its only node."""
    alone = level.where("many = 1").join(tops, "tree")
    if above is None:
        return alone
    parents = above.withColumnsRenamed({"place": "__parent", "children": "__run", "path": "__rest"})
    nth = F.expr(f"CAST(place % {FANOUT} AS INT)")
    step = F.struct(F.array_join(F.slice("__run", F.lit(1), nth), "").alias("left"), F.array_join(F.slice("__run", nth + 2, F.lit(FANOUT)), "").alias("right"))
    below = level.where("many > 1").withColumn("__parent", _up("place")).join(parents, ["tree", "__parent"])
    return alone.unionByName(below.withColumn("path", F.concat(F.array(step), "__rest")).drop("__parent", "__run", "__rest"))


def _pushed(leaves: DataFrame, levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The leaves with path, and what `tops` (tree, path, ...) has else."""
    above = None
    for level in reversed(levels):
        above = Table(_inherited(level.drop("digest"), above, tops).drop("many"), "paths", rebalance=False).df
    return _inherited(leaves, above, tops)


def proofs(docs: DataFrame, altered: dict[str, Column] | None = None, fields: tuple[str, ...] = FIELDS, part: str = "lang", order: str = "doc_id") -> DataFrame:
    """(order, leaf, subroot, root, path, altered_leaf): of every row, the manifest and a leaf's path through it.

    altered: other values of some fields, whose leaf is given beside the manifest's own."""
    values = {c: F.col(c) for c in fields}
    tree = F.coalesce(F.concat(F.lit("="), F.col(part).cast("string")), F.lit(""))  # no part sorts first, the rest by their bytes
    rows = docs.select(tree.alias("tree"), F.col(order).alias("id"), leaf(values).alias("digest"), leaf(values | (altered or {})).alias("altered_leaf"))
    leaves = _placed(Table(rows, "leaves", rebalance=False).df, "tree", ["id", "digest"])
    levels = _levels(leaves)
    subroots = Table(_roots(leaves, levels).select(F.lit("").alias("tree"), F.col("tree").alias("part"), "digest"), "subroots")
    tops = _placed(subroots.df, "tree", ["part"])
    upper = _levels(tops)
    root = _roots(tops, upper).select("tree", F.array().cast(_PATH).alias("path"), F.col("digest").alias("root"))
    tops = Table(_pushed(tops, upper, root).select(F.col("part").alias("tree"), F.col("digest").alias("subroot"), "root", "path"), "tops").df
    return _pushed(leaves, levels, tops).select(F.col("id").alias(order), F.col("digest").alias("leaf"), "subroot", "root", "path", "altered_leaf")


def proof_digest(path: str = "path") -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), ""), 256)


def folded(start: str, path: str = "path") -> Column:
    """The root that a leaf's digest and its siblings give."""
    return F.aggregate(path, F.col(start), lambda h, x: F.sha2(F.concat(x["left"], h, x["right"]), 256))


def manifest(docs: DataFrame) -> DataFrame:
    """The manifest of documents, and the proofs checked after texts with a CRC-32 of their doc_id divisible by 3 lost their capitals."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    hit = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    rows = proofs(docs, {"text": F.when(hit, F.translate("text", upper, lower)).otherwise(F.col("text"))})
    rows = rows.select("doc_id", "leaf", "subroot", "root", proof_digest().alias("proof_sha256"), folded("altered_leaf").alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
