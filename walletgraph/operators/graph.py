"""Connected components of edge tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walletgraph.shared import Table

#: Edges that a task solves at a time, and rows of forests that one task is given; and bytes of their nodes if these are strings.
SMALL, SMALL_BYTES = 2_000_000, 64 << 20
#: Rows of a forest that a task hands back at a time.
BATCH = 1 << 16
#: Forests are merged as long as that leaves fewer rows than this share.
SHRINKS = 0.9


def _roots(x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """Of nodes 0 .. n-1 the smallest one of each one's component; hooks roots to smaller ones, then halves paths."""
    root = np.arange(n, dtype=x.dtype)
    while True:
        p, q = root[x], root[y]
        if (p == q).all():
            return root
        np.minimum.at(root, np.maximum(p, q), np.minimum(p, q))
        while (root != root[root]).any():
            root = root[root]


def union_find(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes in order, and the smallest node of each one's component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    return nodes, nodes[_roots(at[: len(a)], at[len(a) :], len(nodes))]


def _solve(table: pa.Table) -> pa.Table:
    """union_find() of columns a and b. Nodes stay in Arrow, each once, and edges are numbers of four bytes: names as Python's strings would take ten times as much."""
    coded = pa.chunked_array(table["a"].chunks + table["b"].chunks, table["a"].type).dictionary_encode()
    at, nodes = np.concatenate([c.indices.to_numpy() for c in coded.chunks]), coded.chunk(0).dictionary
    order = pc.sort_indices(nodes).to_numpy()
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    at, nodes = rank[at], nodes.take(pa.array(order))
    return pa.table({"a": nodes, "b": nodes.take(pa.array(_roots(at[: len(table)], at[len(table) :], len(nodes))))})


def _flat(edges: DataFrame) -> Table:
    """(a, b): each node a that has a smaller neighbour, with the root b that smallest neighbours lead to; a root has no smaller one.

    Pointers are doubled, so a path takes as many joins as its length has bits."""
    at = Table(edges.groupBy("a").agg(F.min("b").alias("b")), "least")
    while True:
        far = at.df.select(F.col("a").alias("b"), F.col("b").alias("c"))
        new = Table(at.df.join(far, "b", "left").select("a", F.coalesce("c", "b").alias("b"), F.col("c").isNotNull().alias("moved")), "least")
        flat = new.df.where("moved").isEmpty()
        at.drop()
        at, new.df = new, new.df.drop("moved")
        if flat:
            return at


def _relabel(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """The edges between the roots, each once, (larger, smaller)."""
    x, y = roots.select("a", F.col("b").alias("x")), roots.select(F.col("a").alias("b"), F.col("b").alias("y"))
    ends = edges.join(x, "a").join(y, "b", "left").select("x", F.coalesce("y", "b").alias("y"))
    return ends.where("x <> y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


def _forest(edges: DataFrame, most: int) -> DataFrame:
    """(a, b, task): of each task's edges a spanning forest only, as stars: every node with the smallest one that it is connected to there, itself if that is it.

    A task works on `most` edges at a time, or on twice SMALL_BYTES of them, with the forest of those before them; a forest of more than half as many is left as it is, under a number of its own."""
    kind, most_bytes = edges.schema["a"].dataType.simpleString(), 2 * SMALL_BYTES

    def run(batches):
        held, many, size = [], 0, 0

        def stars() -> pa.Table:
            found = _solve(pa.Table.from_batches(held))
            held.clear()
            return found

        def out(table: pa.Table):
            nonlocal turn
            turn += 1
            return table.append_column("task", pa.array(np.full(len(table), task << 32 | turn, np.int64))).to_batches(max_chunksize=BATCH)

        task, turn = TaskContext.get().partitionId(), 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                many, size = many + batch.num_rows, size + batch.nbytes
            if many > most or size > most_bytes:
                found = stars()
                many, size = len(found), found.nbytes
                if many > most // 2 or size > most_bytes // 2:
                    yield from out(found)
                    many = size = 0
                else:
                    held += found.to_batches(max_chunksize=BATCH)
        if held:
            yield from out(stars())
        pa.default_memory_pool().release_unused()

    return edges.select("a", "b").mapInArrow(run, f"a {kind}, b {kind}, task long")


def contract(edges: DataFrame, most: int = SMALL) -> tuple[Table, bool]:
    """A forest that connects what the edges (a, b) do, and whether it is the stars of whole components.

    Each task keeps a forest of its edges, before anything is exchanged; forests are then merged, several to a task and again,
    as long as there are fewer rows each time. They are whole once one task has met them all, which it does if they are few."""
    kind = edges.schema["a"].dataType.simpleString()
    held = Table(_forest(edges, most), "forest", rebalance=False)
    length = F.sum(F.octet_length("a") + F.octet_length("b")) if kind in ("string", "binary") else F.lit(0)
    measure = lambda t: t.df.agg(F.count("*"), F.count_distinct("task"), length).first()
    rows, tasks, width = measure(held)
    while tasks > 1:
        parts = max(-(-rows // max(most, 1)), -(-(width or 0) // SMALL_BYTES))
        if parts >= tasks:
            break
        new = Table(_forest(held.df.coalesce(parts), most), "forest", rebalance=False)
        held.drop()
        before, held = rows, new
        rows, tasks, width = measure(held)
        if tasks > 1 and rows > SHRINKS * before:
            break
    return held, tasks <= 1


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", small: int = SMALL) -> DataFrame:
    """(node, component): every node that edges name, with the smallest node that it is connected to.

    Tasks contract their own edges to forests and merge these (see contract()), `small` rows to a task at most; what that
    leaves unfinished is solved by rounds of joins, each written to the shared folder: every node goes to the root that its smallest
    neighbours lead to, and the next round has the edges between roots only. A root that stays either took up all its neighbours or has
    a smaller one in the next round, so two rounds halve the nodes. Null ends are ignored; an edge from a node to itself only names it.
    """
    named = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    forest, whole = contract(named, max(small, 1)) if small else (Table(named, "edges"), False)
    if whole:
        return forest.df.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = forest.df.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("component", F.col("node"))
    current, edges, rounds = forest, forest.df.where("a <> b").select("a", "b"), []
    while not edges.isEmpty():
        rounds.append(_flat(edges))
        new = Table(_relabel(edges, rounds[-1].df), "edges")
        if current is not forest:
            current.drop()
        current, edges = new, new.df
    for x in rounds:
        found = found.join(x.df.select(F.col("a").alias("component"), "b"), "component", "left").select("node", F.coalesce("b", "component").alias("component"))
    out = Table(found, "components")
    for x in {id(t): t for t in (forest, current, *rounds)}.values():
        x.drop()
    return out.df
