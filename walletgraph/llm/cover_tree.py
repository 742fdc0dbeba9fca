"""Exact top-k search by inner product with a cover tree over queries and one over data.

Vectors become integers, floor(256 x), and are dealt into cells, each around a pivot; cells into blocks of
bounded size. Queries travel in bundles, a few cells' worth to a chunk; a block meets a chunk in one task,
which indexes both and descends the two trees together. For nodes with centres a, b and covering radii r, s,
no inner product exceeds <a,b> + r|b| + s|a| + rs. A pair of nodes is skipped if that is less than the worst
k-th score of the queries below the first; equal scores are looked at, as they may belong to a smaller id.
A first pass gives each query a k-th score from a block of its own cell: with it the second pass starts, and
cells that no query of a chunk can gain from are not sent to it at all. The tasks' best k are then merged.

Pivots are a bounded sample; which they are changes the cost only.

Defined cases: vectors that are null or hold null, NaN or infinite components, empty vectors, and rows with a
null vec_id, take no part; rows that repeat a vec_id count once, with the least vector; vectors of different
dimensions are not compared; with fewer than k candidates all are returned; an empty table gives no rows.
Vectors so long that a score might not fit a long are an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from walletgraph.shared import Table, received, send

SCALE, K, EVERY = 256, 5, 50
#: Vectors in a block of data, and queries in a chunk.
BLOCK, GROUP = 8192, 16384
#: Pivots at most, of all dimensions.
PIVOTS = 256
#: Points of a leaf on average, of data and of queries.
LEAF, FEW = 48, 16
#: Below every score.
_NONE = np.int64(1 - (1 << 63))


class CoverTree:
    """Nodes as lists: centre, covering radius, level, children and, at leaves, points.

    Points are chosen farthest first. Those chosen at a distance of more than 2^l from all before are the net
    of level l: its points are more than 2^l apart, every point is within 2^l of one, and each level's net is
    in that of the next level down. A node's parent is the nearest point of the next net up, itself if it is
    in it; levels without branches are left out. The tree ends with a net of n / leaf points at most."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.leaf, self.points = leaf, points
        self.centre, self.radius, self.level, self.children, self.own, self.below = [], [], [], [], [], []
        if len(points):
            self._build()
        self.centre = np.array(self.centre, dtype=np.float64).reshape(len(self.radius), -1)
        self.radius = np.array(self.radius)
        self.length = np.sqrt((self.centre**2).sum(axis=1))

    def _build(self) -> None:
        p = self.points
        away = lambda i, q: np.sqrt(((q - p[i]) ** 2).sum(axis=1))
        chosen, tops, near, which = [0], [np.inf], away(0, p), np.zeros(len(p), np.int64)
        while len(chosen) <= len(p) // self.leaf:
            far = int(near.argmax())
            if near[far] <= 0:
                break
            tops.append(np.ceil(np.log2(near[far])) - 1)  # the highest level whose net has it
            dist = away(far, p)
            closer = dist < near
            near[closer], which[closer] = dist[closer], len(chosen)
            chosen.append(far)
        tops, nets = np.array(tops), p[chosen]
        kids: list[list[int]] = [[] for _ in chosen]
        for i in range(1, len(chosen)):
            above = np.flatnonzero(tops[:i] > tops[i])
            kids[above[away(chosen[i], nets[above]).argmin()]].append(i)
        cells = [np.flatnonzero(which == i) for i in range(len(chosen))]

        def add(i: int, below: float) -> int:
            """The node of a point of a net, of its branches under a level."""
            own = [c for c in kids[i] if tops[c] < below]
            at = len(self.radius)
            for x, y in ((self.centre, p[chosen[i]]), (self.radius, 0.0), (self.level, below), (self.children, []), (self.own, None), (self.below, None)):
                x.append(y)
            if own:
                level = max(tops[c] for c in own)
                self.level[at] = level + 1
                self.children[at] = [add(i, level), *(add(c, level) for c in own if tops[c] == level)]
                self.below[at] = np.concatenate([self.below[c] for c in self.children[at]])
            else:
                self.level[at] = -np.inf
                self.own[at] = self.below[at] = cells[i]
            self.radius[at] = float(away(chosen[i], p[self.below[at]]).max()) if len(self.below[at]) else 0.0
            return at

        add(0, np.inf)


def search(queries: np.ndarray, query_ids: np.ndarray, data: np.ndarray, ids: np.ndarray, k: int, least: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Query ids, ids and scores of the best k of each query, and how many scores were looked at.

    least: a score for each query that k others reach; lower ones are left out."""
    left, right = CoverTree(queries, FEW), CoverTree(data)
    best = np.full((len(queries), k), _NONE)
    best_id = np.full((len(queries), k), np.iinfo(np.int64).max)
    worst = np.full(len(queries), _NONE) if least is None else least.copy()
    exact = np.abs(queries).max(initial=0.0) * np.abs(data).max(initial=0.0) * queries.shape[1] < 2**53
    whole = (queries, data) if exact else (queries.astype(np.int64), data.astype(np.int64))
    seen = 0

    def compare(q: np.ndarray, d: np.ndarray) -> None:
        nonlocal seen
        seen += len(q) * len(d)
        score = (whole[0][q] @ whole[1][d].T).astype(np.int64)
        score[query_ids[q][:, None] == ids[d][None, :]] = _NONE
        some = score.max(axis=1) >= worst[q]
        if not some.any():
            return
        q, score = q[some], score[some]
        scores = np.concatenate([best[q], score], axis=1)
        names = np.concatenate([best_id[q], np.where(score == _NONE, np.iinfo(np.int64).max, np.broadcast_to(ids[d], score.shape))], axis=1)
        order = np.lexsort((names, -scores), axis=-1)[:, :k]
        best[q], best_id[q] = np.take_along_axis(scores, order, 1), np.take_along_axis(names, order, 1)
        worst[q] = np.maximum(worst[q], best[q, k - 1])

    def bounds(q: int, d) -> np.ndarray:
        top = right.centre[d] @ left.centre[q] + left.radius[q] * right.length[d] + right.radius[d] * left.length[q] + left.radius[q] * right.radius[d]
        return top + 1e-9 * np.abs(top) + 1e-3

    def descend(q: int, d: int, bound: float) -> None:
        if not len(right.below[d]) or bound < worst[left.below[q]].min():
            return
        if left.own[q] is None and (right.own[d] is not None or left.radius[q] >= right.radius[d]):
            for part in left.children[q]:
                if len(left.below[part]):
                    descend(part, d, float(bounds(part, np.array([d]))[0]))
        elif right.own[d] is None:
            parts = np.array(right.children[d])
            tops = bounds(q, parts)
            for i in np.argsort(-tops):
                descend(q, int(parts[i]), float(tops[i]))
        else:
            for lo in range(0, len(right.own[d]), 4096):  # a leaf of equal vectors may be large
                compare(left.own[q], right.own[d][lo : lo + 4096])

    if len(queries) and len(data):
        descend(0, 0, np.inf)
    found = best != _NONE
    return np.repeat(query_ids, k).reshape(-1, k)[found], best_id[found], best[found], seen


def _matrix(cells: pa.Array, size: int) -> np.ndarray:
    return cells.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(size, -1) if size else np.zeros((0, 1))


def _nearest(v: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    apart = np.maximum((v**2).sum(axis=1)[:, None] - 2 * v @ pivots.T + (pivots**2).sum(axis=1)[None, :], 0)
    cell = apart.argmin(axis=1)
    return cell, np.sqrt(((v - pivots[cell]) ** 2).sum(axis=1))


def _chunks(cells: list, group: int) -> list[tuple]:
    """(dim, cell, part, parts, chunk): cells with queries in chunks of about `group` queries; larger ones in parts."""
    out, chunk, held = [], 0, 0
    for dim, cell, asked in cells:
        parts = -(-asked // group)
        for part in range(parts):
            if held and held + asked / parts > group:
                chunk, held = chunk + 1, 0
            out.append((dim, cell, part, parts, chunk))
            held += asked / parts
    return out


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """(query_id, rank, vec_id, score): for each vec_id divisible by `every`, the k best others, ties to the smaller vec_id."""
    spark = vectors.sparkSession
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & usable)
    rows = rows.select("vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE)).alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))
    rows = Table(rows.withColumn("dim", F.size("v")).where("dim > 0"), "vectors")
    longest = F.max(F.array_max(F.transform("v", lambda x: F.abs(x.cast("double")))))
    sizes = rows.df.groupBy("dim").agg(F.count("*").alias("n"), longest.alias("top")).orderBy("dim").collect()  # a row for each dimension
    if any(r.top * r.top * r.dim >= 2.0**63 for r in sizes):
        raise ValueError("vectors are so long that a score may not fit a long")
    total = sum(r.n for r in sizes)
    sample = rows.df.orderBy(F.xxhash64("vec_id"), "vec_id").limit(min(PIVOTS, max(1, -(-total // block)))).collect()
    pivots = {r.dim: np.array([x.v for x in sample if x.dim == r.dim], np.float64) if any(x.dim == r.dim for x in sample) else np.zeros((1, r.dim)) for r in sizes}
    sent = send(spark, pivots)

    def place(batches):
        known = received(sent)
        for batch in batches:
            dims = batch["dim"].to_numpy()
            cell, away = np.zeros(len(dims), np.int32), np.zeros(len(dims))
            for dim in np.unique(dims).tolist():
                own = np.flatnonzero(dims == dim)
                cell[own], away[own] = _nearest(_matrix(batch["v"].take(pa.array(own)), len(own)), known[dim])
            yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["v"], batch["dim"], pa.array(cell), pa.array(away)], ["vec_id", "v", "dim", "cell", "away"])

    is_query = F.pmod("vec_id", F.lit(every).cast("long")) == 0
    placed = Table(rows.df.mapInArrow(place, "vec_id long, v array<long>, dim int, cell int, away double").withColumn("asked", is_query), "placed")
    rows.drop()
    stats = placed.df.groupBy("dim", "cell").agg(F.count("*").alias("n"), F.max("away").alias("radius"), F.count_if("asked").alias("asked"), F.max(F.when(F.col("asked"), F.col("away"))).alias("reach")).orderBy("dim", "cell").collect()
    chunks = _chunks([(r.dim, r.cell, r.asked) for r in stats if r.asked], group)
    spread = F.xxhash64("vec_id")
    plan = spark.createDataFrame(chunks, "dim int, cell int, part int, parts int, chunk int")
    sizes = [(r.dim, r.cell, max(1, -(-r.n // block))) for r in stats]
    counts = spark.createDataFrame(sizes, "dim int, cell int, blocks int")
    queries = placed.df.where("asked").join(plan, ["dim", "cell"]).where(F.pmod(spread, F.col("parts").cast("long")) == F.col("part")).select("dim", "cell", "chunk", "vec_id", "v")
    data = placed.df.join(counts, ["dim", "cell"]).select("dim", "cell", F.pmod(F.shiftright(spread, 20), F.col("blocks").cast("long")).cast("int").alias("block"), "vec_id", "v")

    def bundle(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        v = _matrix(table["v"].chunk(0), table.num_rows)
        cells = {"ids": table["vec_id"].to_numpy().tobytes(), "vectors": v.tobytes(), "least": table["least"].to_numpy().tobytes()}
        return pa.table({c: table[c][:1] for c in ("dim", "cell", "chunk")} | {c: pa.array([x], pa.binary()) for c, x in cells.items()})

    bundled = "dim int, cell int, chunk int, ids binary, vectors binary, least binary"

    def meet(own: pa.Table, asked: pa.Table) -> pa.Table:
        out = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if own.num_rows and asked.num_rows:
            own = own.combine_chunks()
            v = _matrix(own["v"].chunk(0), own.num_rows)
            ids, least = (np.frombuffer(b"".join(asked[c].to_pylist()), np.int64) for c in ("ids", "least"))
            q = np.frombuffer(b"".join(asked["vectors"].to_pylist()), np.float64).reshape(len(ids), -1)
            for x, y in zip(out, search(q, ids, v, own["vec_id"].to_numpy(), k, least), strict=False):
                x.append(y)
        return pa.table({name: np.concatenate(x) for name, x in zip(("query_id", "vec_id", "score"), out, strict=True)})

    kind = "query_id long, vec_id long, score long"
    alone = queries.withColumn("least", F.lit(int(_NONE))).groupBy("dim", "cell", "chunk").applyInArrow(bundle, bundled)
    first = data.where("block = 0").join(plan.select("dim", "cell", "chunk"), ["dim", "cell"]).groupBy("dim", "cell", "chunk").cogroup(alone.groupBy("dim", "cell", "chunk")).applyInArrow(meet, kind)
    known = first.groupBy(F.col("query_id").alias("vec_id")).agg(F.count("*").alias("n"), F.min("score").alias("score")).where(F.col("n") >= k).select("vec_id", F.col("score").alias("least"))
    queries = Table(queries.join(known, "vec_id", "left").withColumn("least", F.coalesce("least", F.lit(int(_NONE)))), "queries")
    floors = {(r.dim, r.cell, r.chunk): r.least for r in queries.df.groupBy("dim", "cell", "chunk").agg(F.min("least").alias("least")).collect()}
    pairs = _meetings(stats, chunks, floors, pivots)
    many = {(dim, cell): n for dim, cell, n in sizes}
    keys = ["dim", "cell", "block", "chunk"]
    asked = queries.df.groupBy("dim", "cell", "chunk").applyInArrow(bundle, bundled).drop("cell")
    asked = spark.createDataFrame([(*x, many[x[:2]]) for x in pairs], "dim int, cell int, chunk int, blocks int").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).join(asked, ["dim", "chunk"]).select(*keys, "ids", "vectors", "least")
    found = data.join(spark.createDataFrame(pairs, "dim int, cell int, chunk int"), ["dim", "cell"]).groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(meet, kind)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _meetings(stats: list, chunks: list[tuple], floors: dict, pivots: dict[int, np.ndarray]) -> list[tuple]:
    """(dim, cell, chunk): cells of data that may hold one of the best of a chunk's queries; some 300,000 rows for a billion vectors."""
    reach = {(r.dim, r.cell): r.reach for r in stats}
    out = set()
    for dim in sorted(pivots):
        own = [r for r in stats if r.dim == dim]
        centre = pivots[dim][[r.cell for r in own]]
        radius, length = np.array([r.radius for r in own]), np.sqrt((centre**2).sum(axis=1))
        for d, cell, _, _, chunk in chunks:
            if d == dim:
                q, s = pivots[dim][cell], reach[dim, cell]
                top = centre @ q + s * length + radius * np.sqrt(q @ q) + s * radius
                ok = top + 1e-9 * np.abs(top) + 1e-3 >= floors.get((dim, cell, chunk), _NONE)
                out |= {(dim, r.cell, chunk) for r, x in zip(own, ok.tolist(), strict=True) if x}
    return sorted(out)
