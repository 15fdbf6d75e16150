"""Exact top-k by inner product as a Voronoi kNN join.

One more coordinate turns the largest inner products into the smallest distances: a candidate x gets
sqrt(M^2 - |x|^2), with M the largest norm, a query gets 0. Pivots part queries and candidates into cells; summaries
of the cells bound the k-th distance of every cell's queries; a candidate goes only to groups of query cells that its
distance to a pivot can't rule out, and each group is solved exactly against blocks of candidates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyflow.llm.common import map_rows, prepare, written

#: Pivots grow with the root of the number of vectors, within these bounds.
PIVOTS, MOST_PIVOTS = 64, 512
#: Queries of a group and candidates of a block that meet in one task, about.
GROUP, BLOCK = 2048, 16384


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column; shorter rows end with zeros."""
    ends, flat = np.asarray(column.offsets), column.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(ends)
    if (sizes == width).all():
        return flat[ends[0] : ends[-1]].reshape(-1, width)
    out = np.zeros((len(sizes), width), flat.dtype)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(ends[-1] - ends[0]) - np.repeat(ends[:-1] - ends[0], sizes)] = flat[ends[0] : ends[-1]]
    return out


class Cells:
    """Pivots in the space with one more coordinate, and distances to them."""

    def __init__(self, pivots: np.ndarray, top: float):
        self.pivots, self.top = pivots.astype(float), top
        self.lift = np.sqrt(np.maximum(top - (self.pivots**2).sum(1), 0))

    def distance(self, x: np.ndarray, query: bool) -> np.ndarray:
        x = x.astype(float)
        norm = (x**2).sum(1)
        lift = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.top - norm, 0))
        square = norm[:, None] + (lift**2)[:, None] + self.top - 2 * (x @ self.pivots.T + lift[:, None] * self.lift)
        return np.sqrt(np.maximum(square, 0))


def nearest_ids(d: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` different ids with the smallest distances, each with its smallest one, by distance."""
    order = np.lexsort((ids, d))
    d, ids = d[order], ids[order]
    first = np.sort(np.unique(ids, return_index=True)[1])[:k]
    return d[first], ids[first]


def bounds(cells: Cells, reach: np.ndarray, nearest: list[tuple[np.ndarray, np.ndarray]], k: int) -> np.ndarray:
    """For the queries of each cell, a distance within which candidates of k different ids lie (infinite with fewer).

    ``nearest`` has distances and ids of each cell's ``nearest_ids``.
    """
    p = np.hstack([cells.pivots, cells.lift[:, None]])
    apart = np.array([np.sqrt(((p - row) ** 2).sum(1)) for row in p])
    out = np.full(len(p), np.inf)
    for i in range(len(p)):
        through = np.concatenate([np.zeros(0), *(apart[i, j] + d for j, (d, _) in enumerate(nearest))])
        through, _ = nearest_ids(through, np.concatenate([np.zeros(0, np.int64), *(ids for _, ids in nearest)]), k)
        if len(through) == k:
            out[i] = reach[i] + through[-1]
    return out


def solve(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
    """(query, candidate, score) of each query's k best among x, ties to smaller ids; exact in whole numbers."""
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    most = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(1, x.shape[1])
    if most < 2**53:
        x, q = x.astype(float), q.astype(float)
    for lo in range(0, len(q), 64):
        scores = q[lo : lo + 64] @ x.T
        for own, row in zip(query_ids[lo : lo + 64], scores):
            row = row.astype(np.int64)
            other = np.flatnonzero(ids != own)
            row = row[other]
            if len(row) > k:
                at = np.flatnonzero(row >= np.partition(row, len(row) - k)[len(row) - k])
            else:
                at = np.arange(len(row))
            for j in at[np.argsort(-row[at], kind="stable")][:k]:
                yield int(own), int(ids[other[j]]), int(row[j])


def whole_vectors(vectors: DataFrame, vec: str = "embedding", scale: int = 1024) -> DataFrame:
    """``vec_id`` and ``v`` (floor of ``scale`` times each component, as longs); null ids, null vectors and those with
    null or non-finite components are left out."""
    x = F.col(vec)
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    kept = vectors.where(F.col("vec_id").isNotNull() & x.isNotNull() & fine)
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("v"))


def top_k(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: the ``k`` largest inner products of every query with other ids.

    ``vectors`` has vec_id and v (array of long). Shorter vectors count as padded with zeros. Rows of one vec_id are
    never candidates of a query of that id; a query id that comes repeatedly counts once, with its smallest vector.
    Fewer candidates than ``k`` give fewer rows; a table without queries or candidates gives none.
    """
    spark = prepare(vectors.sparkSession)
    base = written(vectors.select("vec_id", "v", is_query.alias("asks")), "vectors")
    square = F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c.cast("double"))
    n, asking, top, width = base.agg(F.count("*"), F.count_if("asks"), F.max(square), F.max(F.size("v"))).first()
    if not n or not asking or not width:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    pivots_wanted = min(MOST_PIVOTS, max(PIVOTS, int(n**0.5) // 4))
    share = min(1.0, 8 * pivots_wanted / n)
    limit = int((share - 0.5) * 2 * ((1 << 63) - 1)) if share < 1 else (1 << 63) - 1
    some = base.select("v").where(F.xxhash64("v") <= limit).distinct().orderBy(F.xxhash64("v"), "v").limit(pivots_wanted).collect()
    some = some or base.select("v").limit(1).collect()
    pivots = np.zeros((len(some), width), np.int64)
    for i, r in enumerate(some):
        pivots[i, : len(r["v"])] = r["v"]
    cells = Cells(pivots, top)
    # plain values: a broadcast is pickled by reference, and workers need not have this package
    shared = spark.sparkContext.broadcast((pivots, top))
    m = len(pivots)
    queries = written(base.where("asks").groupBy("vec_id").agg(F.min("v").alias("v")), "queries")

    def assign(it, query: bool):
        here = Cells(*shared.value)
        for b in it:
            d = here.distance(matrix(b.column("v"), width), query)
            cell = d.argmin(1)
            yield b, cell, d

    def nearest(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0), np.zeros(0, np.int64))] * m
        for b, cell, d in assign(it, False):
            ids = b.column("vec_id").to_numpy()
            for i in np.unique(cell):
                own = cell == i
                best[i] = nearest_ids(np.concatenate([best[i][0], d[own, i]]), np.concatenate([best[i][1], ids[own]]), k + 1)
        cells_of = np.repeat(np.arange(m, dtype=np.int32), [len(d) for d, _ in best])
        yield pa.RecordBatch.from_arrays([pa.array(cells_of), *(pa.array(np.concatenate(x)) for x in zip(*best))], names=["cell", "near", "vec_id"])

    def query_cells(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, cell, d in assign(it, True):
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("v"), pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(cell)), cell])], names=["vec_id", "v", "cell", "reach"])

    summary = base.select("vec_id", "v").mapInArrow(nearest, "cell int, near double, vec_id long").groupBy("cell", "vec_id").agg(F.min("near").alias("near"))
    summary = summary.groupBy("cell").agg(F.slice(F.sort_array(F.collect_list(F.struct("near", "vec_id"))), 1, k + 1).alias("near")).collect()
    queries = written(queries.mapInArrow(query_cells, "vec_id long, v array<long>, cell int, reach double"), "queries")
    asked = queries.groupBy("cell").agg(F.max("reach").alias("reach"), F.count("*").alias("n")).collect()
    near = [(np.zeros(0), np.zeros(0, np.int64))] * m
    for r in summary:
        near[r["cell"]] = tuple(np.array([x[c] for x in r["near"]], t) for c, t in (("near", float), ("vec_id", np.int64)))
    reach, number = np.zeros(m), np.zeros(m, np.int64)
    for r in asked:
        reach[r["cell"]], number[r["cell"]] = r["reach"], r["n"]
    slack = 1e-6 * (1 + float(np.sqrt(top)))
    within = bounds(cells, reach, near, k + 1) + reach + slack
    # cells with queries in groups of about GROUP queries; a larger cell is dealt over several groups
    group_of: dict[int, tuple[int, int]] = {}
    filled, groups = GROUP, 0
    for i in np.flatnonzero(number):
        if filled + number[i] > GROUP:
            parts = max(1, -(-int(number[i]) // GROUP))
            group_of[int(i)], groups, filled = (groups, parts), groups + parts, GROUP if parts > 1 else int(number[i])
        else:
            group_of[int(i)], filled = (groups - 1, 1), filled + int(number[i])
    first = np.full((m, 2), -1, np.int64)
    for i, (g, parts) in group_of.items():
        first[i] = g, parts
    sent = spark.sparkContext.broadcast((within, first))

    def send(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limit, to = sent.value
        for b, _, d in assign(it, False):
            near_cells = (d <= limit) & (to[:, 0] >= 0)
            goes = []
            for row in near_cells:
                goes.append(sorted({int(g) for i in np.flatnonzero(row) for g in range(to[i, 0], to[i, 0] + to[i, 1])}))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("v"), pa.array(goes, pa.list_(pa.int32()))], names=["vec_id", "v", "goes"])

    data = written(base.select("vec_id", "v").mapInArrow(send, "vec_id long, v array<long>, goes array<int>"), "sent")
    # a group's blocks follow what was sent to it; queries go to these blocks only
    blocks = data.select(F.explode("goes").alias("grp")).groupBy("grp").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    blocks = written(blocks, "blocks")
    data = data.select(F.explode("goes").alias("grp"), "vec_id", "v").join(blocks, "grp")
    data = data.select("grp", F.pmod(F.xxhash64("vec_id", "v"), "blocks").cast("int").alias("block"), "vec_id", "v")
    places = F.create_map(*(F.lit(x) for i, (g, parts) in group_of.items() for x in (i, g)))
    several = F.create_map(*(F.lit(x) for i, (g, parts) in group_of.items() for x in (i, parts)))
    grp = (places[F.col("cell")] + F.pmod(F.xxhash64("vec_id"), several[F.col("cell")])).cast("int")
    queries = queries.select(grp.alias("grp"), "vec_id", "v").join(blocks, "grp")
    queries = queries.select("grp", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "vec_id", "v")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        q, x = ([t.column("vec_id").to_numpy(), matrix(t.column("v").combine_chunks(), width)] if len(t) else None for t in (left, right))
        rows = list(solve(*x, *q, k)) if q and x else []
        names = ("query_id", "vec_id", "score")
        return pa.table({c: pa.array([r[i] for r in rows], pa.int64()) for i, c in enumerate(names)})

    found = queries.groupBy("grp", "block").cogroup(data.groupBy("grp", "block")).applyInArrow(meet, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
