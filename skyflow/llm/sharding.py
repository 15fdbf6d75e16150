"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``VIRTUAL`` points on a ring; a row belongs to the next point clockwise of its id's hash. A shard takes
no more than its capacity; rows beyond it go on clockwise to the next point whose shard has room. Capacities add up to
the number of rows and differ by one at most, so that is how even the shards are, whatever the ids.

Rows are numbered along the ring by a range partitioning, which cuts through any hot id. All that meets on the driver is
the number of rows in each arc between two points (shards x ``VIRTUAL`` numbers, whatever the size of the table); it
says which ranks of an arc go where, and every row reads its shard and its slot off its rank.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyflow.llm.common import written

VIRTUAL = 512


def ring(shards: int, virtual: int = VIRTUAL) -> tuple[np.ndarray, np.ndarray]:
    """Points of the ring in order, and the shard of each; more shards leave the points of the others in place."""
    import xxhash

    points = [(xxhash.xxh64_intdigest(f"{s}/{v}") - (1 << 63), s) for s in range(shards) for v in range(virtual)]
    points.sort()
    return np.array([p for p, _ in points], np.int64), np.array([s for _, s in points], np.int32)


def capacities(rows: int, shards: int) -> np.ndarray:
    return np.full(shards, rows // shards, np.int64) + (np.arange(shards) < rows % shards)


def place(counts: np.ndarray, owner: np.ndarray, shards: int) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, end rank, shard, slot of the first rank): where the rows of each arc go.

    All arcs ask their own shard first; what finds no room asks the next point clockwise, and so on. A shard that can't
    take all who ask takes them in the order of the ring, and of an arc the lowest ranks.
    """
    room, used = capacities(int(counts.sum()), shards), np.zeros(shards, np.int64)
    arcs = np.flatnonzero(counts)
    start, left = np.zeros(len(arcs), np.int64), counts[arcs].astype(np.int64)
    out, step = [], 0
    while len(arcs):
        asked = owner[(arcs + step) % len(owner)]
        order = np.argsort(asked, kind="stable")
        a, n, s = asked[order], left[order], start[order]
        before = np.cumsum(n) - n
        before -= np.repeat(before[np.r_[True, a[1:] != a[:-1]]], np.unique(a, return_counts=True)[1])
        taken = np.clip(room[a] - before, 0, n)
        got = taken > 0
        out += zip(arcs[order][got].tolist(), s[got].tolist(), (s + taken)[got].tolist(), a[got].tolist(), (used[a] + before)[got].tolist())
        total = np.zeros(shards, np.int64)
        np.add.at(total, a, taken)
        room, used = room - total, used + total
        rest = np.sort(order[n > taken])
        moved = np.empty_like(taken)
        moved[order] = taken
        arcs, start, left, step = arcs[rest], (start + moved)[rest], (left - moved)[rest], step + 1
    return out


def sharded(docs: DataFrame, shards: int, virtual: int = VIRTUAL) -> DataFrame:
    """doc_id, size, text_crc32, arc, rank, shard and slot of every row; counts of the shards differ by one at most.

    Size is the text's UTF-8 bytes plus 8; a null text has none and the crc32 of no bytes. An id is hashed by its text;
    all null ids lie at one point of the ring. Rows of one id or with equal contents are placed one by one, in the order
    of hash, id and contents, so a repeated id may be split over neighbouring shards. Slots are gapless from 0 in each
    shard. Other columns of ``docs`` are not looked at; an empty table gives no rows.
    """
    points, owner = ring(shards, virtual)
    id_type = docs.schema["doc_id"].dataType
    content = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id", (F.octet_length(content) + 8).cast("long").alias("size"), F.crc32(content).alias("text_crc32"),
        F.xxhash64(F.col("doc_id").cast("string")).alias("position"), F.monotonically_increasing_id().alias("row"),
    )
    rows = written(rows, "sizes")  # the range partitioning reads its input twice, once for the bounds: not the texts
    order = ["position", "doc_id", "text_crc32", "size", "row"]  # the last one parts rows that repeat

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in the order of the ring get their arc, and their number among the task's rows of that arc."""
        from pyspark import TaskContext

        part, arc, count = TaskContext.get().partitionId(), -1, 0
        for b in batches:
            if not b.num_rows:
                continue
            at = (np.searchsorted(points, b.column("position").to_numpy(), "left") % len(points)).astype(np.int32)
            first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
            length = np.diff(np.r_[first, len(at)])
            index = np.arange(len(at)) - np.repeat(first, length)
            if at[0] == arc:
                index[: length[0]] += count
            arc, count = at[-1], int(index[-1]) + 1
            # the points' arc reaches over the end of the ring: its rows before and behind the end have counts of their own
            behind = b.column("position").to_numpy() > points[-1]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("size"), b.column("text_crc32"), pa.array(at), pa.array(behind.astype(np.int32)),
                 pa.array(np.full(len(at), part, np.int32)), pa.array(index.astype(np.int64))],
                names=["doc_id", "size", "text_crc32", "arc", "behind", "part", "nth"])

    schema = f"doc_id {id_type.simpleString()}, size long, text_crc32 long, arc int, behind int, part int, nth long"
    along = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("row")
    along = written(along.mapInArrow(numbered, schema), "ring")
    runs = along.groupBy("arc", "behind", "part").agg(F.count("*").alias("n"), F.min("nth").alias("least"))
    ahead = Window.partitionBy("arc").orderBy("behind", "part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("arc", "behind", "part", "n", (F.coalesce(F.sum("n").over(ahead), F.lit(0)) - F.col("least")).alias("offset"))
    counts = np.zeros(len(points), np.int64)
    for arc, n in runs.groupBy("arc").agg(F.sum("n")).collect():  # at most one row a point of the ring
        counts[arc] = n
    spark = docs.sparkSession
    plan = spark.createDataFrame(place(counts, owner, shards), "arc int, low long, high long, shard int, slot0 long")
    ranked = along.join(runs.drop("n"), ["arc", "behind", "part"]).withColumn("rank", F.col("nth") + F.col("offset"))
    out = ranked.join(plan, (ranked["arc"] == plan["arc"]) & (ranked["rank"] >= plan["low"]) & (ranked["rank"] < plan["high"]))
    return out.select("doc_id", "size", "text_crc32", ranked["arc"], "rank", "shard", (F.col("slot0") + F.col("rank") - F.col("low")).alias("slot"))
