"""Connected components of an edge table by alternating star operations, with joins and minima only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyflow.session import cut_lineage

#: Edges of a task, about.
EDGES = 200_000

def components(edges: DataFrame) -> DataFrame:
    """node and root (smallest node reachable) for every node of ``edges`` (a, b); loops and nulls are left out.

    Each round hangs the larger neighbours of a node on its smallest one, then the smaller ones; rounds grow with
    the logarithm of the nodes. Minima are combined before the shuffle, and joins can be split by AQE, so a node of
    any degree is no hot key. Rounds are cut by reliable checkpoints; tasks follow the number of edges, so that a small
    table does not leave a file in every shuffle partition of every step.
    """
    now = cut_lineage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before, tasks = None, 1 + now.count() // EDGES
    while True:
        now = now.coalesce(tasks)
        # large star: neighbours above a node get the smallest node around it
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).coalesce(tasks).distinct()
        # small star: a node and its smaller neighbours get the smallest of them
        large = large.coalesce(tasks)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = cut_lineage(small.union(least.select("a", F.col("m").alias("b"))).coalesce(tasks).distinct().coalesce(tasks))
        state = now.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first()
        if state == before:
            break
        before = state
    return now.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
