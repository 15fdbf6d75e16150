"""SimHash fingerprints and their links within a Hamming radius, found in BK-trees.

Of ``radius + t`` blocks of bits, fingerprints that differ in at most ``radius`` bits agree in some ``t``.
Fingerprints that agree in such blocks make a shard; a shard's BK-tree has children keyed by the Hamming distance to
their parent, and a search follows only edges within the radius. All trees of a task are built and searched together,
level by level, on arrays. ``t`` grows with the logarithm of the fingerprints, so shards stay small; links don't change.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyflow.llm.common import begin, prepare, written
from skyflow.llm.components import components

#: Fingerprints of a shard, about, when they are spread evenly.
SHARD = 64
#: Fingerprints of one shard that one task looks up; larger shards send their tree to more tasks.
SEARCHED = 4096
_BITS = np.array([[i >> k & 1 for k in range(8)] for i in range(256)], np.int64)


def fingerprint(text: str | None, words: int = 3) -> int:
    """Unsigned 64-bit SimHash of the word shingles, repeats included; 0 without words.

    A-Z is lower-cased; words are parted by ASCII white space; fewer words than ``words`` make one shingle.
    """
    from xxhash import xxh64_intdigest

    split = text.encode().lower().split() if text else []
    if not split:
        return 0
    if len(split) <= words:
        hashes = [xxh64_intdigest(b" ".join(split), 42)]
    else:
        join = b" ".join
        hashes = [xxh64_intdigest(join(w), 42) for w in zip(*(split[k:] for k in range(words)))]
    h = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)
    set_bits = np.concatenate([np.bincount(h[:, k], minlength=256) @ _BITS for k in range(8)])  # little-endian
    return int(np.packbits(set_bits * 2 > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id and fingerprint (signed long) of every row; other columns are not looked at."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin()
        for b in it:
            prints = np.array([fingerprint(t, words) for t in b.column("text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(prints)], names=["doc_id", "fingerprint"])

    prepare(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(batches, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fingerprint long")


def with_fingerprint(docs: DataFrame, name: str, words: int = 3, text: str = "text") -> DataFrame:
    """``docs`` with the fingerprint (signed long) of every row's text, the column ``text``."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64))

    prepare(docs.sparkSession)
    return docs.withColumn(name, of(text))


def shards(radius: int, number: int) -> list[int]:
    """Masks of bits such that any two fingerprints within ``radius`` agree under one of them.

    For so many fingerprints, spread evenly, a shard has about ``SHARD`` or fewer.
    """
    agree = 1
    while agree < 6 and number >> (64 // (radius + agree)) * agree > SHARD:
        agree += 1
    blocks = [sum(1 << int(b) for b in part) for part in np.array_split(np.arange(64), radius + agree)]
    return [sum(some) for some in combinations(blocks, agree)]


class Forest:
    """BK-trees over points of many shards; the first point of a shard is its root."""

    def __init__(self, shard: np.ndarray, value: np.ndarray):
        """``shard``: sorted numbers from 0; ``value``: distinct unsigned fingerprints within a shard."""
        n = len(value)
        self.value, self.root = value, np.searchsorted(shard, np.arange(int(shard[-1]) + 1 if n else 0))
        parent, edge, level = [], [], []
        rest = np.setdiff1d(np.arange(n), self.root, assume_unique=True)
        above = self.root[shard[rest]]
        while len(rest):
            key = above * 65 + np.bitwise_count(value[rest] ^ value[above]).astype(np.int64)
            order = np.argsort(key, kind="stable")
            rest, key = rest[order], key[order]
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            child = rest[first]
            edge.append(key[first])
            level.append(child)
            below = np.repeat(child, np.diff(np.r_[first, len(key)]))
            keep = np.ones(len(rest), bool)
            keep[first] = False
            rest, above = rest[keep], below[keep]
        key, child = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (edge, level))
        order = np.argsort(key)
        self.key, self.child = key[order], child[order]

    def search(self, value: np.ndarray, root: np.ndarray, radius: int, at_once: int = 2_000_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (place in ``value``, point) within ``radius``; at most about ``at_once`` steps are open at a time."""
        stack = [(np.arange(len(value)), root)]
        while stack:
            query, node = stack.pop()
            if len(query) > at_once:
                half = len(query) // 2
                stack += [(query[:half], node[:half]), (query[half:], node[half:])]
                continue
            d = np.bitwise_count(value[query] ^ self.value[node]).astype(np.int64)
            near = d <= radius
            if near.any():
                yield query[near], node[near]
            low = np.searchsorted(self.key, node * 65 + np.maximum(d - radius, 0))
            high = np.searchsorted(self.key, node * 65 + np.minimum(d + radius, 64), side="right")
            n = high - low
            some = np.flatnonzero(n)
            for lo in range(0, len(some), at_once // 65):  # a node has at most 65 children
                s = some[lo : lo + at_once // 65]
                start = np.cumsum(n[s]) - n[s]
                at = np.repeat(low[s] - start, n[s]) + np.arange(int(n[s].sum()))
                stack.append((np.repeat(query[s], n[s]), self.child[at]))


class Union:
    """Sets of points joined pair by pair, on arrays; a set's label is its smallest point."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while True:
            x, y = label[a], label[b]
            open_ = x != y
            if not open_.any():
                return
            a, b, x, y = a[open_], b[open_], x[open_], y[open_]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while (label[label] != label).any():
                label[:] = label[label]


class ShortestLinks:
    """Minimum spanning forests of the links added, by distance, then by place; links are held in bounded blocks.

    The first forest takes the shortest links, each further one those of the links that are left. ``more`` marks
    points with links beyond the last forest.
    """

    def __init__(self, value: np.ndarray, block: int = 2_000_000, forests: int = 1):
        self.value, self.block, self.forests, self.a, self.b = value, block, forests, [], []
        self.label, self.more = np.arange(len(value)), np.zeros(len(value), bool)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        apart = a != b
        self.a.append(np.minimum(a, b)[apart])
        self.b.append(np.maximum(a, b)[apart])
        if sum(map(len, self.a)) > self.block + self.forests * len(self.value):
            self.forest()

    def forest(self) -> tuple[np.ndarray, np.ndarray]:
        none = np.zeros(0, np.int64)
        a, b = np.concatenate([none, *self.a]), np.concatenate([none, *self.b])
        order = np.lexsort((b, a, np.bitwise_count(self.value[a] ^ self.value[b])))
        a, b = a[order], b[order]
        once = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])][: len(a)]
        a, b = a[once], b[once]
        kept, rest = [none], np.arange(len(a))
        for k in range(self.forests):
            if not len(rest):
                break
            union, live, taken = Union(len(self.value)), rest, [none]
            while True:  # every set takes its first link to another set
                x, y = union.label[a[live]], union.label[b[live]]
                live, x, y = live[x != y], x[x != y], y[x != y]
                if not len(live):
                    break
                first = np.full(len(self.value), len(a))
                np.minimum.at(first, x, live)
                np.minimum.at(first, y, live)
                taken.append(np.unique(first[first < len(a)]))
                union.add(a[taken[-1]], b[taken[-1]])
            self.label = union.label if k == 0 else self.label
            kept += taken
            rest = np.setdiff1d(rest, np.concatenate(taken), assume_unique=True)
        self.more[a[rest]] = self.more[b[rest]] = True
        kept = np.sort(np.concatenate(kept))
        self.a, self.b = [a[kept]], [b[kept]]
        return a[kept], b[kept]


def dealt(prints: DataFrame, radius: int) -> DataFrame:
    """shard, bits, part, fingerprint and asks: the distinct fingerprints of every shard; of a large shard every part
    holds all of them, and each asks in one part."""
    distinct = written(prints.select("fingerprint").distinct(), "prints")
    masks = [m - (1 << 64) if m >> 63 else m for m in shards(radius, distinct.count())]
    keyed = distinct.select(
        "fingerprint",
        F.explode(F.array(*(F.struct(F.lit(i).alias("shard"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(masks)))).alias("s"),
    ).select("fingerprint", "s.shard", "s.bits")
    large = keyed.groupBy("shard", "bits").agg(F.count("*").alias("n")).where(F.col("n") > SEARCHED)
    parts = F.coalesce(F.ceil(F.col("n") / SEARCHED).cast("int"), F.lit(1))
    own = F.pmod(F.xxhash64("fingerprint"), F.col("parts"))
    return (
        keyed.join(large, ["shard", "bits"], "left").withColumn("parts", parts)
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("shard", "bits", "part", "fingerprint", (own == F.col("part")).alias("asks"))
    )


def linked(prints: DataFrame, radius: int = 3, shortest: bool = False) -> DataFrame:
    """Edges (a, b) between distinct fingerprints of ``prints`` that connect all those within ``radius``.

    Each task returns a spanning forest of the links that it finds, so near copies make no more edges than points.
    With ``shortest`` every edge is itself a link, and the forest takes the shortest ones.
    """

    def find(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin()
        held = list(it)
        if not held:
            return
        t = pa.Table.from_batches(held)
        columns = [t.column(c).to_numpy() for c in ("shard", "bits", "part", "fingerprint")]
        asks = t.column("asks").to_numpy()
        order = np.lexsort(columns[::-1])
        shard, bits, part, prints = (c[order] for c in columns)
        asks, value = asks[order], prints.view(np.uint64)
        new = np.r_[True, (shard[1:] != shard[:-1]) | (bits[1:] != bits[:-1]) | (part[1:] != part[:-1])]
        tree = np.cumsum(new) - 1
        forest, links = Forest(tree, value), ShortestLinks(value) if shortest else Union(len(value))
        asking = np.flatnonzero(asks)
        for q, node in forest.search(value[asking], forest.root[tree[asking]], radius):
            links.add(asking[q], node)
        if shortest:
            a, b = links.forest()
        else:
            a = np.flatnonzero(links.label != np.arange(len(value)))
            b = links.label[a]
        yield pa.RecordBatch.from_arrays([pa.array(prints[a]), pa.array(prints[b])], names=["a", "b"])

    return dealt(prints, radius).repartition("shard", "bits", "part").mapInArrow(find, "a long, b long").distinct()


_OPEN = "shard int, bits long, part int, tree long, fingerprint long, asks boolean"


def unjoined(open_: DataFrame, radius: int, forests: int) -> DataFrame:
    """Links within ``radius`` between fingerprints of different ``root``, and the points with more of them.

    ``open_`` has the columns of ``dealt``, ``tree`` (connected points of a shard) and ``root``. Every tree gives up to
    ``forests`` spanning forests of its links as rows with ``link``; where these are not all its links, the points of
    the connected set come as rows without one, to be searched again.
    """
    keys = ["shard", "bits", "part", "tree"]

    def find(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin()
        held = list(it)
        if not held:
            return
        t = pa.Table.from_batches(held)
        columns = [t.column(c).to_numpy() for c in (*keys, "fingerprint")]
        order = np.lexsort(columns[::-1])
        columns = [c[order] for c in columns]
        asks, root = t.column("asks").to_numpy()[order], t.column("root").to_numpy()[order]
        prints = columns[-1]
        value = prints.view(np.uint64)
        new = np.zeros(len(value), bool)
        for c in columns[:-1]:
            new[1:] |= c[1:] != c[:-1]
        tree = np.cumsum(new)
        forest, links = Forest(tree, value), ShortestLinks(value, forests=forests)
        asking = np.flatnonzero(asks)
        for q, node in forest.search(value[asking], forest.root[tree[asking]], radius):
            apart = root[asking[q]] != root[node]
            links.add(asking[q][apart], node[apart])
        a, b = links.forest()
        again = np.flatnonzero(np.isin(links.label, links.label[links.more]))
        at = np.r_[a, again]
        out = [c[at] for c in columns[:3]] + [prints[np.r_[a, links.label[again]]], prints[at], asks[at]]
        link = pa.array(np.r_[prints[b], prints[again]], mask=np.arange(len(at)) >= len(a))
        yield pa.RecordBatch.from_arrays([*map(pa.array, out), link], names=[*keys, "fingerprint", "asks", "link"])

    return open_.select(*keys, "fingerprint", "asks", "root").repartition(*keys).mapInArrow(find, _OPEN + ", link long")


def grouped(prints: DataFrame, roots: DataFrame, *more: str) -> DataFrame:
    """doc_id, fingerprint and component_id of every row of ``prints``, for a table of fingerprint and root.

    ``more`` can name ``root``, the fingerprint that stands for the group.
    """
    by_print = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")).join(roots, "fingerprint", "left")
    by_print = by_print.withColumn("root", F.coalesce("root", "fingerprint"))
    least = by_print.groupBy("root").agg(F.min("least").alias("component_id"))
    named = by_print.select("fingerprint", "root").join(least, "root").select("fingerprint", "component_id", *more)
    return prints.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id", *more)


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 3) -> DataFrame:
    """doc_id, fingerprint (signed long) and component_id (smallest doc_id reachable over links) of every row.

    Rows are linked when their fingerprints differ in at most ``radius`` bits; texts without words have fingerprint 0
    and are linked like any other. Null ids take part, but name a component only where it has no other.
    """
    prints = written(fingerprints(docs, words), "fingerprints")
    return grouped(prints, components(linked(prints, radius)).withColumnRenamed("node", "fingerprint"))


def shingles(text: str | None, words: int) -> set:
    """Distinct word shingles of a text, normalised as for its fingerprint; a short text is one shingle."""
    split = text.encode().lower().split() if text else []
    return set(zip(*(split[k:] for k in range(words)))) if len(split) >= words else {tuple(split)}


def confirmed(links: DataFrame, ids: DataFrame, docs: DataFrame, words: int, shingle: int, similarity: float) -> DataFrame:
    """The ``links`` (a, b) whose texts share enough of their distinct shingles.

    ``ids`` names one doc_id for each fingerprint; only texts of linked fingerprints travel. A link without an id on
    one side is not confirmed.
    """

    def right(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:  # of rows that repeat an id, those with the fingerprint in question
            same = [fingerprint(t, words) for t in b.column("text").to_pylist()]
            yield b.filter(pa.array(np.array(same, np.uint64).view(np.int64) == b.column("fingerprint").to_numpy()))

    def alike(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin()
        for batch in it:
            keep = []
            for s, t in zip(batch.column("s"), batch.column("t")):
                x, y = shingles(s.as_py(), shingle), shingles(t.as_py(), shingle)
                both = len(x & y)
                keep.append(both >= similarity * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    prepare(docs.sparkSession)
    asked = links.select(F.col("a").alias("fingerprint")).union(links.select("b")).distinct().join(ids, "fingerprint")
    texts = docs.select("doc_id", "text").join(asked, "doc_id").select("fingerprint", "text")
    texts = texts.mapInArrow(right, "fingerprint long, text string").groupBy("fingerprint").agg(F.min("text").alias("text"))
    texts = written(texts, "link-texts")
    pairs = links.join(texts.select(F.col("fingerprint").alias("a"), F.col("text").alias("s")), "a")
    pairs = pairs.join(texts.select(F.col("fingerprint").alias("b"), F.col("text").alias("t")), "b")
    return pairs.select("a", "b", "s", "t").mapInArrow(alike, "a long, b long")


def near_copies(docs: DataFrame, words: int = 3, radius: int = 3, reach: int = 7, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """As ``near_duplicates`` with ``root``, and groups are joined when their texts prove alike at up to ``reach`` bits.

    Groups linked within ``radius`` bits each ask with one fingerprint, so a large group stays one point of the wide
    search. Links up to ``reach`` bits are compared on the whole texts, by their distinct shingles of ``shingle`` words
    (Jaccard): forests of the shortest links first, then of the links left between groups that are not joined yet,
    four times as many forests in each round, until none is left. Rows without an id join groups within ``radius`` bits alone.
    """
    prints = written(fingerprints(docs, words), "fingerprints")
    near = components(linked(prints, radius)).withColumnRenamed("node", "fingerprint")
    ids = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id")).join(near, "fingerprint", "left")
    ids = written(ids.withColumn("root", F.coalesce("root", "fingerprint")), "groups")
    leaders = ids.where("fingerprint = root").select("fingerprint", "doc_id")
    open_ = dealt(leaders, reach).withColumns({"tree": F.lit(0).cast("long"), "root": F.col("fingerprint")})
    tested = good = None
    forests = 1
    while True:
        found = written(unjoined(open_, reach, forests), "found")
        links = found.where("link is not null").select(F.least("fingerprint", "link").alias("a"), F.greatest("fingerprint", "link").alias("b")).distinct()
        links = written(links.join(tested, ["a", "b"], "left_anti") if tested else links, "links")
        right = written(confirmed(links, leaders, docs, words, shingle, similarity), "confirmed")
        tested, good = (tested.union(links), good.union(right)) if tested else (links, right)
        wide = components(good)
        points = found.where("link is null").drop("link")
        if points.isEmpty():
            break
        points = points.join(wide.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
        keys = ["shard", "bits", "part", "tree"]
        several = points.groupBy(*keys).agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
        open_ = written(points.join(several, keys, "left_semi"), "open")
        if open_.isEmpty():
            break
        forests *= 4
    roots = ids.join(wide.select(F.col("node").alias("root"), F.col("root").alias("wider")), "root", "left")
    return grouped(prints, roots.select("fingerprint", F.coalesce("wider", "root").alias("root")), "root")
