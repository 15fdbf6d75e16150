"""Best-fit packing of token pieces into fixed-length sequences, planned on the length histogram.

Patterns of at most ``MOST_PARTS`` lengths that fill a sequence get repeat counts by non-negative least squares
on the histogram (in steps of ``STEP`` tokens); counts are rounded, patterns are filled with exact lengths, and
what is left is packed by best fit. All of this sees only counts by length (at most ``size`` of them), so the
plan's size is bounded by the sequence length. Rows then find their place by rank among equal lengths.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from skyflow.llm.common import WordEncoder, map_rows, numbered, prepare, written

STEP, MOST_PARTS = 8, 3
#: Rows that are ranked together; equal lengths beyond that are split.
RANKED = 8192


def token_pieces(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0) -> DataFrame:
    """Pieces of at most ``size`` ids of every text followed by ``end_id``.

    Returns doc_id, piece, start, length, ids_crc32. A null or empty text is the end id alone. Other columns of
    ``docs`` are not looked at; repeated rows and null ids give rows of their own.
    """
    end = end_id.to_bytes(4, "little")

    def cut(rows: Iterator[tuple]) -> Iterator[tuple]:
        encoder = WordEncoder.shared(tokenizer)
        for doc_id, text in rows:
            ids = encoder.encode(text or "") + end
            start = 0
            for piece, at in enumerate(range(0, len(ids), 4 * size)):
                part = ids[at : at + 4 * size]
                yield doc_id, piece, start, len(part) // 4, zlib.crc32(part)
                start += len(part) // 4

    prepare(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return map_rows(docs.select("doc_id", "text"), cut, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long", owner="words")


def patterns(n: int, parts: int) -> list[tuple[int, ...]]:
    """Descending tuples of at most ``parts`` positive whole numbers with the sum ``n``."""

    def more(rest: int, most: int, left: int) -> Iterator[tuple[int, ...]]:
        if rest == 0:
            yield ()
        elif left:
            for first in range(min(rest, most), (rest - 1) // left, -1):
                for tail in more(rest - first, first, left - 1):
                    yield (first, *tail)

    return list(more(n, n, parts))


def nnls(a: np.ndarray, b: np.ndarray, tol: float = 1e-9) -> np.ndarray:
    """Non-negative least squares by an active set: columns enter by gradient, leave where they turn negative."""
    x = np.zeros(a.shape[1])
    inside = np.zeros(a.shape[1], bool)
    for _ in range(3 * a.shape[0]):
        gain = a.T @ (b - a @ x)
        gain[inside] = -np.inf
        j = int(gain.argmax())
        if gain[j] <= tol * max(1.0, float(np.abs(b).max())):
            break
        inside[j] = True
        while True:
            cols = np.flatnonzero(inside)
            s = np.linalg.lstsq(a[:, cols], b, rcond=None)[0]
            if (s > 0).all():
                x[:] = 0
                x[cols] = s
                break
            bad = s <= 0
            step = np.min(x[cols][bad] / np.maximum(x[cols][bad] - s[bad], 1e-300))
            x[cols] += step * (s - x[cols])
            drop = cols[(x[cols] <= 1e-12) & bad]
            x[drop], inside[drop] = 0, False
            if not len(drop):
                break
    return x


def plan(histogram: dict[int, int], size: int) -> np.ndarray:
    """Runs (length, first rank, past rank, first sequence, offset): equal-length pieces by rank get a place.

    Rank r of a run lies in sequence ``first sequence + r - first rank`` at ``offset``. Repeat counts are rounded to the
    nearest and down, and patterns are left out altogether, which is best fit alone; the fewest sequences win.
    """
    total = np.zeros(size + 1, np.int64)
    for length, n in histogram.items():
        total[length] = n
    bins = -(-size // STEP)
    shapes = patterns(bins, MOST_PARTS)
    a = np.zeros((bins, len(shapes)))
    for j, shape in enumerate(shapes):
        for part in shape:
            a[part - 1, j] += 1
    heavy = np.arange(1, bins + 1) / bins  # a missed token weighs the same in any length
    want = slots(total, size).astype(float)
    scale = max(1.0, want.max())
    x = nnls(a * heavy[:, None], want / scale * heavy) * scale
    tries = [fill(total, size, shapes, repeats) for repeats in (np.floor(x + 0.5), np.floor(x), np.zeros(len(x)))]
    done = min(tries, key=lambda d: sum(n for n, _ in d))
    runs, taken, sequence = [], np.zeros(size + 1, np.int64), 0
    for n, items in done:
        offset = 0
        for length in items:
            runs.append((length, taken[length], taken[length] + n, sequence, offset))
            taken[length] += n
            offset += length
        sequence += n
    assert (taken == total).all()
    out = np.array(runs, np.int64).reshape(-1, 5)
    return out[np.lexsort((out[:, 1], out[:, 0]))]


def slots(left: np.ndarray, size: int) -> np.ndarray:
    """Counts by length in steps of ``STEP``."""
    bins = -(-size // STEP)
    return np.add.reduceat(np.append(left[1:], np.zeros(bins * STEP - size, np.int64)), np.arange(0, bins * STEP, STEP))


def fill(total: np.ndarray, size: int, shapes: list[tuple[int, ...]], repeats: np.ndarray) -> list[tuple[int, tuple[int, ...]]]:
    """(sequences, lengths in each) for all pieces: the patterns with their repeat counts first, the rest by best fit."""
    left = total.copy()
    gaps: dict[int, list[tuple[int, tuple[int, ...]]]] = {}  # free tokens: classes of (sequences, lengths inside)
    sizes: list[int] = []
    done: list[tuple[int, tuple[int, ...]]] = []

    def put(n: int, items: tuple[int, ...], free: int) -> None:
        if n and not free:
            done.append((n, items))
        elif n:
            if free not in gaps:
                gaps[free] = []
                bisect.insort(sizes, free)
            gaps[free].append((n, items))

    for j in np.argsort(-repeats, kind="stable"):
        n = int(repeats[j])
        if not n:
            break
        free = slots(left, size)
        n = min([n, *(int(free[p - 1]) // shapes[j].count(p) for p in set(shapes[j]))])
        classes = [(n, (), size)] if n else []
        for k, part in enumerate(shapes[j]):
            filled = []
            while classes:
                n, items, room = classes.pop()
                # the last part may be any length that still fits, the longest first
                low, high = (1, room) if k == len(shapes[j]) - 1 else ((part - 1) * STEP + 1, min(part * STEP, room))
                there = np.flatnonzero(left[low : high + 1])
                if not len(there):
                    put(n, items, room)
                    continue
                length = low + int(there[-1])
                m = min(n, int(left[length]))
                left[length] -= m
                filled.append((m, (*items, length), room - length))
                if n > m:
                    classes.append((n - m, items, room))
            classes = filled
        for n, items, room in classes:
            put(n, items, room)

    for length in range(size, 0, -1):  # best fit, longest first, equal pieces at once
        while n := int(left[length]):
            at = bisect.bisect_left(sizes, length)
            if at < len(sizes):
                room = sizes[at]
                m, items = gaps[room].pop()
                if not gaps[room]:
                    del gaps[room], sizes[at]
            else:
                room, m, items = size, n, ()
            each = room // length
            full = min(m, n // each)
            if full:
                put(full, items + (length,) * each, room - each * length)
                left[length] -= full * each
                if items:
                    put(m - full, items, room)
            else:
                put(1, items + (length,) * n, room - n * length)
                left[length] = 0
                if items:
                    put(m - 1, items, room)

    for room, classes in gaps.items():
        done += [(n, items) for n, items in classes if items]
    return done


def pack(pieces: DataFrame, size: int = 2048) -> DataFrame:
    """``pieces`` with sequence_id and offset; sequences hold at most ``size`` and are gapless from 0.

    ``pieces`` needs doc_id, piece and length (1 to ``size``; a null length takes no part); its other columns are
    carried, but for clashing ``sequence_id`` and ``offset``, which are replaced. Repeated rows and null ids are packed
    each. No rows give no rows.
    """
    spark = pieces.sparkSession
    pieces = pieces.drop("sequence_id", "offset")
    names = pieces.columns
    length = F.col(f"c{names.index('length')}").cast("long")
    table = numbered(pieces).withColumns({"length": length, "row": F.monotonically_increasing_id()}).where("length is not null")
    table = written(table, "pieces")
    histogram = {r["length"]: r["n"] for r in table.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = plan(histogram, size) if histogram else np.zeros((0, 5), np.int64)
    # at most `size` rows: lengths, and into how many parts their rows are dealt for ranking, by row number, so that ids
    # that repeat don't meet in one part
    parts = F.broadcast(spark.createDataFrame([(k, -(-n // RANKED)) for k, n in histogram.items()], "length long, parts long"))
    dealt = table.join(parts, "length").withColumn("part", F.pmod(F.xxhash64("row"), "parts"))
    before = dealt.groupBy("length", "part").agg(F.count("*").alias("n"))
    so_far = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = before.select("length", "part", F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("before"))
    order = Window.partitionBy("length", "part").orderBy("row")
    ranked = dealt.withColumn("nth", F.row_number().over(order)).join(before, ["length", "part"])
    columns = [f"c{i}" for i in range(len(names))]
    ranked = ranked.select(*columns, "length", (F.col("before") + F.col("nth") - 1).alias("rank"))
    sent = spark.sparkContext.broadcast(runs)  # the plan: bounded by `size`

    def place(batches):
        import pyarrow as pa

        r = sent.value
        keys = (r[:, 0] << 44) + r[:, 1]
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            at = np.searchsorted(keys, (length << 44) + rank, side="right") - 1
            found = [b.column(c) for c in columns] + [pa.array(r[at, 3] + rank - r[at, 1]), pa.array(r[at, 4])]
            yield pa.RecordBatch.from_arrays(found, names=[*columns, "sequence", "place"])

    fields = StructType([*ranked.schema.fields[: len(names)], StructField("sequence", LongType()), StructField("place", LongType())])
    return ranked.mapInArrow(place, fields).toDF(*names, "sequence_id", "offset")
