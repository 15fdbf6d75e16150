"""Strips on the cells of a common sky grid: stacks of images and of masks.

A task places whole strips with one block of arithmetic per solution and combines what falls into a cell before the
shuffle. Shuffles carry spans of a grid row (values and counts as arrays), so no pixel becomes a row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from skyflow.functions.wcs import PV_TERMS, tan_cells
from skyflow.operators.pixels import AMP_WIDTH, pixels_to_strips

# Cells of a grid row that form one span of the output.
BLOCK = 1024
COMBINE = ("average", "sum", "min", "max", "median")


def _solution(wcs: str, center_ra: Column, center_dec: Column) -> Column:
    """A solution and the centre of its grid as one array of numbers."""
    w = F.col(wcs)
    linear = [w[c].cast("double") for c in ("crpix1", "crpix2", "crval1", "crval2", "cd1_1", "cd1_2", "cd2_1", "cd2_2")]

    def terms(pv: str) -> list[Column]:
        return [F.coalesce(F.get(w[pv], F.lit(i)), F.lit(0.0)) for i in range(PV_TERMS)]

    return F.array(*linear, *terms("pv1"), *terms("pv2"), center_ra.cast("double"), center_dec.cast("double"))


def _lists(flat: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.r_[0, np.cumsum(sizes)].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def _runs(same: np.ndarray) -> np.ndarray:
    """Starts of the runs of rows that are the ``same`` as the one before."""
    return np.flatnonzero(~same)


def _scatter(code: np.ndarray, gy: np.ndarray, gx: np.ndarray, value: np.ndarray, combine: str):
    """Spans ``(code, gy, block, first, values, n)`` of pixels on cells; equal cells are combined, or layered for a median."""
    order = np.lexsort((value, gx, gy, code)) if combine == "median" else np.lexsort((gx, gy, code))
    code, gy, gx, value = code[order], gy[order], gx[order], value[order]
    same = np.r_[False, (code[1:] == code[:-1]) & (gy[1:] == gy[:-1]) & (gx[1:] == gx[:-1])]
    at = _runs(same)
    if combine == "median":  # every value stays: the k-th of a cell goes to layer k
        layer = np.arange(len(code)) - np.repeat(at, np.diff(np.r_[at, len(code)]))
        n = np.ones(len(code), np.int32)
    else:
        reduce = {"min": np.minimum, "max": np.maximum}.get(combine, np.add).reduceat
        n = np.diff(np.r_[at, len(code)]).astype(np.int32)
        code, gy, gx, value, layer = code[at], gy[at], gx[at], reduce(value, at), np.zeros(len(at), np.int64)
    block, slot = np.floor_divide(gx, BLOCK), np.mod(gx, BLOCK)
    order = np.lexsort((slot, block, gy, code, layer))
    code, gy, block, slot, value, n, layer = (c[order] for c in (code, gy, block, slot, value, n, layer))
    new = np.r_[True, (layer[1:] != layer[:-1]) | (code[1:] != code[:-1]) | (gy[1:] != gy[:-1]) | (block[1:] != block[:-1])]
    at = np.flatnonzero(new)
    last = np.r_[at[1:], len(code)] - 1
    sizes = slot[last] - slot[at] + 1
    run = np.cumsum(new) - 1
    place = (np.cumsum(sizes) - sizes)[run] + slot - slot[at][run]
    values, counts = np.full(sizes.sum(), np.nan), np.zeros(sizes.sum(), np.int32)
    values[place], counts[place] = value, n
    return code[at], gy[at], block[at], slot[at], sizes, values, counts


class _Row:
    """Cells of one block of a grid row, filled span by span."""

    def __init__(self, combine: str) -> None:
        self.combine, self.n = combine, np.zeros(BLOCK, np.int32)
        start = {"min": np.inf, "max": -np.inf}.get(combine, 0.0)
        self.state, self.layers = np.full(BLOCK, start), []

    def add(self, first: int, values: np.ndarray, n: np.ndarray) -> None:
        at, has = slice(first, first + len(values)), n > 0
        self.n[at] += n
        if self.combine == "median":
            layer = np.full(BLOCK, np.nan)
            layer[at][has] = values[has]
            self.layers.append(layer)
            return
        merge = {"min": np.minimum, "max": np.maximum}.get(self.combine, np.add)
        merge(self.state[at], values, out=self.state[at], where=has)

    def result(self) -> tuple[int, np.ndarray, np.ndarray]:
        held = np.flatnonzero(self.n)
        at = slice(held[0], held[-1] + 1)
        n = self.n[at]
        values = np.full(len(n), np.nan)
        if self.combine == "median":
            values[n > 0] = np.nanmedian(np.stack(self.layers)[:, at][:, n > 0], axis=0)
        elif self.combine == "average":
            np.divide(self.state[at], n, out=values, where=n > 0)
        else:
            values[n > 0] = self.state[at][n > 0]
        return int(held[0]), values, n


def stack_strips(
    strips: DataFrame, wcs: DataFrame, keys: Sequence[str], stack: Sequence[str], center_ra: Column, center_dec: Column,
    scale_deg: float = 0.4 / 3600, combine: str = "average", width: int = AMP_WIDTH,
) -> DataFrame:
    """Dithered strips in the nearest cells of one plain gnomonic grid per stack.

    ``strips``: ``keys, amp, y, values``; ``wcs``: ``keys, stack.., wcs``, one row per image, which may carry the centre.
    Output: ``stack.., y, x0, values, n``, a span of a grid row from ``x0`` (at most ``BLOCK`` cells, one span for each
    block); cells without a pixel are null with ``n`` 0. Null and NaN pixels, pixels off the tangent plane and strips
    without a solution count nowhere. ``combine`` is one of ``COMBINE``; all but the median are combined before the
    shuffle, a median meets the values of a cell (one for each pixel of its frames) in one task.
    """
    if combine not in COMBINE:
        raise ValueError(f"combine must be one of {COMBINE}")
    keys, stack = list(keys), list(stack)
    solved = wcs.where(F.col("wcs").isNotNull()).select(*keys, *stack, _solution("wcs", center_ra, center_dec).alias("_solution"))
    solved = solved.where(~F.exists("_solution", lambda v: v.isNull() | F.isnan(v)))
    rows = strips.select(*keys, "amp", "y", F.col("values").cast("array<double>").alias("values")).join(solved, keys)
    rows = rows.select(*stack, (F.col("amp") * width).cast("long").alias("_x"), F.col("y").cast("long").alias("_y"), "values", "_solution")
    group = [rows.schema[c] for c in stack]
    spans = T.StructType([
        *group, T.StructField("y", T.IntegerType()), T.StructField("_block", T.IntegerType()), T.StructField("_first", T.IntegerType()),
        T.StructField("values", T.ArrayType(T.DoubleType())), T.StructField("n", T.ArrayType(T.IntegerType())),
    ])
    out = T.StructType([
        *group, T.StructField("y", T.IntegerType()), T.StructField("x0", T.IntegerType()),
        T.StructField("values", T.ArrayType(T.DoubleType())), T.StructField("n", T.ArrayType(T.IntegerType())),
    ])
    size = len(stack)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(spans)
        for b in batches:
            lists = b.column(size + 2)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(float)
            solution = b.column(size + 3).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            which, of_row = np.unique(solution, axis=0, return_inverse=True)
            names: dict[tuple, int] = {}
            keyed = list(zip(*(b.column(i).to_pylist() for i in range(size)))) if size else [()] * b.num_rows
            code = np.array([names.setdefault(k, len(names)) for k in keyed], np.int64)
            row = np.repeat(np.arange(b.num_rows), sizes)
            x = b.column(size).to_numpy()[row] + np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            y = b.column(size + 1).to_numpy()[row]
            gx, gy, image = np.empty(len(flat)), np.empty(len(flat)), of_row.ravel()[row]
            for i, numbers in enumerate(which):
                own = image == i
                gx[own], gy[own] = tan_cells(numbers, x[own], y[own], scale_deg)
            good = ~np.isnan(flat) & np.isfinite(gx) & np.isfinite(gy)
            if not good.any():
                continue
            c, gy, block, first, sizes, values, n = _scatter(
                code[row][good], gy[good].astype(np.int64), gx[good].astype(np.int64), flat[good], combine)
            known = list(names)
            columns = [pa.array([known[i][k] for i in c.tolist()], schema.field(k).type) for k in range(size)]
            numbers = [pa.array(v.astype(np.int32)) for v in (gy, block, first)]
            yield pa.RecordBatch.from_arrays([*columns, *numbers, _lists(values, sizes, pa.float64()), _lists(n, sizes, pa.int32())], schema=schema)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(out)
        key, row, done = None, None, []

        def batch() -> pa.RecordBatch:
            columns = [pa.array([k[i] for k, _ in done], schema.field(i).type) for i in range(size + 1)]
            x0 = pa.array([k[size + 1] * BLOCK + r[0] for k, r in done], pa.int32())
            sizes = np.array([len(r[2]) for _, r in done])
            values = np.concatenate([r[1] for _, r in done])
            lists = pa.ListArray.from_arrays(
                pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(values, mask=np.isnan(values)))
            return pa.RecordBatch.from_arrays([*columns, x0, lists, _lists(np.concatenate([r[2] for _, r in done]), sizes, pa.int32())], schema=schema)

        for b in batches:
            firsts = b.column(size + 2).to_pylist()
            spans_of = [(np.asarray(b.column(i).offsets), b.column(i).values.to_numpy(zero_copy_only=False)) for i in (size + 3, size + 4)]
            (ends, values), (_, counts) = spans_of
            for i, now in enumerate(zip(*(b.column(k).to_pylist() for k in range(size + 2)))):
                if now != key:
                    if row is not None:
                        done.append((key, row.result()))
                    key, row = now, _Row(combine)
                row.add(firsts[i], values[ends[i] : ends[i + 1]], counts[ends[i] : ends[i + 1]])
            if len(done) >= 256:
                yield batch()
                done = []
        if row is not None:
            done.append((key, row.result()))
        if done:
            yield batch()

    cell = [*stack, "y", "_block"]
    return rows.mapInArrow(place, spans).repartition(*cell).sortWithinPartitions(*cell).mapInArrow(merge, out)


def stack_masks(
    masks: DataFrame, wcs: DataFrame, keys: Sequence[str], stack: Sequence[str], center_ra: Column, center_dec: Column,
    scale_deg: float = 0.4 / 3600, width: int = AMP_WIDTH,
) -> DataFrame:
    """Sparse masks (``keys, x, y, code``) on the grid of their stack: ``stack.., x, y, code``, the sum of the codes of a cell."""
    rows = pixels_to_strips(masks.where(F.col("code") != 0).withColumn("value", F.col("code").cast("double")), keys, width)
    spans = stack_strips(rows, wcs, keys, stack, center_ra, center_dec, scale_deg, "sum", width)
    return span_pixels(spans, stack).select(*stack, "x", "y", F.col("value").cast("long").alias("code"))


def span_pixels(spans: DataFrame, stack: Sequence[str]) -> DataFrame:
    """Covered cells of stacked spans in long form: ``stack.., x, y, value, n``."""
    long = spans.select(*stack, "y", "x0", F.posexplode(F.arrays_zip("values", "n")).alias("_i", "_c")).where("_c.n > 0")
    return long.select(*stack, (F.col("x0") + F.col("_i")).alias("x"), "y", F.col("_c.values").alias("value"), F.col("_c.n").alias("n"))
