"""Strips on a common grid: combine modes, gaps, block borders, masks, rotated solutions."""

import statistics

import pytest
from pyspark.sql import functions as F

from skyflow.functions.wcs import tan_struct
from skyflow.operators import pixels as px, resample as rs, stacking as st

SCALE = 0.4 / 3600
STRIPS = "frame_id int, amp int, y int, values array<double>"


def solutions(spark, shifts):
    """Images whose first pixel lies ``dx, dy`` cells from the centre, at the equator."""
    rows = spark.createDataFrame([(f, dx, dy) for f, (dx, dy) in shifts.items()], "frame_id int, dx int, dy int")
    wcs = tan_struct(F.lit(10.0), F.lit(0.0), SCALE).withField("crpix1", -F.col("dx").cast("double")).withField("crpix2", -F.col("dy").cast("double"))
    return rows.select("frame_id", F.lit("s").alias("stack_id"), wcs.alias("wcs"))


def stacked(spark, rows, shifts, combine="average", width=4):
    spans = rs.stack_strips(spark.createDataFrame(rows, STRIPS), solutions(spark, shifts), ["frame_id"], ["stack_id"], F.lit(10.0), F.lit(0.0), SCALE, combine, width)
    return {(r["x"], r["y"]): (r["value"], r["n"]) for r in rs.span_pixels(spans, ["stack_id"]).collect()}


@pytest.mark.parametrize("combine, merge", [("average", statistics.mean), ("sum", sum), ("min", min), ("max", max), ("median", statistics.median)])
def test_modes_agree_with_the_values_of_a_cell(spark, combine, merge):
    shifts = {1: (0, 0), 2: (2, 1), 3: (1, 0), 4: (1, 1)}
    rows = [(f, a, y, [float(f * 100 + 7 * (a * 4 + i) % 11 + y) for i in range(4)]) for f in shifts for a in range(2) for y in range(3)]
    cells = {}
    for f, a, y, values in rows:
        for i, v in enumerate(values):
            cells.setdefault((a * 4 + i + shifts[f][0], y + shifts[f][1]), []).append(v)
    assert stacked(spark, rows, shifts, combine) == {k: (pytest.approx(merge(v)), len(v)) for k, v in cells.items()}


def test_null_nan_and_missing_pixels_count_nowhere(spark):
    rows = [(1, 0, 0, [1.0, None, float("nan"), 4.0]), (2, 0, 0, [3.0, 5.0]), (2, 0, 1, None), (2, 0, 2, []), (9, 0, 0, [7.0])]
    got = stacked(spark, rows, {1: (0, 0), 2: (0, 0)})
    assert got == {(0, 0): (2.0, 2), (1, 0): (5.0, 1), (3, 0): (4.0, 1)}


def test_spans_break_at_blocks_only(spark):
    strip = spark.createDataFrame([(1, 0, 0, [float(i) for i in range(6)])], STRIPS)
    spans = rs.stack_strips(strip, solutions(spark, {1: (rs.BLOCK - 2, 0)}), ["frame_id"], ["stack_id"], F.lit(10.0), F.lit(0.0), SCALE, width=8)
    got = {r["x0"]: (r["values"], r["n"]) for r in spans.collect()}
    assert got == {rs.BLOCK - 2: ([0.0, 1.0], [1, 1]), rs.BLOCK: ([2.0, 3.0, 4.0, 5.0], [1] * 4)}


def test_no_solution_other_side_and_empty(spark):
    rows = [(1, 0, 0, [1.0]), (2, 0, 0, [1.0])]
    both = solutions(spark, {1: (0, 0), 2: (0, 0)}).withColumn("wcs", F.when(F.col("frame_id") == 1, F.col("wcs")))
    assert rs.stack_strips(spark.createDataFrame(rows, STRIPS), both, ["frame_id"], ["stack_id"], F.lit(190.0), F.lit(0.0), SCALE).count() == 0
    assert rs.stack_strips(spark.createDataFrame([], STRIPS), both, ["frame_id"], ["stack_id"], F.lit(10.0), F.lit(0.0), SCALE).count() == 0
    with pytest.raises(ValueError):
        rs.stack_strips(spark.createDataFrame(rows, STRIPS), both, ["frame_id"], ["stack_id"], F.lit(10.0), F.lit(0.0), SCALE, "mode")


def test_distorted_rotated_image_as_by_single_pixels(spark):
    wcs = spark.createDataFrame([(1, None), (2, "s")], "frame_id int, stack_id string").withColumn(
        "wcs", tan_struct(F.lit(10.01), F.lit(-30.0), SCALE).withField("cd1_2", F.lit(0.3 * SCALE)).withField("cd2_1", F.lit(0.25 * SCALE))
        .withField("pv1", F.array(*[F.lit(v) for v in (0.0, 1.0, 0.001, 0.0, 0.1)])).withField("crpix2", F.lit(40.5)))
    rows = spark.createDataFrame([(f, a, y, [float(f + a * 10 + i * y) for i in range(16)]) for f in (1, 2) for a in range(4) for y in range(30)], STRIPS)
    spans = rs.stack_strips(rows, wcs, ["frame_id"], ["stack_id"], F.lit(10.0), F.lit(-30.0), SCALE, width=16)
    by_pixel = st.coadd(px.strips_to_pixels(rows, ["frame_id"], 16), wcs, ["frame_id"], ["stack_id"], F.lit(10.0), F.lit(-30.0), SCALE)

    def cells(df):
        return {(r["stack_id"], r["x"], r["y"]): (pytest.approx(r["value"]), r["n"]) for r in df.collect()}

    assert cells(rs.span_pixels(spans, ["stack_id"])) == cells(by_pixel)


def test_mask_codes_add_up(spark):
    masks = spark.createDataFrame([(1, 0, 0, 2), (2, 0, 0, 16), (2, 1, 0, 4), (1, 2, 0, 0)], "frame_id int, x int, y int, code int")
    got = rs.stack_masks(masks, solutions(spark, {1: (1, 0), 2: (0, 0)}), ["frame_id"], ["stack_id"], F.lit(10.0), F.lit(0.0), SCALE, 4).collect()
    assert {(r["x"], r["y"], r["code"]) for r in got} == {(0, 0, 16), (1, 0, 6)}
