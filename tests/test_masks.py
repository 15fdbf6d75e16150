"""Masks as spans of detector rows against sets of single pixels."""

import random

import pytest
from pyspark.sql import functions as F

from skyflow.operators import masks as mk

K = ["frame_id"]
SPANS = "frame_id int, y int, x0 int, x1 int, code long"


def pixels(spans):
    out = {}
    for r in mk.span_pixels(spans, K).collect():
        assert (r["frame_id"], r["x"], r["y"]) not in out
        out[r["frame_id"], r["x"], r["y"]] = r["code"]
    return out


def test_sums_of_overlapping_spans_are_disjoint_and_joined(spark):
    rng = random.Random(3)
    rows = [(f, y, a, a + rng.randrange(0, 9), rng.choice([1, 2, 4, 0])) for f in (1, None) for y in range(3) for a in [rng.randrange(30) for _ in range(6)]]
    want = {}
    for f, y, a, b, code in rows:
        for x in range(a, b):
            want[f, x, y] = want.get((f, x, y), 0) + code
    both = mk.add_spans([spark.createDataFrame(rows[::2], SPANS), spark.createDataFrame(rows[1::2], SPANS)], K)
    assert pixels(both) == {k: v for k, v in want.items() if v}
    ends = {(r["frame_id"], r["y"], r["x1"], r["code"]) for r in both.collect()}
    assert not any((r["frame_id"], r["y"], r["x0"], r["code"]) in ends for r in both.collect())
    assert mk.add_spans([spark.createDataFrame([], SPANS)], K).count() == 0


def test_runs_of_strips(spark):
    strips = spark.createDataFrame(
        [(1, 1, 0, [9.0, 9.0, 1.0, None, 9.0]), (1, 0, 1, [1.0]), (1, 0, 2, []), (1, 0, 3, None), (2, 0, 0, [float("nan"), 9.0])],
        "frame_id int, amp int, y int, values array<double>")
    got = mk.spans_of_strips(strips, K, lambda v: (v > 5) & ~F.isnan(v), code=8, width=10).collect()
    assert {tuple(r) for r in got} == {(1, 0, 10, 12, 8), (1, 0, 14, 15, 8), (2, 0, 1, 2, 8)}


@pytest.mark.parametrize("dead", [False, True])
def test_crosstalk_counts_aggressors(spark, dead):
    width, amps = 4, 8
    hot = [(1, 0, 1, 3, 1), (1, 0, 18, 20, 1), (1, 1, 30, 31, 1), (2, 0, 26, 28, 1)]
    gone = spark.createDataFrame([(2,)], "frame_id int") if dead else None
    got = pixels(mk.crosstalk_spans(spark.createDataFrame(hot, SPANS), K, width, amps, gone, 3, 6))
    want = {}
    for f, y, a, b, _ in hot:
        for x in range(a, b):
            src, at = divmod(x, width)
            for dst in range(amps):
                if (dst - src) % 2 or abs(dst - src) >= 6 or (dead and f == 2 and dst == 6):
                    continue
                place = width - 1 - at if (src < 4) != (dst < 4) else at
                key = f, dst * width + place, y
                want[key] = want.get(key, 0) + 1
    if dead:
        want |= {(2, x, y): 4 for x in range(24, 28) for y in range(3)}
    assert got == want


def test_bad_amplifiers_replace_the_mask_below_the_bad_pixels(spark):
    mask = spark.createDataFrame([(1, 0, 2, 7, 1), (2, 0, 0, 3, 1)], SPANS)
    bpm = spark.createDataFrame([(1, 0, 5, 6, 16), (3, 1, 0, 1, 16)], SPANS)
    frames = spark.createDataFrame([(1, "010"), (2, "000"), (3, None), (4, "111")], "frame_id int, badamp string")
    spans, qa = mk.with_bad_amps(mask, bpm, frames, K, 4, 2)
    got = pixels(spans)
    assert {k: v for k, v in got.items() if k[0] != 4} == {
        (1, 2, 0): 1, (1, 3, 0): 1, **{(1, x, y): 4 for x in range(4, 8) for y in range(2)}, (1, 5, 0): 20,
        (2, 0, 0): 1, (2, 1, 0): 1, (2, 2, 0): 1, (3, 0, 1): 16}
    # neighbouring bad amplifiers are one span of a row
    assert spans.where("frame_id = 4").count() == 2
    assert {r["frame_id"]: r["photqa"] for r in qa.collect()}[4] is False
