"""Masks as spans ``(keys.., y, x0, x1, code)``: pixels ``[x0, x1)`` of a detector row that share a code.

A whole amplifier is one span a row, and neighbours with one code are one span, so masks are joined, shuffled and added
without a row per pixel. ``span_pixels`` expands them, for a writer.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from skyflow.operators.pixels import AMP_WIDTH, AMPS, BAD_AMP_CODE, NAXIS2


def spans_of_pixels(mask: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sparse masks ``keys, x, y, code`` as spans of one pixel; ``add_spans`` joins neighbours."""
    return mask.select(*keys, "y", F.col("x").alias("x0"), (F.col("x") + 1).alias("x1"), F.col("code").cast("long").alias("code"))


def spans_of_strips(strips: DataFrame, keys: Sequence[str], test: Callable[[Column], Column], code: int = 1, width: int = AMP_WIDTH) -> DataFrame:
    """Runs of the pixels of each strip that pass ``test``; null pixels never do."""

    def passes(i: Column) -> Column:
        return F.coalesce(test(F.get("values", i)), F.lit(False))

    found = strips.where(F.exists("values", lambda v: F.coalesce(test(v), F.lit(False))))
    at = F.filter(F.sequence(F.lit(0), F.size("values") - 1), passes)
    found = found.withColumn("_at", at)
    starts = F.filter("_at", lambda i: (i == 0) | ~passes(i - 1))
    ends = F.filter("_at", lambda i: ~passes(i + 1))
    runs = F.explode(F.arrays_zip(starts.alias("a"), ends.alias("b"))).alias("_r")
    first = F.col("amp") * width
    return found.select(*keys, "y", "amp", runs).select(
        *keys, "y", (first + F.col("_r")["a"]).cast("int").alias("x0"), (first + F.col("_r")["b"] + 1).cast("int").alias("x1"),
        F.lit(code).cast("long").alias("code"))


def amp_spans(amps: DataFrame, keys: Sequence[str], amp: Column, code: int, width: int = AMP_WIDTH, height: int = NAXIS2) -> DataFrame:
    """One code over whole amplifiers: a span for each detector row; a null amplifier has none."""
    rows = F.explode(F.sequence(F.lit(0), F.lit(height - 1))).alias("y")
    return amps.select(*keys, amp.cast("int").alias("_a")).where("_a is not null").select(*keys, "_a", rows).select(
        *keys, "y", (F.col("_a") * width).alias("x0"), ((F.col("_a") + 1) * width).alias("x1"), F.lit(code).cast("long").alias("code"))


def add_spans(masks: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Sum of the codes of overlapping spans, in disjoint spans of a code other than 0.

    A detector row is swept from the borders of its spans: one shuffle by row, none by pixel.
    """
    row = [*keys, "y"]
    borders = F.array(F.struct(F.col("x0").cast("int").alias("x"), F.col("code").alias("d")), F.struct(F.col("x1").cast("int").alias("x"), (-F.col("code")).alias("d")))
    union = None
    for m in masks:
        part = m.where("x1 > x0").select(*row, F.explode(borders).alias("_b"))
        union = part if union is None else union.unionByName(part)
    steps = union.select(*row, F.col("_b.x").alias("x0"), F.col("_b.d").alias("_d")).repartition(*row)
    steps = steps.groupBy(*row, "x0").agg(F.sum("_d").alias("_d")).where("_d <> 0")
    sweep = Window.partitionBy(*row).orderBy("x0")
    spans = steps.withColumns({"x1": F.lead("x0").over(sweep), "code": F.sum("_d").over(sweep)}).where("code <> 0")
    return spans.select(*row, "x0", "x1", "code")


def span_pixels(spans: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, x, y, code`` of every pixel of the spans."""
    return spans.where("x1 > x0").select(*keys, F.explode(F.sequence(F.col("x0"), F.col("x1") - 1)).alias("x"), "y", "code")


def _by_amp(spans: DataFrame, keys: Sequence[str], width: int) -> DataFrame:
    """Spans cut at the borders of amplifiers, with ``_a``."""
    first, last = F.floor(F.col("x0") / width).cast("int"), F.floor((F.col("x1") - 1) / width).cast("int")
    cut = spans.where("x1 > x0").withColumn("_a", F.explode(F.sequence(first, last)))
    return cut.select(
        *keys, "_a", "y", F.greatest("x0", F.col("_a") * width).alias("x0"), F.least("x1", (F.col("_a") + 1) * width).alias("x1"), "code")


def crosstalk_spans(
    hot: DataFrame, keys: Sequence[str], width: int = AMP_WIDTH, amps: int = AMPS, dead: DataFrame | None = None,
    height: int = NAXIS2, dead_amp: int = 6,
) -> DataFrame:
    """Victims of the saturated spans ``hot``: the code is the number of aggressors of a pixel.

    A saturated run shows up in the amplifiers of the same parity, mirrored when the two lie in different halves; the
    most distant pairs (six apart) are too weak. ``dead`` lists frames whose amplifier ``dead_amp`` is 4 throughout.
    """
    keys, half = list(keys), amps // 2
    run = _by_amp(hot.withColumn("code", F.lit(1).cast("long")), keys, width).withColumns(
        {"_l0": F.col("x0") - F.col("_a") * width, "_l1": F.col("x1") - F.col("_a") * width})
    reached = F.filter(
        F.sequence(F.lit(0), F.lit(amps - 1)), lambda d: (F.pmod(d - F.col("_a"), F.lit(2)) == 0) & (F.abs(d - F.col("_a")) < 6))
    hits = run.withColumn("_dst", F.explode(reached))
    mirrored = (F.col("_a") < half) != (F.col("_dst") < half)
    low = F.when(mirrored, width - F.col("_l1")).otherwise(F.col("_l0"))
    hits = hits.select(
        *keys, "_dst", "y", (F.col("_dst") * width + low).alias("x0"), (F.col("_dst") * width + low + F.col("_l1") - F.col("_l0")).alias("x1"), "code")
    if dead is None:
        return add_spans([hits.drop("_dst")], keys)
    gone = dead.select(*keys).distinct()
    hits = hits.join(gone.withColumn("_dst", F.lit(dead_amp)), [*keys, "_dst"], "left_anti").drop("_dst")
    return add_spans([hits, amp_spans(gone, keys, F.lit(dead_amp), BAD_AMP_CODE, width, height)], keys)


def with_bad_amps(
    mask: DataFrame, bpm: DataFrame, frames: DataFrame, keys: Sequence[str], width: int = AMP_WIDTH, height: int = NAXIS2
) -> tuple[DataFrame, DataFrame]:
    """Spans of mask + bad-pixel map with bad amplifiers set to 4, and ``n_bad_amps, photqa`` per frame.

    ``frames`` has ``keys, badamp`` (digit string).
    """
    keys = list(keys)
    bad_digits = F.filter(F.transform(F.split("badamp", ""), lambda d, i: F.when(d == "1", i)), lambda i: i.isNotNull())
    amps = frames.select(*keys, bad_digits.alias("_bad"))
    bad = amps.select(*keys, F.explode("_bad").alias("_a"))
    kept = _by_amp(mask, keys, width).join(bad, [*keys, "_a"], "left_anti").drop("_a")
    full = amp_spans(bad, keys, F.col("_a"), BAD_AMP_CODE, width, height)
    qa = amps.select(*keys, F.size("_bad").alias("n_bad_amps"), (F.size("_bad") < 3).alias("photqa"))
    return add_spans([kept, full, bpm], keys), qa
