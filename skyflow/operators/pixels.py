"""Pixel operators.

Bulk pixels travel as strips ``(keys.., amp, y, values)``: one row per detector
row and amplifier. The long form ``(keys.., x, y, value)`` serves sparse work.
Amplifier widths are arguments, so the same operators run on small frames.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from skyflow.functions.naming import AMPS, NAXIS1, NAXIS2
from skyflow.functions.photsys import SCALED_ZERO_POINT, flux_ratio
from skyflow.operators.clip import clip_summary, exact_median
from skyflow.operators.histogram import strip_median
from skyflow.operators.photometry import poly2d_value

# --- fixed values ------------------------------------------------------------
AMP_WIDTH = NAXIS1 // AMPS
# extension k*8+1 .. k*8+8 of a raw exposure belongs to the k-th chip
EXTENSION_CHIPS = ["mm", "kk", "nn", "tt"]
CROSSTALK_LIMIT, BLEED_LIMIT = 56000.0, 52000.0
BAD_AMP_CODE, BLEED_CODE = 4, 8
BLEED_NEAR, BLEED_FAR, BLEED_EXCESS, BLEED_SIGMA, BLEED_STOP = 20, 40, 3000.0, 1.5, 5
BLEED_DOWN = ["kk", "nn"]
DEAD_AMP_SITE, DEAD_AMP_CHIP = "CTIO", "nn"
NULL_PIXEL = 1e-30
MESH = 256
SATURATION = 60000.0
# -----------------------------------------------------------------------------


def assemble_chip(strips: DataFrame, chip_amps: int = AMPS) -> DataFrame:
    """Raw extension rows ``(.., ext, y, values)`` -> chip and amplifier of each strip.

    With four ready-made chips per file every extension is one chip.
    """
    k = F.floor((F.col("ext") - 1) / chip_amps).cast("int")
    return strips.withColumns(
        {
            "chip": F.element_at(F.array(*[F.lit(c) for c in EXTENSION_CHIPS]), k + 1),
            "amp": F.pmod(F.col("ext") - 1, F.lit(chip_amps)).cast("int"),
        }
    )


def strips_to_pixels(strips: DataFrame, keys: Sequence[str], width: int = AMP_WIDTH) -> DataFrame:
    """Long form; ``x`` runs over the whole chip."""
    return strips.select(
        *keys, "amp", "y", F.posexplode("values").alias("_i", "value")
    ).select(
        *keys, "amp", (F.col("amp") * width + F.col("_i")).cast("int").alias("x"), "y", F.col("value").cast("double").alias("value")
    )


def pixels_to_strips(pixels: DataFrame, keys: Sequence[str], width: int = AMP_WIDTH) -> DataFrame:
    """Strip form of long pixels (at most ``width`` values per row); absent pixels before the last one are null."""
    slot = F.pmod(F.col("x"), F.lit(width)).cast("int")
    packed = pixels.groupBy(*keys, F.floor(F.col("x") / width).cast("int").alias("amp"), "y").agg(
        F.array_sort(F.collect_list(F.struct(slot.alias("k"), F.col("value").alias("v")))).alias("_p")
    )
    return packed.select(*keys, "amp", "y", place_values("_p", F.lit(None).cast("double")).alias("values"))


def place_values(pixels: str, gap: Column) -> Column:
    """Values of sorted ``(k, v)`` at their places ``k``, with ``gap`` before and between them; linear in the places."""
    before = F.concat(F.array(F.lit(-1)), F.transform(pixels, lambda e: e["k"]))
    pieces = F.zip_with(
        F.col(pixels), F.slice(before, 1, F.size(pixels)),
        lambda e, p: F.concat(F.array_repeat(gap, e["k"] - p - 1), F.array(e["v"].cast("double"))),
    )
    return F.flatten(pieces)


def invert(pixels: DataFrame) -> DataFrame:
    return pixels.withColumn("value", -F.col("value"))


def chip_sky(pixels: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Exact median pixel of each chip."""
    return exact_median(pixels, keys, "value", "sky")


def chip_sky_of_strips(strips: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same from strips, without a row per pixel."""
    return strip_median(strips, keys, "sky")


def level_amps(strips: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bring every amplifier to the median of the chip's amplifier medians; one without a valid pixel stays as it is."""
    keys = list(keys)
    sky = strip_median(strips, keys + ["amp"], "amp_sky")
    level = sky.groupBy(*keys).agg(F.median("amp_sky").alias("chip_sky"))  # of at most eight
    shift = sky.join(level, keys).select(*keys, "amp", (F.col("amp_sky") - F.col("chip_sky")).alias("_d"))
    return (
        strips.join(shift, keys + ["amp"], "left")
        .withColumn("_d", F.coalesce("_d", F.lit(0.0)))
        .withColumn("values", F.transform("values", lambda v: v - F.col("_d")))
        .drop("_d")
    )


def _pattern_of(rows: Column, width: int, half: int) -> Column:
    """Median over amplifiers at each local x, the first half of the amplifiers mirrored."""
    folded = F.transform(
        rows, lambda s: F.when(s["amp"] < half, F.reverse(s["values"])).otherwise(s["values"])
    )

    def middle(i: Column) -> Column:
        v = F.array_sort(F.filter(F.transform(folded, lambda a: F.get(a, i)), lambda e: e.isNotNull()))
        n = F.size(v)
        return (F.get(v, F.floor((n - 1) / 2).cast("int")) + F.get(v, F.floor(n / 2).cast("int"))) / 2

    return F.transform(F.sequence(F.lit(0), F.lit(width - 1)), middle)


def pattern_noise(
    strips: DataFrame, keys: Sequence[str], width: int = AMP_WIDTH, amps: int = AMPS, subtract_if: Column | None = None
) -> DataFrame:
    """Electronic pattern common to the amplifiers of a detector row, in ``pattern``, and removed.

    The strips of one detector row (eight) meet in one group, so the pattern is
    subtracted without joining it back. ``subtract_if`` limits the removal to a site.
    """
    keys, half = list(keys), amps // 2
    extra = [c for c in strips.columns if c not in {*keys, "amp", "y", "values"}]
    rows = strips.groupBy(*keys, *extra, "y").agg(F.collect_list(F.struct("amp", "values")).alias("_rows"))
    rows = rows.withColumn("_pattern", _pattern_of(F.col("_rows"), width, half))
    flat = rows.select(*keys, *extra, "y", "_pattern", F.explode("_rows").alias("_s"))
    local = F.when(F.col("_s.amp") < half, F.reverse("_pattern")).otherwise(F.col("_pattern"))
    flat = flat.select(*keys, *extra, "y", F.col("_s.amp").alias("amp"), F.col("_s.values").alias("values"), local.alias("pattern"))
    cleaned = F.zip_with("values", "pattern", lambda v, p: v - p)
    if subtract_if is not None:
        cleaned = F.when(subtract_if, cleaned).otherwise(F.col("values"))
    return flat.withColumn("values", cleaned)


# --- masks -------------------------------------------------------------------


def crosstalk_mask(
    pixels: DataFrame, keys: Sequence[str], limit: float = CROSSTALK_LIMIT, width: int = AMP_WIDTH, amps: int = AMPS,
    dead: DataFrame | None = None, height: int = NAXIS2, dead_amp: int = 6,
) -> DataFrame:
    """Sparse victims of saturated pixels: ``keys, x, y, code`` (code = number of aggressors).

    A saturated pixel shows up in the amplifiers of the same parity, mirrored
    when the two lie in different halves; the most distant pairs (six apart) are
    too weak. ``dead`` lists frames whose amplifier ``dead_amp`` is 4 throughout.
    """
    from skyflow.operators import masks

    hot = masks.spans_of_pixels(pixels.where(F.col("value") > limit).withColumn("code", F.lit(1)), keys)
    return masks.span_pixels(masks.crosstalk_spans(hot, keys, width, amps, dead, height, dead_amp), keys)


def bleed_rows(column: np.ndarray, median: float, sigma: float, down: bool, limit: float, near: int, far: int, excess: float) -> np.ndarray:
    """Rows of one detector column covered by a bleed trail.

    A column that runs upward is handled by flipping it, so the scan always walks
    towards larger indices: a trail needs bright pixels between ``near`` and
    ``far`` rows ahead, and ends at ``BLEED_STOP`` dim pixels in a row, which are
    not part of it.
    """
    v = column[::-1] if down else column
    last = v.size - 1
    marked = np.zeros(v.size, dtype=bool)
    dim = v <= median + BLEED_SIGMA * sigma
    for start in np.flatnonzero(v > limit):
        a, b = min(start + near, last), min(start + far, last)
        if marked[start] or a >= b or v[a : b + 1].sum() - median * (b - a + 1) <= excess:
            continue
        run, end = 0, v.size
        for i in range(start, v.size):
            run = run + 1 if dim[i] else 0
            if run == BLEED_STOP:
                end = i + 1 - BLEED_STOP
                break
        marked[start:end] = True
    return np.flatnonzero(marked[::-1] if down else marked)


def bleed_mask(
    pixels: DataFrame, keys: Sequence[str], down: Column, limit: float = BLEED_LIMIT, near: int = BLEED_NEAR,
    far: int = BLEED_FAR, excess: float = BLEED_EXCESS, stats: DataFrame | None = None,
) -> DataFrame:
    """Bleed trails (code 8). Only columns with a saturated pixel are gathered (one detector column per group)."""
    keys = list(keys)
    if stats is None:
        stats = clip_summary(pixels, keys, "value", 3.0, maxiters=5)
    stats = stats.select(*keys, F.col("median").alias("_med"), F.col("std").alias("_sig"))
    hot = pixels.where(F.col("value") > limit).select(*keys, "x").distinct()
    columns = pixels.join(hot, keys + ["x"], "left_semi").join(stats, keys)
    columns = columns.select(*keys, "x", "y", "value", "_med", "_sig", down.alias("_down"))
    schema = T.StructType(
        [columns.schema[k] for k in keys]
        + [columns.schema["x"], columns.schema["y"], T.StructField("code", T.LongType())]
    )

    def one_column(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("y")
        rows = bleed_rows(
            block["value"].to_numpy(dtype=float), block["_med"].iloc[0], block["_sig"].iloc[0],
            bool(block["_down"].iloc[0]), limit, near, far, excess,
        )
        return block.iloc[rows][[*keys, "x", "y"]].assign(code=BLEED_CODE)

    return columns.groupBy(*keys, "x").applyInPandas(one_column, schema)


def combine_masks(masks: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Pixel-wise sum of sparse masks; a pixel absent from one counts 0 there."""
    cols = [*keys, "x", "y"]
    union = None
    for m in masks:
        part = m.select(*cols, F.col("code").cast("long").alias("code"))
        union = part if union is None else union.unionByName(part)
    return union.groupBy(*cols).agg(F.sum("code").alias("code")).where(F.col("code") != 0)


def zero_pixels(pixels: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Uncovered pixels of an image (value 0) as a mask of code 1."""
    return pixels.where(F.col("value") == 0).select(*keys, "x", "y", F.lit(1).cast("long").alias("code"))


def update_bad_pixel_mask(
    mask: DataFrame, bpm: DataFrame, frames: DataFrame, keys: Sequence[str], width: int = AMP_WIDTH, height: int = NAXIS2
) -> tuple[DataFrame, DataFrame]:
    """Mask + bad-pixel map with bad amplifiers set to 4, and ``photqa`` per frame.

    ``frames`` has ``keys, badamp`` (digit string); ``bpm`` has the same keys.
    """
    from skyflow.operators import masks

    spans, qa = masks.with_bad_amps(masks.spans_of_pixels(mask, keys), masks.spans_of_pixels(bpm, keys), frames, keys, width, height)
    return masks.span_pixels(spans, keys), qa


# --- background and scaling --------------------------------------------------


def background_map(pixels: DataFrame, keys: Sequence[str], mesh: int = MESH) -> DataFrame:
    """Clipped median per mesh cell, smoothed by the median of its 3 x 3 neighbours."""
    keys = list(keys)
    cell = keys + ["mx", "my"]
    placed = pixels.select(
        *keys, F.floor(F.col("x") / mesh).cast("int").alias("mx"), F.floor(F.col("y") / mesh).cast("int").alias("my"), "value"
    )
    return smooth_cells(clip_summary(placed, cell, "value", 3.0, maxiters=5).select(*cell, F.col("median").alias("raw")), keys)


def smooth_cells(raw: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Median of each mesh cell and its neighbours: ``raw`` -> ``background``."""
    keys = list(keys)
    cell = keys + ["mx", "my"]
    near = F.array(*[F.lit(d) for d in (-1, 0, 1)])
    spread = raw.withColumn("_dx", F.explode(near)).withColumn("_dy", F.explode(near))
    spread = spread.select(*keys, (F.col("mx") + F.col("_dx")).alias("mx"), (F.col("my") + F.col("_dy")).alias("my"), "raw")
    smooth = spread.groupBy(*cell).agg(F.median("raw").alias("background"))  # of at most nine
    return smooth.join(raw.select(*cell), cell, "left_semi")


def subtract_background(pixels: DataFrame, background: DataFrame, keys: Sequence[str], mesh: int = MESH) -> DataFrame:
    """Pixels less the background of their mesh cell; null in cells without one."""
    keys = list(keys)
    placed = pixels.withColumns(
        {"mx": F.floor(F.col("x") / mesh).cast("int"), "my": F.floor(F.col("y") / mesh).cast("int")}
    )
    return (
        placed.join(background.select(*keys, "mx", "my", "background"), keys + ["mx", "my"], "left")
        .withColumn("value", F.col("value") - F.col("background"))
        .drop("mx", "my", "background")
    )


def scale_zero_point(
    strips: DataFrame, fits: DataFrame, keys: Sequence[str], mode: str = "1DLINEAR", width: int = AMP_WIDTH
) -> DataFrame:
    """Strips scaled to zero point 30 by the trend of their amplifier; bad amplifiers keep scale 1."""
    keys = list(keys)
    joined = strips.join(fits, keys + ["amp"], "left")
    bad = F.coalesce("bad", F.lit(True))
    if mode == "1DLINEAR":
        ratio = flux_ratio(SCALED_ZERO_POINT + F.col("slope") * F.col("y") + F.col("intercept"))
        scale = F.when(bad, F.lit(1.0)).otherwise(ratio)
        out = joined.withColumn("scale", scale)
        return out.withColumn("values", F.transform("values", lambda v: v * F.col("scale"))).drop(
            *[c for c in fits.columns if c not in keys + ["amp"]]
        )
    if mode == "2DPOLYNOMIAL":
        surface = F.transform(
            "values",
            lambda v, i: v * F.when(bad, F.lit(1.0)).otherwise(
                flux_ratio(SCALED_ZERO_POINT + poly2d_value(F.col("amp") * width + i, F.col("y")))
            ),
        )
        return joined.withColumn("values", surface).drop(*[c for c in fits.columns if c not in keys + ["amp"]])
    raise ValueError("mode must be '1DLINEAR' or '2DPOLYNOMIAL'")


def scaled_saturation_2d(
    fits: DataFrame, keys: Sequence[str], width: int = AMP_WIDTH, height: int = NAXIS2, limit: float = SATURATION
) -> DataFrame:
    """``60000 * median(scale)`` per chip for surfaces: scales have 4 decimals, so a chip has few different ones to count."""
    rows = fits.withColumn("y", F.explode(F.sequence(F.lit(0), F.lit(height - 1))))
    bad = F.coalesce("bad", F.lit(True))
    scale = F.transform(
        F.sequence(F.lit(0), F.lit(width - 1)),
        lambda i: F.when(bad, F.lit(1.0)).otherwise(flux_ratio(SCALED_ZERO_POINT + poly2d_value(F.col("amp") * width + i, F.col("y")))),
    )
    middle = strip_median(rows.select(*keys, scale.alias("values")), keys, "_mid")
    return middle.select(*keys, (F.col("_mid") * limit).alias("saturate"))


def scaled_saturation(
    fits: DataFrame, keys: Sequence[str], height: int = NAXIS2, limit: float = SATURATION
) -> DataFrame:
    """``60000 * median(scale)`` per chip: the scale only depends on (amp, y), so 8 x height values."""
    rows = fits.withColumn("y", F.explode(F.sequence(F.lit(0), F.lit(height - 1))))
    scale = F.when(F.col("bad"), F.lit(1.0)).otherwise(
        flux_ratio(SCALED_ZERO_POINT + F.col("slope") * F.col("y") + F.col("intercept"))
    )
    return exact_median(rows.withColumn("_s", scale), keys, "_s", "_m").select(
        *keys, (F.lit(limit) * F.col("_m")).alias("saturate")
    )


# --- differencing ------------------------------------------------------------


def tile_image(pixels: DataFrame, shape_x: int, shape_y: int, div_col: int, div_row: int) -> DataFrame:
    """Sector columns and sector-local coordinates; the last sector also has the remainder beyond it."""
    step_x, step_y = shape_x // div_col, shape_y // div_row
    return (
        pixels.withColumns(
            {
                "sect_x": F.least(F.floor(F.col("x") / step_x), F.lit(div_col - 1)).cast("int"),
                "sect_y": F.least(F.floor(F.col("y") / step_y), F.lit(div_row - 1)).cast("int"),
            }
        )
        .withColumns(
            {
                "tile": F.col("sect_x") * div_col + F.col("sect_y"),
                "x_tile": F.col("x") - F.col("sect_x") * step_x,
                "y_tile": F.col("y") - F.col("sect_y") * step_y,
            }
        )
    )


def difference(science: DataFrame, reference: DataFrame, mask: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Science minus reference on aligned pixels; masked pixels and those without a reference take the null value.

    The sign is always science minus reference, whichever side was convolved.
    """
    on = [*keys, "x", "y"]
    ref = reference.select(*on, F.col("value").alias("_ref"))
    flagged = mask.where(F.col("code") != 0).select(*on, F.lit(True).alias("_masked"))
    joined = science.select(*on, "value").join(ref, on, "left").join(flagged, on, "left")
    value = F.when(F.col("_masked") | F.col("_ref").isNull(), F.lit(NULL_PIXEL)).otherwise(F.col("value") - F.col("_ref"))
    return joined.select(*on, value.alias("value"))


def pick_convolution_side(images: DataFrame) -> DataFrame:
    """The sharper image is convolved: the reference when it is not the blurrier one or a seeing is unknown."""
    swap = F.coalesce(F.col("ref_fwhm") > F.col("sci_fwhm"), F.lit(False))
    return images.withColumns(
        {"convolved": F.when(swap, "science").otherwise("reference"), "inverted": swap}
    )


def stamp_list(
    science: DataFrame, reference: DataFrame, keys: Sequence[str], step_x: float, step_y: float, min_stars: int = 20
) -> tuple[DataFrame, DataFrame]:
    """Star stamps per sector and whether the sector has more than ``min_stars`` of them."""
    from skyflow.operators.match import sky_match
    from skyflow.operators.selection import section, subtraction_stars

    stars = sky_match(
        subtraction_stars(science, 0.8), subtraction_stars(reference, 0.9), 0.4, keys=keys,
        right_pos=("alpha_j2000", "delta_j2000"), right_id="number",
    )
    placed = section(stars, step_x, step_y)
    sectors = placed.groupBy(*keys, "sect_x", "sect_y").agg(F.count("*").alias("n_stamps"))
    return placed, sectors.withColumn("use_list", F.col("n_stamps") > min_stars)


def _touched(lo: Column, hi: Column, cell: int) -> Column:
    return F.sequence(F.floor(lo / cell).cast("int"), F.floor(hi / cell).cast("int"))


def box_pixels(boxes: DataFrame, pixels: DataFrame, keys: Sequence[str], ident: Sequence[str], cell: int) -> DataFrame:
    """Pixels inside ``[x0, x1) x [y0, y1)`` boxes: equi-join on the cells a box touches."""
    keys = list(keys)
    carried = [c for c in boxes.columns if c not in keys]
    spots = (
        boxes.where((F.col("x1") > F.col("x0")) & (F.col("y1") > F.col("y0")))
        .withColumn("_cx", F.explode(_touched(F.col("x0"), F.col("x1") - 1, cell)))
        .withColumn("_cy", F.explode(_touched(F.col("y0"), F.col("y1") - 1, cell)))
    )
    grid = pixels.select(
        *keys, F.col("x").alias("_px"), F.col("y").alias("_py"), "value",
        F.floor(F.col("x") / cell).cast("int").alias("_cx"), F.floor(F.col("y") / cell).cast("int").alias("_cy"),
    )
    return (
        spots.join(grid, keys + ["_cx", "_cy"])
        .where((F.col("_px") >= F.col("x0")) & (F.col("_px") < F.col("x1")))
        .where((F.col("_py") >= F.col("y0")) & (F.col("_py") < F.col("y1")))
        .select(*keys, *carried, "_px", "_py", "value")
    )


def stat_boxes(candidates: DataFrame, keys: Sequence[str], ident: str, half: Column | None = None) -> DataFrame:
    """Box of each candidate, the seeing (px) on each side, and the value ``_cut`` below which a pixel is bad."""
    half = half if half is not None else F.col("seeing") / 0.4

    def at(c: Column) -> Column:
        return F.greatest(F.lit(0), F.floor(c)).cast("int")

    return candidates.select(
        *keys, ident, (F.col("background") - 25.0 * F.col("sky_sigma")).alias("_cut"),
        at(F.col("x_image") - half).alias("x0"), at(F.col("x_image") + half).alias("x1"),
        at(F.col("y_image") - half).alias("y0"), at(F.col("y_image") + half).alias("y1"),
    ).distinct()


def pixel_stats(
    candidates: DataFrame, pixels: DataFrame, keys: Sequence[str], ident: str = "number", half: Column | None = None, cell: int = 16
) -> DataFrame:
    """Per candidate box: ``n_box, n_bad, ratio_bad, n_null``.

    Bad means below ``background - 25 sky_sigma``, null is the differencing null value.
    """
    keys = list(keys)
    boxes = stat_boxes(candidates, keys, ident, half)
    inside = box_pixels(boxes, pixels, keys, [ident], cell)
    stats = inside.groupBy(*keys, ident, "x0", "y0").agg(
        F.count("*").alias("n_box"),
        F.count_if(F.col("value") < F.col("_cut")).alias("n_bad"),
        F.count_if(F.col("value").cast("float") == F.lit(NULL_PIXEL).cast("float")).alias("n_null"),
    ).drop("x0", "y0")
    out = candidates.select(*keys, ident).distinct().join(stats, keys + [ident], "left")
    out = out.na.fill(0, ["n_box", "n_bad", "n_null"])
    ratio = F.when(F.col("n_box") > 0, F.col("n_bad") / F.col("n_box")).otherwise(F.lit(-99.0))
    return out.withColumn("ratio_bad", ratio)


def cutouts(
    candidates: DataFrame, images: DataFrame, keys: Sequence[str], size: int, ident: str = "number",
    x: str = "x_image", y: str = "y_image", cell: int = MESH,
) -> DataFrame:
    """Square stamps ``size x size`` (row-major, zero padded) and covered pixels per candidate and image ``kind``.

    A candidate without a pixel in a kind has a stamp of zeros there, and ``covered`` 0.

    ``images`` is the long pixel form with a ``kind`` column (new, ref, sub).
    """
    keys = list(keys)
    low = F.floor(F.col(x)) - size // 2, F.floor(F.col(y)) - size // 2
    boxes = candidates.select(
        *keys, ident, low[0].cast("int").alias("x0"), low[1].cast("int").alias("y0")
    ).withColumns({"x1": F.col("x0") + size, "y1": F.col("y0") + size})
    kinds = images.select(*keys, "kind", "x", "y", "value")
    wanted = boxes.withColumn("kind", F.explode(F.array(*[F.lit(k) for k in ("new", "ref", "sub")])))
    inside = box_pixels(wanted, kinds, keys + ["kind"], [ident], cell)
    slot = (F.col("_py") - F.col("y0")) * size + (F.col("_px") - F.col("x0"))
    listed = inside.groupBy(*keys, ident, "kind").agg(
        F.array_sort(F.collect_list(F.struct(slot.alias("k"), F.col("value").alias("v")))).alias("_l")
    )
    tail = F.array_repeat(F.lit(0.0), size * size - 1 - F.element_at("_l", -1)["k"])
    stamps = listed.select(*keys, ident, "kind", F.concat(place_values("_l", F.lit(0.0)), tail).alias("stamp"), F.size("_l").alias("covered"))
    every = wanted.select(*keys, ident, "kind").join(stamps, [*keys, ident, "kind"], "left")
    stamp = F.coalesce("stamp", F.array_repeat(F.lit(0.0), size * size))
    return every.select(*keys, ident, "kind", stamp.alias("stamp"), F.coalesce("covered", F.lit(0)).alias("covered"))


def reference_coverage(candidates: DataFrame, wcs: DataFrame, keys: Sequence[str], out: str = "flag_12") -> DataFrame:
    """Candidates that fall outside the reference image (``wcs, naxis1, naxis2`` per key).

    Without a place on its tangent plane, or without a reference image at all, a candidate is outside.
    """
    from skyflow.functions.wcs import to_pixel

    placed = to_pixel(
        candidates.join(wcs.select(*keys, "wcs", "naxis1", "naxis2"), list(keys), "left"),
        "alpha_j2000", "delta_j2000", "wcs", "x_refim", "y_refim",
    )
    x, y = F.col("x_refim"), F.col("y_refim")
    inside = x.between(0, F.col("naxis1")) & y.between(0, F.col("naxis2"))
    return placed.withColumn(out, ~F.coalesce(inside, F.lit(False))).drop("wcs", "naxis1", "naxis2")
