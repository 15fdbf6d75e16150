"""Transient-candidate flags. Each function adds one boolean column.

``keys`` identify a difference image (sector). Flags 4 and 13 are never set.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from skyflow.operators.clip import exact_medians
from skyflow.operators import strips as sp
from skyflow.operators.match import attach, moving_object_flag, sky_nearest
from skyflow.operators.photometry import background_stats
from skyflow.operators.pixels import pixel_stats, reference_coverage
from skyflow.operators.selection import candidate_columns

# Fixed values of the cuts.
EDGE_FRACTION, ELLIPTICITY_CUT, FLAG_CUT, FWHM_CUT, SNR_CUT = 0.99, 4.0, 4, (0.7, 2.4), 5.0
BAD_FRACTION, SKY_SIGMAS = 0.1, 2.0
INVERSE_MAG, INVERSE_REF_MAG = -0.1, -0.5
FLAGS = list(range(14))


def image_stats(science: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Seeing (arcsec), median ellipticity and elongation of the science stars of an image."""
    return exact_medians(
        science, keys,
        {"seeing": F.col("fwhm_image") * 0.4, "med_ellipticity": F.col("ellipticity"), "med_elongation": F.col("elongation")},
    )


def prepare(candidates: DataFrame, science: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach image statistics and background spread, then the derived columns."""
    stats = image_stats(science, keys)
    sky = background_stats(candidates, keys)
    return candidate_columns(attach(attach(candidates, stats, keys), sky, keys))


def _inverse_flag(df: DataFrame, inverse: DataFrame, keys, threshold: float, out: str, inverse_id: str) -> DataFrame:
    near = sky_nearest(
        df, inverse, keys=keys, right_id=inverse_id, right_cols=["mag_auto"], prefix="inv_", sep_col="inv_sep"
    )
    hit = (F.col("inv_sep") < F.col("seeing") / 2) | (
        F.col("mag_cal") - F.col("inv_mag_auto") - F.col("magzero") > threshold
    )
    return near.withColumn(out, F.coalesce(hit, F.lit(False))).drop("inv_sep", "inv_mag_auto", "inv_" + inverse_id)


def flag_0(df: DataFrame, ephemeris: DataFrame, keys: Sequence[str], **kw) -> DataFrame:
    return moving_object_flag(df, ephemeris, keys=keys, out="flag_0", **kw)


def flag_1(df: DataFrame, inverse: DataFrame, keys: Sequence[str], inverse_id: str = "number") -> DataFrame:
    """Near a source of the inverted difference, or not much fainter than the nearest one."""
    return _inverse_flag(df, inverse, keys, INVERSE_MAG, "flag_1", inverse_id)


def flag_2(df: DataFrame, inverse_ref: DataFrame, keys: Sequence[str], inverse_id: str = "number") -> DataFrame:
    return _inverse_flag(df, inverse_ref, keys, INVERSE_REF_MAG, "flag_2", inverse_id)


def flag_3(df: DataFrame, step_x: int, step_y: int, x: str = "x_image", y: str = "y_image") -> DataFrame:
    """Within one percent of the sector edge."""
    tests = []
    for c, step in ((x, step_x), (y, step_y)):
        mid = step // 2
        tests += [F.col(c) < mid - mid * EDGE_FRACTION, F.col(c) > mid + mid * EDGE_FRACTION]
    return df.withColumn("flag_3", reduce(lambda a, b: a | b, tests))


def flag_4(df: DataFrame) -> DataFrame:
    return df.withColumn("flag_4", F.lit(False))


def flag_5(df: DataFrame) -> DataFrame:
    return df.withColumn("flag_5", F.coalesce(F.col("ratio_ellipticity") > ELLIPTICITY_CUT, F.lit(False)))


def flag_6(df: DataFrame) -> DataFrame:
    return df.withColumn("flag_6", (F.col("flags") >= FLAG_CUT) | (F.col("imaflags_iso") > 0))


def flag_7(df: DataFrame) -> DataFrame:
    r = F.col("ratio_seeing")
    return df.withColumn("flag_7", F.coalesce((r < FWHM_CUT[0]) | (r > FWHM_CUT[1]), F.lit(False)))


def flag_8(df: DataFrame) -> DataFrame:
    off = F.abs(F.col("background") - F.col("sky_median")) > SKY_SIGMAS * F.col("sky_sigma")
    return df.withColumn("flag_8", F.coalesce(off, F.lit(False)))


def flag_9(df: DataFrame) -> DataFrame:
    return df.withColumn("flag_9", F.col("snr") < SNR_CUT)


def flags_10_11(df: DataFrame, pixels: DataFrame, keys: Sequence[str], ident: str = "number", **kw) -> DataFrame:
    """Dipole (more than 10 % deep-negative box pixels) and null pixels in the box; ``pixels`` as strips or long."""
    of_boxes = sp.pixel_stats if "values" in pixels.columns else pixel_stats
    stats = of_boxes(df, pixels, keys, ident, **kw)
    joined = df.join(stats, [*keys, ident], "left")
    return joined.withColumns(
        {"flag_10": F.col("n_bad") > F.col("n_box") * BAD_FRACTION, "flag_11": F.col("n_null") != 0}
    )


def flag_12(df: DataFrame, wcs: DataFrame, keys: Sequence[str]) -> DataFrame:
    return reference_coverage(df, wcs, keys, "flag_12")


def flag_13(df: DataFrame) -> DataFrame:
    return df.withColumn("flag_13", F.lit(False))


def final_flag(df: DataFrame) -> DataFrame:
    """Any flag set, except that moving objects are kept; missing flag columns count as false."""
    missing = {f"flag_{n}": F.lit(False) for n in FLAGS if f"flag_{n}" not in df.columns}
    df = df.withColumns(missing) if missing else df
    any_set = reduce(lambda a, b: a | b, [F.coalesce(f"flag_{n}", F.lit(False)) for n in FLAGS])
    return df.withColumn("flag", any_set & ~F.coalesce("flag_0", F.lit(False)))


def transients(df: DataFrame) -> DataFrame:
    return df.where(~F.col("flag"))


def flag_summary(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows ``keys, flag_name, n, percent``; the kept share is the row ``kept`` (3 decimals in ``share``)."""
    keys = list(keys)
    counts = [F.count_if(f"flag_{n}").alias(f"flag_{n}") for n in FLAGS]
    wide = df.groupBy(*keys).agg(F.count("*").alias("n_all"), *counts, F.count_if(~F.col("flag")).alias("kept"))
    names = [f"flag_{n}" for n in FLAGS] + ["kept"]
    long = wide.unpivot(keys + ["n_all"], names, "flag_name", "n")
    return long.select(
        *keys, "flag_name", "n",
        F.floor(F.try_divide(F.col("n") * 100, "n_all")).cast("long").alias("percent"),
        F.round(F.try_divide(F.col("n") * 100.0, "n_all"), 3).alias("share"),
    )


def vet(
    candidates: DataFrame, science: DataFrame, keys: Sequence[str], *, inverse: DataFrame, inverse_ref: DataFrame,
    ephemeris: DataFrame, step: tuple[int, int], pixels: DataFrame | None = None, wcs: DataFrame | None = None,
    ephemeris_args: dict | None = None, inverse_id: str = "number",
) -> DataFrame:
    """The whole chain on the difference catalogue of one or many images.

    Steps that read their candidates more than once come before the matches, and those that run jobs before the one that
    runs none, so no match is computed again by a step behind it.
    """
    df = prepare(candidates, science, keys)
    if pixels is not None:
        df = flags_10_11(df, pixels, keys)
    df = flag_1(df, inverse, keys, inverse_id)
    df = flag_2(df, inverse_ref, keys, inverse_id)
    df = flag_0(df, ephemeris, keys, **(ephemeris_args or {}))
    for f in (flag_4, flag_5, flag_6, flag_7, flag_8, flag_9, flag_13):
        df = f(df)
    df = flag_3(df, *step)
    if wcs is not None:
        df = flag_12(df, wcs, keys)
    return final_flag(df)
