"""Zero points, trends over the detector, depths."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from skyflow.functions.naming import NAXIS1, NAXIS2
from skyflow.functions.photsys import NO_MAG, SCALED_ZERO_POINT, limit_mag
from skyflow.operators.clip import clip_summary, exact_median
from skyflow.operators.fits import depth_fit, huber_fit

POLY_TERMS = ["xx", "yy", "xy", "x", "y", "one"]


def zero_point(
    df: DataFrame, keys: Sequence[str], mag: str, ref_mag: str, sigma: float = 2.0, bound: DataFrame | None = None
) -> DataFrame:
    """``zp, zper, n_kept, n_clipped`` per group from clipped ``ref - instrumental`` differences."""
    usable = df.where((F.col(mag) != NO_MAG) & (F.col(ref_mag) != NO_MAG)).withColumn(
        "_zp", F.col(ref_mag) - F.col(mag)
    )
    stats = clip_summary(usable, keys, "_zp", sigma, bound=bound)
    return stats.select(
        *keys, F.col("median").alias("zp"), F.col("std").alias("zper"), "n_kept",
        (F.col("n_all") - F.col("n_kept")).alias("n_clipped"),
    )


def photometric_residual(
    df: DataFrame, zp: DataFrame, keys: Sequence[str], mag: str, ref_mag: str, *, lower: float = 14.0,
    upper: float = 17.0, flag_cut: int = 0, class_cut: float = 0.8, bound: DataFrame | None = None,
) -> DataFrame:
    """Median offset and clipped RMS of calibrated minus reference magnitude (3 decimals)."""
    keys = list(keys)
    stars = (
        df.where((F.col("flags") <= flag_cut) & (F.col("class_star") > class_cut))
        .where((F.col(ref_mag) < upper) & (F.col(ref_mag) > lower) & (F.col(mag) != NO_MAG))
        .join(zp.select(*keys, "zp"), keys)
        .withColumn("_d", F.col(mag) + F.col("zp") - F.col(ref_mag))
    )
    middle = exact_median(stars, keys, "_d", "_med")
    spread = clip_summary(stars, keys, "_d", 3.0, bound=bound)
    return middle.join(spread, keys).select(
        *keys, F.bround("_med", 3).alias("meddif"), F.bround("rms", 3).alias("rmse")
    )


def match_rms(df: DataFrame, keys: Sequence[str], sep: str = "sep", bound: DataFrame | None = None) -> DataFrame:
    """Number, RMS and spread of the clipped separations (5 decimals)."""
    stats = clip_summary(df, keys, sep, 3.0, bound=bound)
    return stats.select(
        *keys, F.col("n_kept").alias("aln_num"), F.bround("rms", 5).alias("aln_rms"), F.bround("std", 5).alias("aln_std")
    )


def background_stats(df: DataFrame, keys: Sequence[str], col: str = "background") -> DataFrame:
    """Exact median and population deviation of the background per image."""
    spread = df.groupBy(*keys).agg(F.stddev_pop(col).alias("sky_sigma"))
    return exact_median(df, keys, col, "sky_median").join(spread, list(keys))


def linear_trend(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Least-squares line by mergeable sums."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
    )


def amp_zero_point_fit(
    df: DataFrame, keys: Sequence[str], mag: str, ref_mag: str, y: str = "y_image", large: int | None = None,
    bound: DataFrame | None = None,
) -> DataFrame:
    """Robust trend of ``instrumental - ref`` along y per amplifier.

    A poor score (not above -0.1) or fewer than 3 stars falls back to least
    squares; an amplifier with at most 2 stars is bad. Output: ``slope,
    intercept, score, n_fit, method, bad, converged``.
    """
    keys = list(keys)
    points = df.withColumn("_d", F.col(mag) - F.col(ref_mag))
    robust = huber_fit(points, keys, y, "_d", large, bound)
    plain = linear_trend(points, keys, y, "_d").select(
        *keys, F.col("slope").alias("ls_slope"), F.col("intercept").alias("ls_intercept")
    )
    good = (F.col("score") > -0.1) & ~F.isnan("score") & (F.col("n") >= 3)
    bad = F.col("n") <= 2
    return robust.join(plain, keys, "left").select(
        *keys,
        F.when(bad, F.lit(0.0)).when(good, F.col("slope")).otherwise(F.col("ls_slope")).alias("slope"),
        F.when(bad, F.lit(-SCALED_ZERO_POINT)).when(good, F.col("intercept")).otherwise(F.col("ls_intercept")).alias("intercept"),
        F.col("score"),
        F.col("n").alias("n_fit"),
        F.when(bad, F.lit("none")).when(good, F.lit("huber")).otherwise(F.lit("least_squares")).alias("method"),
        bad.alias("bad"),
        F.when(bad | ~good, F.lit(True)).otherwise(F.col("converged")).alias("converged"),
    )


def poly2d_basis(x: Column, y: Column, naxis1: int = NAXIS1, naxis2: int = NAXIS2) -> dict[str, Column]:
    """Quadratic terms in coordinates scaled to [-1, 1] (x^4 of raw pixels loses digits)."""
    u, v = x / (naxis1 / 2.0) - 1.0, y / (naxis2 / 2.0) - 1.0
    return {"xx": u * u, "yy": v * v, "xy": u * v, "x": u, "y": v, "one": F.lit(1.0)}


def poly2d_moments(df: DataFrame, keys: Sequence[str], x: str, y: str, z: str, naxis1: int = NAXIS1, naxis2: int = NAXIS2) -> DataFrame:
    """The 21 + 6 sums of the normal equations, one mergeable aggregate."""
    basis = poly2d_basis(F.col(x), F.col(y), naxis1, naxis2)
    sums = [
        F.sum(basis[a] * basis[b]).alias(f"s_{a}_{b}")
        for i, a in enumerate(POLY_TERMS) for b in POLY_TERMS[i:]
    ]
    sums += [F.sum(basis[a] * F.col(z)).alias(f"t_{a}") for a in POLY_TERMS]
    return df.groupBy(*keys).agg(F.count("*").alias("n"), *sums)


def poly2d_fit(df: DataFrame, keys: Sequence[str], x: str, y: str, z: str, naxis1: int = NAXIS1, naxis2: int = NAXIS2) -> DataFrame:
    """Six-term quadratic surface per group: coefficients ``c_xx .. c_one`` of the scaled terms.

    The surface is fitted and evaluated in the same (chip) frame.
    """
    moments = poly2d_moments(df, keys, x, y, z, naxis1, naxis2)
    schema = T.StructType(
        [moments.schema[k] for k in keys] + [T.StructField("n", T.LongType())]
        + [T.StructField(f"c_{t}", T.DoubleType()) for t in POLY_TERMS]
    )
    keys, names = list(keys), [f"c_{t}" for t in POLY_TERMS]

    def solve(blocks):
        for block in blocks:
            a = np.empty((len(block), 6, 6))
            for i, p in enumerate(POLY_TERMS):
                for j, q in enumerate(POLY_TERMS[i:], i):
                    a[:, i, j] = a[:, j, i] = block[f"s_{p}_{q}"]
            t = block[[f"t_{p}" for p in POLY_TERMS]].to_numpy(dtype=float)
            coef = np.stack([np.linalg.lstsq(m, v, rcond=None)[0] for m, v in zip(a, t)]) if len(block) else np.empty((0, 6))
            yield pd.concat(
                [block[keys + ["n"]].reset_index(drop=True), pd.DataFrame(coef, columns=names)], axis=1
            )

    return moments.mapInPandas(solve, schema)


def amp_surface_fit(df: DataFrame, keys: Sequence[str], mag: str, ref_mag: str, x: str = "x_image", y: str = "y_image") -> DataFrame:
    """Quadratic surface of ``instrumental - ref`` per amplifier: its coefficients, ``n_fit`` and ``bad``.

    Six stars are needed; an amplifier with fewer, or with a surface that is not finite, is bad.
    """
    keys, names = list(keys), [f"c_{t}" for t in POLY_TERMS]
    surface = poly2d_fit(df.withColumn("_d", F.col(mag) - F.col(ref_mag)), keys, x, y, "_d")
    lost = F.greatest(*[(F.col(c).isNull() | F.isnan(c)).cast("int") for c in names]) == 1
    return surface.select(*keys, *names, F.col("n").alias("n_fit"), ((F.col("n") < len(POLY_TERMS)) | lost).alias("bad"))


def poly2d_value(x: Column, y: Column, naxis1: int = NAXIS1, naxis2: int = NAXIS2) -> Column:
    basis = poly2d_basis(x, y, naxis1, naxis2)
    total = F.lit(0.0)
    for t in POLY_TERMS:
        total = total + F.col(f"c_{t}") * basis[t]
    return total


def depth_from_errors(df: DataFrame, keys: Sequence[str], mag: str = "mag_aper", err: str = "magerr_aper", class_cut: float = 0.8, large: int | None = None) -> DataFrame:
    """5-sigma depth from the exponential growth of errors with magnitude; -99 when no fit is good."""
    stars = df.where((F.col("flags") < 4) & (F.col("class_star") >= class_cut))
    return depth_fit(stars, keys, mag, err, large)


def depth_from_sky(rms_pixels: DataFrame, zp: DataFrame, keys: Sequence[str], value: str = "value", aperture_px: float = 5 / 0.4, n_sigma: float = 5) -> DataFrame:
    """Depth from the median non-zero pixel of a background-noise image."""
    keys = list(keys)
    sky = exact_median(rms_pixels.where(F.col(value) != 0), keys, value, "sky_sigma")
    return sky.join(zp.select(*keys, "zp"), keys).withColumn("depth", limit_mag(n_sigma, "zp", aperture_px, "sky_sigma"))


def badamp_code(amps: DataFrame, keys: Sequence[str], n: int = 8) -> DataFrame:
    """Digit string with 1 at the position of every bad amplifier, and ``photqa``."""
    collected = amps.groupBy(*keys).agg(F.collect_set(F.when(F.col("bad"), F.col("amp"))).alias("_bad"))
    digits = F.concat_ws(
        "", F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.when(F.array_contains("_bad", i), "1").otherwise("0"))
    )
    return collected.select(*keys, digits.alias("badamp"), (F.size("_bad") == 0).alias("photqa"))


def amps_after_fit(fits: DataFrame, chips: DataFrame, keys: Sequence[str], n: int = 8) -> DataFrame:
    """All amplifiers of the given chips; those without any fit are bad (lines: slope 0, offset -30)."""
    keys = list(keys)
    every = chips.select(*keys).distinct().withColumn("amp", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    joined = every.join(fits, keys + ["amp"], "left")
    filled = {"bad": F.coalesce("bad", F.lit(True))}
    if "slope" in fits.columns:
        filled |= {"slope": F.coalesce("slope", F.lit(0.0)), "intercept": F.coalesce("intercept", F.lit(-SCALED_ZERO_POINT))}
    return joined.withColumns(filled)
