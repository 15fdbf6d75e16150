"""Row selections and derived columns of source catalogues."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from skyflow.functions.naming import AMPS, NAXIS1
from skyflow.functions.photsys import NO_MAG, rss
from skyflow.operators.clip import exact_median


def zp_star_cuts(
    ref_mag: str, ref_err: str, mag_err: str, *, flags: str = "flags", flag_cut: int = 0,
    lower: float = 14.0, upper: float = 17.0, ref_err_max: float = 0.05, mag_err_max: float = 0.1,
) -> dict[str, Column]:
    return {
        "flag": F.col(flags) <= flag_cut,
        "ref": (F.col(ref_mag) < upper) & (F.col(ref_mag) > lower) & (F.col(ref_err) < ref_err_max),
        "err": F.col(mag_err) < mag_err_max,
    }


def select_zp_stars(df: DataFrame, ref_mag: str, ref_err: str, mag_err: str, **cuts) -> DataFrame:
    """Stars fit for a zero point; every bound is strict except the flag cut."""
    c = zp_star_cuts(ref_mag, ref_err, mag_err, **cuts)
    return df.where(c["flag"] & c["ref"] & c["err"])


def zp_star_report(df: DataFrame, keys: Sequence[str], ref_mag: str, ref_err: str, mag_err: str, **cuts) -> DataFrame:
    """How many rows pass each cut, in one aggregate."""
    c = zp_star_cuts(ref_mag, ref_err, mag_err, **cuts)
    return df.groupBy(*keys).agg(
        F.count("*").alias("n_all"),
        F.count_if(c["flag"]).alias("n_flag"),
        F.count_if(c["ref"]).alias("n_ref"),
        F.count_if(c["err"]).alias("n_err"),
        F.count_if(c["flag"] & c["ref"] & c["err"]).alias("n_pass"),
    )


def drop_incomplete(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def clean_sources(df: DataFrame) -> DataFrame:
    return df.where((F.col("flags") == 0) & (F.col("imaflags_iso") == 0)).withColumn(
        "kron_radius_a", F.col("kron_radius") * F.col("a_image")
    )


def fwhm_sample(df: DataFrame) -> DataFrame:
    return df.where(fwhm_condition())


def fwhm_condition() -> Column:
    return (
        (F.col("mag_auto") != NO_MAG) & (F.col("magerr_auto") <= 0.005) & (F.col("flags") == 0)
        & (F.col("fwhm_image") <= 30)
    )


def elong_condition() -> Column:
    return (F.col("mag_auto") != NO_MAG) & (F.col("magerr_auto") <= 0.005) & (F.abs("theta_image") < 88)


def elong_sample(df: DataFrame) -> DataFrame:
    return df.where(elong_condition())


def zp_sample(df: DataFrame, group: Sequence[str], ref_mag: str) -> DataFrame:
    """Matched stars of an amplifier that are more star-like than its median source."""
    middle = exact_median(df, group, "class_star", "_mid")
    return (
        df.join(middle, list(group))
        .where((F.col("mag_auto") != NO_MAG) & (F.col("flags") < 4) & F.col(ref_mag).isNotNull() & ~F.isnan(ref_mag))
        .where(F.col("class_star") > F.col("_mid"))
        .drop("_mid")
    )


def subtraction_stars(df: DataFrame, class_cut: float = 0.8) -> DataFrame:
    """Science stars for differencing (0.8); the reference side uses 0.9."""
    return df.where(
        (F.col("flags") == 0) & (F.col("class_star") > class_cut) & (F.col("mag_auto") > 14) & (F.col("mag_auto") < 20)
    )


def seeing_sample(df: DataFrame, group: Sequence[str], class_cut: float | None = None) -> DataFrame:
    """Stars for a seeing estimate: above the median stellarity, clean, well measured.

    With ``class_cut`` only that fixed stellarity is asked for.
    """
    if class_cut is not None:
        return df.where(F.col("class_star") > class_cut)
    middle = exact_median(df, group, "class_star", "_mid")
    return (
        df.join(middle, list(group))
        .where((F.col("class_star") > F.col("_mid")) & (F.col("flags") == 0) & (F.col("magerr_auto") < 0.05))
        .drop("_mid")
    )


def section(df: DataFrame, step_x: float, step_y: float, x: str = "x_image", y: str = "y_image") -> DataFrame:
    """Sector of each row and its coordinates there; rows exactly on a border belong to none."""
    sx, sy = F.floor(F.col(x) / step_x), F.floor(F.col(y) / step_y)
    return (
        df.withColumns({"sect_x": sx, "sect_y": sy})
        .where((F.col(x) > F.col("sect_x") * step_x) & (F.col(y) > F.col("sect_y") * step_y))
        .withColumns(
            {"x_sect": F.col(x) - F.col("sect_x") * step_x, "y_sect": F.col(y) - F.col("sect_y") * step_y}
        )
    )


def amp_index(x: Column | str, naxis1: int = NAXIS1, n: int = AMPS) -> Column:
    c = F.col(x) if isinstance(x, str) else x
    width = naxis1 // n
    amp = F.floor(c / width).cast("int")
    return F.when((c > amp * width) & (c < (amp + 1) * width) & amp.between(0, n - 1), amp)


def amp_of(df: DataFrame, x: str = "x_image", naxis1: int = NAXIS1, n: int = AMPS) -> DataFrame:
    """Amplifier 0..n-1; rows on an amplifier border (or off the chip) are dropped."""
    return df.withColumn("amp", amp_index(x, naxis1, n)).where(F.col("amp").isNotNull())


def snr(mag_err: Column | str) -> Column:
    c = F.col(mag_err) if isinstance(mag_err, str) else mag_err
    return 1.0 / (c + 0.0001)


def candidate_columns(df: DataFrame, zp: str = "magzero") -> DataFrame:
    """Signal-to-noise, calibrated magnitude and ratios to the image medians."""
    return df.withColumns(
        {
            "snr": snr("magerr_auto"),
            "mag_cal": F.col("mag_auto") + F.col(zp),
            "ratio_seeing": F.try_divide(F.col("fwhm_world") * 3600.0, F.col("seeing")),
            "ratio_ellipticity": F.try_divide(F.col("ellipticity"), F.col("med_ellipticity")),
            "ratio_elongation": F.try_divide(F.col("elongation"), F.col("med_elongation")),
        }
    )


def apply_zp(df: DataFrame, zp: DataFrame, keys: Sequence[str], mags: Sequence[tuple[str, str]] = (("mag_auto", "magerr_auto"),)) -> DataFrame:
    """Calibrated magnitudes (capped at 99) and errors from a per-image ``zp, zper`` row."""
    out = df.join(zp.select(*keys, "zp", "zper"), list(keys), "left")
    cols = {}
    for mag, err in mags:
        cols[mag] = F.least(F.col(mag) + F.bround("zp", 3), F.lit(NO_MAG))
        cols[err] = rss(err, F.bround("zper", 3))
    return out.withColumns(cols)
