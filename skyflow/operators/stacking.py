"""Which frames can be stacked, with what, and the averaged stack itself.

Tables here hold one row per file (about 10^5 for 100 TB of exposures); only
``coadd`` touches pixels.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from skyflow.functions.naming import CHIPS
from skyflow.functions.timeconv import from_mjd, to_mjd
from skyflow.functions.wcs import tan_struct, to_pixel, to_world

GOOD_AMPS, CTIO_AMPS, SAAO_NN_AMPS = "00000000", "00000010", "00000001"


def stackable_condition() -> Column:
    code = F.col("badamp")
    return F.col("qaresult") & (
        (code == GOOD_AMPS)
        | ((code == CTIO_AMPS) & (F.col("site") == "CTIO"))
        | ((code == SAAO_NN_AMPS) & (F.col("site") == "SAAO") & (F.col("chip") == "nn"))
    )


def stackable(chips: DataFrame) -> DataFrame:
    return chips.where(stackable_condition())


def full_frames(chips: DataFrame, frame: Sequence[str] = ("frame_id",)) -> DataFrame:
    """Rows of the frames for which all four chips are present."""
    complete = (
        chips.where(F.col("chip").isin(CHIPS)).groupBy(*frame)
        .agg(F.size(F.collect_set("chip")).alias("_n")).where(F.col("_n") == len(CHIPS)).select(*frame)
    )
    return chips.join(complete, list(frame), "left_semi")


def full_frame_sets(chips: DataFrame, frame: str = "frame_id") -> DataFrame:
    """The same by intersecting the frame sets of the chips."""
    out = None
    for c in CHIPS:
        one = chips.where(F.col("chip") == c).select(frame)
        out = one.distinct() if out is None else out.intersect(one)
    return out


def stack_summary(chips: DataFrame, group: Sequence[str] = ("site", "field", "band"), order: str = "frame_id") -> DataFrame:
    """One row per stack: dithers, total exposure, mean date, seeing, saturation and what its frames are.

    ``chips`` has one row per frame and chip with ``date_obs, exptime, fwhm, saturate, site``.
    The exposure time is that of the first frame by name times the dithers. ``images`` lists the frames by name with
    their dates and observatories, as long as the dithers.
    """
    first_chip = F.col("chip") == CHIPS[0]
    mjd = to_mjd("date_obs")
    image = F.struct(F.col(order).alias("name"), F.col("date_obs").alias("date"), F.col("site").alias("observatory"))
    return chips.groupBy(*group).agg(
        F.count_if(first_chip).alias("dither"),
        (F.min_by("exptime", order) * F.count_if(first_chip)).alias("exptime"),
        F.avg(F.when(first_chip, mjd)).alias("mean_mjd"),
        F.bround(F.avg("fwhm"), 2).alias("fwhm"),
        F.bround(F.avg("saturate"), 0).alias("saturate"),
        F.bround(F.min("saturate"), 0).alias("undersat"),
        F.array_sort(F.collect_list(F.when(first_chip, image))).alias("images"),
    ).withColumn("mean_date", from_mjd("mean_mjd"))


def frame_numbers(chips: DataFrame, group: Sequence[str], order: str = "frame_id") -> DataFrame:
    """Frames of a stack numbered by name; the header digit is the last hex digit."""
    one = chips.where(F.col("chip") == CHIPS[0])
    n = F.row_number().over(Window.partitionBy(*group).orderBy(order)) - 1
    return one.withColumn("frame_number", n).withColumn(
        "digit", F.lower(F.substring(F.hex(F.col("frame_number").cast("long")), -1, 1))
    )


def longest(products: DataFrame, keys: Sequence[str], path: str = "path", exptime: str = "exptime") -> DataFrame:
    """Longest exposure per key; equal exposures resolve to the first name."""
    return products.groupBy(*keys).agg(
        F.min_by(path, F.struct((-F.col(exptime)).alias("e"), F.col(path).alias("p"))).alias(path)
    )


def latest_reference(wanted: DataFrame, primary: DataFrame, secondary: DataFrame, keys: Sequence[str] = ("field", "band")) -> DataFrame:
    """Reference image per field and band: longest of the primary set, else of the secondary."""
    keys = list(keys)
    a = longest(primary, keys).withColumnRenamed("path", "_a")
    b = longest(secondary, keys).withColumnRenamed("path", "_b")
    return (
        wanted.join(a, keys, "left").join(b, keys, "left")
        .withColumn("reference", F.coalesce("_a", "_b")).drop("_a", "_b")
    )


def list_products(files: DataFrame, pattern: str, exclude: str = "mask|crmap", path: str = "path") -> DataFrame:
    """Listing filter: name pattern, without masks."""
    name = F.element_at(F.split(path, "/"), -1)
    return files.withColumn("name", name).where(F.col("name").rlike(pattern) & ~F.col("name").rlike(exclude))


def coadd(
    pixels: DataFrame, wcs: DataFrame, keys: Sequence[str], stack: Sequence[str], center_ra: Column, center_dec: Column,
    scale_deg: float = 0.4 / 3600, value: str = "value",
) -> DataFrame:
    """Average of dithered frames in nearest cells of one plain gnomonic grid per stack.

    ``wcs`` has ``keys, stack.., wcs`` (one row per frame and chip). Output:
    ``stack.., x, y, value, n``.
    """
    placed = to_world(pixels.join(wcs, list(keys)), "x", "y", "wcs", "_ra", "_dec")
    placed = placed.withColumn("_grid", tan_struct(center_ra, center_dec, scale_deg))
    placed = to_pixel(placed, "_ra", "_dec", "_grid", "_gx", "_gy")
    return placed.groupBy(
        *stack, F.floor(F.col("_gx") + 0.5).cast("int").alias("x"), F.floor(F.col("_gy") + 0.5).cast("int").alias("y")
    ).agg(F.avg(value).alias("value"), F.count("*").alias("n"))
