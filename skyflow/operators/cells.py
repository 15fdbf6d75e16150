"""Equal-area-ish sky cells: the equi-join key behind every positional join.

A zone is a declination band of height ``h``; within it right ascension is cut
into ``n(zone)`` cells about ``h`` wide on the sky, so that a cap at the pole is
one cell. One side keeps a row in its own cell, the other side is copied into
every cell that a disc of the search radius can reach.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

MIN_CELL_DEG = 0.5 / 3600
# Padding against rounding at cell borders (degrees).
EDGE = 1e-9


def zone_of(dec: Column, h: float) -> Column:
    return F.floor((dec + 90.0) / h)


def cells_in_zone(zone: Column, h: float) -> Column:
    middle = F.radians((zone + 0.5) * h - 90.0)
    return F.greatest(F.lit(1), F.floor(F.lit(360.0 / h) * F.cos(middle)))


def pack(zone: Column, index: Column) -> Column:
    return F.shiftleft(zone.cast("long"), 32) + index.cast("long")


def own_cell(ra: Column, dec: Column, h: float) -> Column:
    n = cells_in_zone(zone_of(dec, h), h)
    return pack(zone_of(dec, h), F.least(n - 1, F.floor(F.pmod(ra, F.lit(360.0)) * n / 360.0)))


def cell_height(radius_deg: float | Column, factor: float = 4.0) -> float | Column:
    if isinstance(radius_deg, Column):
        return F.greatest(radius_deg * factor, F.lit(MIN_CELL_DEG))
    return max(radius_deg * factor, MIN_CELL_DEG)


def sky_cells(
    df: DataFrame, ra: str, dec: str, radius_deg: float | Column, *, copies: bool, h: float | Column | None = None, out: str = "cell"
) -> DataFrame:
    """Add the cell key; with ``copies`` one row per cell the disc reaches. Radius and height may be columns."""
    h = cell_height(radius_deg) if h is None else h
    if not copies:
        return df.withColumn(out, own_cell(F.col(ra), F.col(dec), h))
    r = radius_deg + EDGE
    top = F.least(F.lit(90.0), F.abs(F.col(dec)) + r)
    chord = F.sin(F.radians(F.least(r, F.lit(180.0)) / 2)) if isinstance(r, Column) else F.lit(math.sin(math.radians(min(r, 180.0) / 2)))
    reach = chord / F.greatest(F.cos(F.radians(top)), F.lit(1e-12))
    half = F.when(
        (F.lit(r) >= 90.0) | (reach >= 1.0), F.lit(180.0)
    ).otherwise(F.degrees(2 * F.asin(F.least(reach, F.lit(1.0)))) + EDGE)
    last = F.floor(180.0 / h) if isinstance(h, Column) else math.floor(180.0 / h)
    zones = F.sequence(
        F.greatest(F.lit(0), zone_of(F.col(dec) - r, h)), F.least(F.lit(last), zone_of(F.col(dec) + r, h))
    )
    ra360 = F.pmod(F.col(ra), F.lit(360.0))
    by_zone = df.withColumns({"_half": half, "_zone": F.explode(zones)})
    n = cells_in_zone(F.col("_zone"), h)
    by_zone = by_zone.withColumn("_n", n)
    n = F.col("_n")
    span = F.sequence(
        F.floor((ra360 - F.col("_half")) * n / 360.0), F.floor((ra360 + F.col("_half")) * n / 360.0)
    )
    wrapped = F.array_distinct(F.transform(span, lambda i: F.pmod(i, n)))
    return (
        by_zone.withColumn("_ix", F.explode(wrapped))
        .withColumn(out, pack(F.col("_zone"), F.col("_ix")))
        .drop("_half", "_zone", "_n", "_ix")
    )


def _in_ra_span(ra: Column, ra0: float, half: float) -> Column:
    """Plain range predicates (pushed down to the scan), split at the 0/360 wrap."""
    if half >= 180.0:
        return F.lit(True)
    lo, hi = (ra0 - half) % 360.0, (ra0 + half) % 360.0
    inside = (ra >= lo) & (ra <= hi)
    return inside if lo <= hi else (ra >= lo) | (ra <= hi)


def cone_search(df: DataFrame, ra0: float, dec0: float, radius_deg: float, ra: str = "ra", dec: str = "dec") -> DataFrame:
    """Rows closer than ``radius_deg`` to a centre: box prefilter, then the exact distance."""
    from skyflow.functions.angles import sky_sep

    top = min(90.0, abs(dec0) + radius_deg)
    reach = math.sin(math.radians(min(radius_deg, 180.0)) / 2) / max(math.cos(math.radians(top)), 1e-12)
    half = 180.0 if reach >= 1.0 or radius_deg >= 90 else math.degrees(2 * math.asin(reach)) + EDGE
    return (
        df.where(F.col(dec).between(dec0 - radius_deg - EDGE, dec0 + radius_deg + EDGE))
        .where(_in_ra_span(F.col(ra), ra0, half))
        .where(sky_sep(F.lit(ra0), F.lit(dec0), ra, dec) < radius_deg)
    )


def box_search(df: DataFrame, ra0: float, dec0: float, width_deg: float, ra: str = "ra", dec: str = "dec") -> DataFrame:
    """Square field of the given full width, RA side measured along the centre's parallel."""
    half = width_deg / 2
    cos0 = math.cos(math.radians(dec0))
    ra_half = 180.0 if cos0 < 1e-9 else min(180.0, half / cos0)
    return df.where(F.col(dec).between(dec0 - half, dec0 + half)).where(_in_ra_span(F.col(ra), ra0, ra_half))
