"""Pixel <-> sky with a CD matrix, the TPV polynomial and the gnomonic projection.

The solution comes as a struct column with ``crpix1 crpix2 crval1 crval2 cd1_1
cd1_2 cd2_1 cd2_2`` and the coefficient arrays ``pv1``/``pv2`` (12 terms).
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

INVERSE_STEPS = 5
PV_TERMS = 12


def tpv(pv: Column, u: Column, v: Column) -> Column:
    """Third-order TPV polynomial; axis 2 calls it with ``(pv2, v, u)``."""
    r = F.sqrt(u * u + v * v)
    basis = [F.lit(1.0), u, v, r, u * u, u * v, v * v, u * u * u, u * u * v, u * v * v, v * v * v, r * r * r]
    terms = [F.coalesce(F.get(pv, F.lit(i)), F.lit(0.0)) * b for i, b in enumerate(basis)]
    return reduce(lambda a, b: a + b, terms)


def to_world(df: DataFrame, x: str, y: str, wcs: str = "wcs", ra: str = "ra", dec: str = "dec") -> DataFrame:
    """Add sky coordinates (degrees) of the pixel columns ``x, y``."""
    w = F.col(wcs)
    dx, dy = F.col(x) - w["crpix1"], F.col(y) - w["crpix2"]
    # One projection per step keeps each intermediate value computed once.
    step1 = df.withColumns(
        {"_u": w["cd1_1"] * dx + w["cd1_2"] * dy, "_v": w["cd2_1"] * dx + w["cd2_2"] * dy}
    )
    u, v = F.col("_u"), F.col("_v")
    step2 = step1.withColumns(
        {"_xi": F.radians(tpv(w["pv1"], u, v)), "_eta": F.radians(tpv(w["pv2"], v, u))}
    )
    d0 = F.radians(w["crval2"])
    depth = F.cos(d0) - F.col("_eta") * F.sin(d0)
    return step2.withColumns(
        {
            ra: F.pmod(w["crval1"] + F.degrees(F.atan2(F.col("_xi"), depth)), F.lit(360.0)),
            dec: F.degrees(
                F.atan2(
                    F.sin(d0) + F.col("_eta") * F.cos(d0),
                    F.sqrt(F.col("_xi") * F.col("_xi") + depth * depth),
                )
            ),
        }
    ).drop("_u", "_v", "_xi", "_eta")


def to_pixel(df: DataFrame, ra: str, dec: str, wcs: str = "wcs", x: str = "x", y: str = "y") -> DataFrame:
    """Add pixel coordinates; the polynomial is inverted by fixed-point steps.

    Points on or behind the plane through the sphere's centre have no place on the tangent plane: null.
    """
    w = F.col(wcs)
    d, d0 = F.radians(F.col(dec)), F.radians(w["crval2"])
    da = F.radians(F.col(ra) - w["crval1"])
    cosc = F.sin(d) * F.sin(d0) + F.cos(d) * F.cos(d0) * F.cos(da)
    cosc = F.when(cosc > 0, cosc)
    out = df.withColumns(
        {
            "_xi": F.degrees(F.cos(d) * F.sin(da) / cosc),
            "_eta": F.degrees((F.sin(d) * F.cos(d0) - F.cos(d) * F.sin(d0) * F.cos(da)) / cosc),
        }
    )
    out = out.withColumns({"_u": F.col("_xi"), "_v": F.col("_eta")})
    for _ in range(INVERSE_STEPS):
        u, v = F.col("_u"), F.col("_v")
        out = out.withColumns(
            {
                "_u": u + (F.col("_xi") - tpv(w["pv1"], u, v)),
                "_v": v + (F.col("_eta") - tpv(w["pv2"], v, u)),
            }
        )
    det = w["cd1_1"] * w["cd2_2"] - w["cd1_2"] * w["cd2_1"]
    place = F.struct(
        (w["crpix1"] + (w["cd2_2"] * F.col("_u") - w["cd1_2"] * F.col("_v")) / det).alias("x"),
        (w["crpix2"] + (w["cd1_1"] * F.col("_v") - w["cd2_1"] * F.col("_u")) / det).alias("y"),
    )
    # a generator is not inlined: a later filter on the pixel would otherwise repeat every step in each use of the one before
    out = out.withColumn("_place", F.explode(F.array(place)))
    return out.withColumns({x: F.col("_place.x"), y: F.col("_place.y")}).drop("_u", "_v", "_xi", "_eta", "_place")


def tan_world(df: DataFrame, x: str, y: str, ra0: Column, dec0: Column, scale: float, ra: str, dec: str) -> DataFrame:
    """Plain gnomonic grid around a centre (``scale`` in degrees per pixel, RA to the left)."""
    return to_world(df.withColumn("_tan", tan_struct(ra0, dec0, scale)), x, y, "_tan", ra, dec).drop("_tan")


def tan_struct(ra0: Column, dec0: Column, scale: float, crpix: float = 0.0) -> Column:
    """A distortion-free solution struct, usable wherever ``wcs`` is expected."""
    identity = F.array(F.lit(0.0), F.lit(1.0))
    return F.struct(
        F.lit(crpix).alias("crpix1"),
        F.lit(crpix).alias("crpix2"),
        ra0.cast("double").alias("crval1"),
        dec0.cast("double").alias("crval2"),
        F.lit(-scale).alias("cd1_1"),
        F.lit(0.0).alias("cd1_2"),
        F.lit(0.0).alias("cd2_1"),
        F.lit(scale).alias("cd2_2"),
        identity.alias("pv1"),
        identity.alias("pv2"),
    )


def tan_cells(solution: np.ndarray, x: np.ndarray, y: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Nearest cells of a plain gnomonic grid (as ``tan_struct`` with crpix 0) for many pixels of one image.

    ``solution`` holds crpix, crval, the CD matrix by rows, both coefficient arrays and the centre of the grid. Pixels on
    or behind the plane through the sphere's centre are NaN.
    """
    x0, y0, ra, dec, a, b, c, d = solution[:8]
    pv1, pv2 = solution[8 : 8 + PV_TERMS], solution[8 + PV_TERMS : 8 + 2 * PV_TERMS]
    center_ra, center_dec = solution[-2:]

    def distorted(pv: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        r = np.sqrt(u * u + v * v)
        terms = (1.0, u, v, r, u * u, u * v, v * v, u * u * u, u * u * v, u * v * v, v * v * v, r * r * r)
        return sum((k * t for k, t in zip(pv, terms) if k), np.zeros_like(u))

    u, v = a * (x - x0) + b * (y - y0), c * (x - x0) + d * (y - y0)
    xi, eta = np.radians(distorted(pv1, u, v)), np.radians(distorted(pv2, v, u))
    near, grid = np.radians(dec), np.radians(center_dec)
    depth = np.cos(near) - eta * np.sin(near)
    away = np.radians(ra - center_ra) + np.arctan2(xi, depth)
    high = np.arctan2(np.sin(near) + eta * np.cos(near), np.hypot(xi, depth))
    cosc = np.sin(high) * np.sin(grid) + np.cos(high) * np.cos(grid) * np.cos(away)
    cosc = np.where(cosc > 0, cosc, np.nan)
    px = -np.degrees(np.cos(high) * np.sin(away) / cosc) / scale
    py = np.degrees((np.sin(high) * np.cos(grid) - np.cos(high) * np.sin(grid) * np.cos(away)) / cosc) / scale
    return np.floor(px + 0.5), np.floor(py + 0.5)
