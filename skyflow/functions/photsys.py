"""Photometric systems and small magnitude helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The zero point all frames are scaled to, the "no value" magnitude.
SCALED_ZERO_POINT = 30.0
NO_MAG = 99.0


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rss(*cols: Column | str) -> Column:
    """Root of the sum of squares."""
    total = F.lit(0.0)
    for c in cols:
        total = total + _col(c) * _col(c)
    return F.sqrt(total)


def flux_ratio(delta_zp: Column | str) -> Column:
    return F.bround(F.pow(F.lit(10.0), _col(delta_zp) / 2.5), 4)


# Fixed values in the functions below: the published colour terms between the photometric systems.


def vega_to_ab(df: DataFrame) -> DataFrame:
    """Survey magnitudes ``bmag vmag gmag rmag_ab imag_ab`` style columns to the AB set.

    Input columns: ``b_v, bmag_vega, vmag_vega, r_mag, i_mag`` with ``e_`` errors.
    """
    b_v, r, i = F.col("b_v"), F.col("r_mag"), F.col("i_mag")
    return df.withColumns(
        {
            "b_v_ab": b_v + (-0.09 - 0.02),
            "bmag": F.col("bmag_vega") - 0.09 - 0.27 * (b_v - (0.09 + 0.02)),
            "vmag": F.col("vmag_vega") + 0.02,
            "rmag": r - 0.0576 - 0.3718 * (r - i - 0.2589),
            "imag": i,
        }
    )


def xp_to_landolt(df: DataFrame) -> DataFrame:
    """Synthetic ``xp_b, xp_v, xp_r, xp_i`` (+ ``xp_e*``) to the standard band names."""
    b, v, r = F.col("xp_b"), F.col("xp_v"), F.col("xp_r")
    return (
        df.withColumns({"bmag": b - 0.30 * (b - v), "rmag": r - 0.04 * (v - r)})
        .withColumnsRenamed(
            {
                "ra": "raj2000",
                "dec": "dej2000",
                "xp_v": "vmag",
                "xp_i": "imag",
                "xp_eb": "e_bmag",
                "xp_ev": "e_vmag",
                "xp_er": "e_rmag",
                "xp_ei": "e_imag",
            }
        )
    )


def limit_mag(n_sigma: Column | float, zp: Column | str, aperture: Column | float, sky_sigma: Column | str) -> Column:
    """Depth reached at ``n_sigma`` in an aperture of the given diameter (px)."""
    n = n_sigma if isinstance(n_sigma, Column) else F.lit(float(n_sigma))
    d = aperture if isinstance(aperture, Column) else F.lit(float(aperture))
    noise = n * _col(sky_sigma) * F.sqrt(F.lit(3.141592653589793) * (d / 2) * (d / 2))
    return F.bround(_col(zp) - 2.5 * F.log10(noise), 3)
