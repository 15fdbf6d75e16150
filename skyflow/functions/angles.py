"""Angles on the sky: sexagesimal text, unit vectors and separations."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ARCSEC_PER_RADIAN = 206264.80624709636
# Separations are rounded to this many decimals (arcsec), so that two reference
# stars at mirrored offsets tie exactly and the smaller id wins.
SEP_DECIMALS = 6
# A radius is tested on separations of this many decimals: finer than any catalogue, coarser than a double's noise.
SEP_EXACT = 9


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dms_to_deg(text: Column | str) -> Column:
    """``[+-]dd:mm:ss.s`` to degrees; the sign also holds for ``-00:..``."""
    t = F.trim(_col(text))
    part = F.split(F.regexp_replace(t, "^[+-]", ""), "[:\\s]+")

    def num(i: int) -> Column:
        return F.coalesce(F.try_element_at(part, F.lit(i)).try_cast("double"), F.lit(0.0))

    first = F.try_element_at(part, F.lit(1)).try_cast("double")
    sign = F.when(t.startswith("-"), F.lit(-1.0)).otherwise(F.lit(1.0))
    return sign * (first + num(2) / 60.0 + num(3) / 3600.0)


def hms_to_deg(text: Column | str) -> Column:
    return dms_to_deg(text) * 15.0


def _sexagesimal(value: Column, decimals: int, turn: int = 360) -> Column:
    scale = 10**decimals
    # rounding up at the end of a turn wraps to zero
    ticks = F.pmod(F.bround(value * 3600.0 * scale, 0).cast("long"), F.lit(turn * 3600 * scale).cast("long"))
    whole = F.floor(ticks / scale)
    return F.format_string(
        f"%02d:%02d:%02d.%0{decimals}d",
        F.floor(whole / 3600),
        F.floor(F.pmod(whole, F.lit(3600)) / 60),
        F.pmod(whole, F.lit(60)),
        F.pmod(ticks, F.lit(scale)),
    )


def deg_to_hms(deg: Column | str, decimals: int = 4) -> Column:
    return _sexagesimal(F.pmod(_col(deg), F.lit(360.0)) / 15.0, decimals, 24)


def deg_to_dms(deg: Column | str, decimals: int = 3) -> Column:
    d = _col(deg)
    return F.concat(F.when(d < 0, F.lit("-")).otherwise(F.lit("+")), _sexagesimal(F.abs(d), decimals))


def sky_sep(ra1: Column | str, dec1: Column | str, ra2: Column | str, dec2: Column | str) -> Column:
    """Great-circle separation in degrees (haversine, all inputs in degrees)."""
    a1, d1, a2, d2 = (_col(c) for c in (ra1, dec1, ra2, dec2))
    s_dec = F.sin(F.radians(d2 - d1) / 2)
    s_ra = F.sin(F.radians(a2 - a1) / 2)
    h = s_dec * s_dec + F.cos(F.radians(d1)) * F.cos(F.radians(d2)) * s_ra * s_ra
    return F.degrees(2 * F.asin(F.least(F.lit(1.0), F.sqrt(h))))


def unit_vector(ra: Column | str, dec: Column | str) -> tuple[Column, Column, Column]:
    a, d = F.radians(_col(ra)), F.radians(_col(dec))
    return F.cos(d) * F.cos(a), F.cos(d) * F.sin(a), F.sin(d)


def chord_angle(ax: Column, ay: Column, az: Column, bx: Column, by: Column, bz: Column) -> Column:
    """Angle (radians) between unit vectors; exact for small separations."""
    dx, dy, dz = ax - bx, ay - by, az - bz
    return 2 * F.asin(F.least(F.lit(1.0), F.sqrt(dx * dx + dy * dy + dz * dz) / 2))
