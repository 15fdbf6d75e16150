"""Structured file names, observatories, bands and per-chip constants."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

# --- fixed values: name layouts, sites, bands and detector constants ---------
RAW_NAME = r"kmt[asc]\.\d{8}\.\d{6}\.fits"
RAW_PARTS = r"(?P<site>kmt[asc])\.(?P<date>\d{8})\.(?P<serial>\d{6})\.fits"
CHIP_NAME = r"a?(?P<serial>\d{6})\.(?P<chip>kk|mm|tt|nn)\.fits"
SCALED_NAME = (
    r"(?P<field>.*?_\d{4})\.(?P<radec>\d{3}-\d{2})\.(?P<band>[BVRI])\.(?P<date>\d{8})\."
    r"(?P<site>\w+)\.(?P<serial>\d{6})\.(?P<chip>\w+)\.(?P<type>scaled|mask|crmap)\.fits"
)
STACK_NAME = (
    r"(?P<field>.*?_\d{4})\.(?P<radec>\d{3}-\d{2})\.(?P<band>[BVRI])\.(?P<date>\d{8})\."
    r"(?P<site>\w+)\.(?P<exptime>\d+sec)\.(?P<type>scaled)\.stack\.fits"
)
STACK_CATALOG_NAME = STACK_NAME + r"\.cat"
CONVENTIONS = {
    "raw": RAW_PARTS,
    "chip": CHIP_NAME,
    "scaled": SCALED_NAME,
    "stack": STACK_NAME,
    "stack_catalog": STACK_CATALOG_NAME,
}
BANDS = ["B", "V", "R", "I"]
CHIPS = ["kk", "mm", "tt", "nn"]
SITE_OF_PREFIX = {"kmts": "SAAO", "kmtc": "CTIO", "kmta": "SSO"}
EXPECTED_BYTES = {"SAAO": 1361664000, "CTIO": 1361583360, "SSO": 1361583360}
OBSERVATORY_CODE = {"CTIO": "807", "SSO": "Q60", "SAAO": "M22"}
DEFAULT_OBSERVATORY = 500
NAXIS1, NAXIS2, AMPS = 9216, 9232, 8
PIXEL_SCALE = 0.4
INITIAL_WCS = {"crpix1": 4600.0, "crpix2": 4600.0, "cd1_1": -0.00011, "cd2_2": 0.00011}
# chip -> (RA hours, Dec degrees) added to the pointing
CHIP_OFFSETS = {"mm": (0.03333, 0.5), "kk": (-0.03333, 0.5), "nn": (0.03333, -0.5), "tt": (-0.03333, -0.5)}
DEFAULT_SEEING = 2.0
# -----------------------------------------------------------------------------

_GROUP = re.compile(r"\(\?P<(\w+)>")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lookup(key: Column, table: dict, default: Column | None = None) -> Column:
    """Small fixed dictionary as a CASE expression (no join, no UDF)."""
    out = None
    for k, v in table.items():
        out = F.when(key == k, F.lit(v)) if out is None else out.when(key == k, F.lit(v))
    return out if default is None else out.otherwise(default)


def java_pattern(convention: str) -> tuple[str, list[str]]:
    """Anchored pattern with plain groups, and the group names in order."""
    pattern = CONVENTIONS.get(convention, convention)
    return "^" + _GROUP.sub("(", pattern), _GROUP.findall(pattern)


def parse_name(df: DataFrame, convention: str, column: str = "name") -> DataFrame:
    """Typed columns from a file name; rows that do not follow the layout are dropped."""
    pattern, groups = java_pattern(convention)
    pattern += "$"
    parsed = df.where(F.col(column).rlike(pattern)).withColumns(
        {g: F.regexp_extract(column, pattern, i + 1) for i, g in enumerate(groups)}
    )
    if "exptime" in groups:
        parsed = parsed.withColumn("exptime", F.regexp_extract("exptime", r"\d+", 0).cast("int"))
    return parsed


def observatory_of(name: Column | str, codes: dict | None = None) -> Column:
    """Code of the first site whose token occurs in the name, else the geocentre."""
    n, out = _col(name), None
    for token, code in (codes or OBSERVATORY_CODE).items():
        hit = n.contains(token)
        out = F.when(hit, F.lit(str(code))) if out is None else out.when(hit, F.lit(str(code)))
    return out.otherwise(F.lit(str(DEFAULT_OBSERVATORY)))


def site_of_prefix(prefix: Column | str) -> Column:
    """Site of a raw-name prefix; unknown prefixes count as SSO."""
    return lookup(_col(prefix), SITE_OF_PREFIX, F.lit("SSO"))


def serial_of(name: Column | str) -> Column:
    return F.substring(_col(name), 15, 6)


def site_letter_of(name: Column | str) -> Column:
    return F.substring(_col(name), 4, 1)


def band_order(band: Column | str) -> Column:
    return F.array_position(F.array(*[F.lit(b) for b in BANDS]), _col(band))


def phot_reference(band: Column | str) -> Column:
    return F.when(_col(band) == "I", F.lit("SMSS DR3")).otherwise(F.lit("APASS DR9"))


def seeing_or_default(seeing: Column | str) -> Column:
    return F.coalesce(_col(seeing), F.lit(DEFAULT_SEEING))


def zero_point_or_default(zp: Column | str) -> Column:
    return F.coalesce(_col(zp), F.lit(30.0))


def chip_pointing(ra_deg: Column | str, dec_deg: Column | str, chip: Column | str) -> Column:
    """Struct of the chip's approximate centre (RA in hours as in its header) and first-guess WCS."""
    c = _col(chip)
    d_ra = lookup(c, {k: v[0] for k, v in CHIP_OFFSETS.items()})
    d_dec = lookup(c, {k: v[1] for k, v in CHIP_OFFSETS.items()})
    return F.struct(
        (_col(ra_deg) / 15.0 + d_ra).alias("chip_ra_hour"),
        (_col(dec_deg) + d_dec).alias("chip_dec"),
        *[F.lit(v).alias(k) for k, v in INITIAL_WCS.items()],
        _col(ra_deg).alias("crval1"),
        _col(dec_deg).alias("crval2"),
    )


def compact_date(text: Column | str) -> Column:
    """``2024-04-23T01:02:03`` -> ``20240423-010203``."""
    t = _col(text)
    return F.regexp_replace(F.regexp_replace(t, "[-:]", ""), "T", "-")


def rename_convention(
    prefix: str, site: Column | str, obj: Column | str, date_obs: Column | str, date: Column | str,
    band: Column | str, exptime: Column | str, facility: str,
) -> Column:
    """``{prefix}.{facility}_{site}.{object}.{date}.{filter}.{exptime}.stack.fits``."""
    seconds = _col(exptime).cast("double")
    number = F.when(seconds == F.floor(seconds), seconds.cast("long").cast("string")).otherwise(seconds.cast("string"))
    return F.concat_ws(
        ".",
        F.lit(prefix),
        F.concat(F.lit(facility + "_"), _col(site)),
        _col(obj),
        compact_date(F.coalesce(_col(date_obs), _col(date))),
        _col(band),
        number,
        F.lit("stack"),
        F.lit("fits"),
    )


def scaled_name(obj, field, radec, band, date_obs, site, serial, chip) -> Column:
    day = F.regexp_replace(F.element_at(F.split(_col(date_obs), "T"), 1), "-", "")
    return F.concat_ws(
        ".",
        F.concat(F.element_at(F.split(_col(obj), "_"), 1), F.lit("_"), _col(field)),
        _col(radec), _col(band), day, _col(site), _col(serial), _col(chip), F.lit("scaled"), F.lit("fits"),
    )


def stack_name(field, radec, band, date, site, exptime, kind: str = "scaled", prefix: str = "ToO") -> Column:
    """Stack, weight or mask-stack name: ``kind`` is ``scaled``, ``crmap`` or ``mask``."""
    return F.concat_ws(
        ".",
        F.concat(F.lit(prefix + "_"), _col(field)), _col(radec), _col(band), _col(date), _col(site),
        F.concat(F.bround(_col(exptime).cast("double"), 0).cast("long").cast("string"), F.lit("sec")),
        F.lit(kind), F.lit("stack"), F.lit("fits"),
    )


def stamp_name(base: Column | str, number: Column | str, kind: Column | str) -> Column:
    """``{image}.{candidate number, six digits}.{new|ref|sub}.fits``."""
    return F.concat_ws(
        ".",
        F.regexp_replace(_col(base), r"\.fits$", ""),
        F.lpad(_col(number).cast("string"), 6, "0"),
        _col(kind),
        F.lit("fits"),
    )
