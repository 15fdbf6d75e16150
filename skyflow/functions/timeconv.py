"""UTC timestamps and Modified Julian Dates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MJD_OF_EPOCH = 40587  # 1970-01-01


def to_mjd(ts: Column | str) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(c.cast("timestamp")) / F.lit(86400e6) + F.lit(float(MJD_OF_EPOCH))


def mjd_to_timestamp(mjd: Column | str) -> Column:
    """Nearest millisecond, so float noise does not fall to the previous second."""
    c = F.col(mjd) if isinstance(mjd, str) else mjd
    return F.timestamp_millis(F.bround((c - MJD_OF_EPOCH) * F.lit(86400e3), 0).cast("long"))


def from_mjd(mjd: Column | str) -> Column:
    """ISO text with the seconds truncated."""
    return F.date_format(mjd_to_timestamp(mjd), "yyyy-MM-dd'T'HH:mm:ss")
