"""SQL names for the scalar functions: expression macros, no Python per row."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFINITIONS = [
    """create or replace temporary function sky_sep(ra1 double, dec1 double, ra2 double, dec2 double)
       returns double return degrees(2 * asin(least(1e0, sqrt(
         power(sin(radians(dec2 - dec1) / 2), 2)
         + cos(radians(dec1)) * cos(radians(dec2)) * power(sin(radians(ra2 - ra1) / 2), 2)))))""",
    """create or replace temporary function dms_to_deg(t string) returns double return
         case when trim(t) like '-%' then -1e0 else 1e0 end * (
           try_cast(try_element_at(split(regexp_replace(trim(t), '^[+-]', ''), '[: ]+'), 1) as double)
           + coalesce(try_cast(try_element_at(split(regexp_replace(trim(t), '^[+-]', ''), '[: ]+'), 2) as double), 0e0) / 60
           + coalesce(try_cast(try_element_at(split(regexp_replace(trim(t), '^[+-]', ''), '[: ]+'), 3) as double), 0e0) / 3600)""",
    "create or replace temporary function hms_to_deg(t string) returns double return 15e0 * dms_to_deg(t)",
    """create or replace temporary function to_mjd(ts timestamp) returns double
       return unix_micros(ts) / 86400e6 + 40587e0""",
    """create or replace temporary function flux_ratio(dzp double) returns double
       return bround(power(10e0, dzp / 2.5e0), 4)""",
]


def register(spark: SparkSession) -> None:
    for statement in DEFINITIONS:
        spark.sql(statement)
