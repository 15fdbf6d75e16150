"""Sky-survey shaped views of the given tables, once for Spark and once for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyflow.session import spread

SOURCES = """
select l_orderkey, l_linenumber, l_partkey, l_suppkey,
 ((l_orderkey*8+l_linenumber)*1000+l_suppkey)*20000+l_partkey as number,
 case l_orderkey%4 when 0 then 'kk' when 1 then 'mm' when 2 then 'tt' else 'nn' end as chip,
 cast((l_partkey*37+l_orderkey*11)%9216 as double)+0.5e0 as x_image,
 cast((l_partkey*53+l_orderkey*29+l_suppkey*17)%9232 as double)+0.5e0 as y_image,
 121.0e0+(cast((l_partkey*37+l_orderkey*11)%9216 as double)+0.5e0)*0.4e0/3600 as alpha_j2000,
 -30.0e0+(cast((l_partkey*53+l_orderkey*29+l_suppkey*17)%9232 as double)+0.5e0)*0.4e0/3600 as delta_j2000,
 -16.0e0+l_extendedprice/40000 as mag_auto, 0.001e0+l_tax as magerr_auto,
 cast(l_orderkey%5 as int) as flags, l_discount*10 as class_star,
 3.0e0+l_quantity/10 as fwhm_image, 1.0e0+l_discount*3 as elongation,
 -90.0e0+cast((l_suppkey*7+l_partkey)%181 as double) as theta_image
from lineitem
"""

REFCAT = """
select number as ref_id, chip,
 alpha_j2000+((l_suppkey%5)-2)*0.3e0/3600 as raj2000, delta_j2000+((l_suppkey%3)-1)*0.3e0/3600 as dej2000,
 mag_auto+29.5e0+((l_suppkey%7)-3)*0.02e0+y_image*1e-5 as rmag, 0.01e0+(l_suppkey%10)*0.01e0 as e_rmag
from sources
"""

EXPOSURES = """
select o_orderkey as frame_id,
 case o_custkey%3 when 0 then 'SAAO' when 1 then 'CTIO' else 'SSO' end as site,
 case o_orderkey%4 when 0 then 'B' when 1 then 'V' when 2 then 'R' else 'I' end as band,
 lpad(cast(o_custkey%40 as {string}),4,'0') as field,
 o_orderdate as date_obs, 60.0e0+60*(o_orderkey%3) as exptime,
 1.0e0+o_totalprice/100000 as fwhm, o_orderstatus<>'P' as qaresult,
 case when o_orderkey%11=0 then '00000010' when o_orderkey%13=0 then '00000001' else '00000000' end as badamp,
 120.0e0+(o_custkey%40)*0.7e0+((o_orderkey%9)-4)*0.05e0 as ra, -30.0e0+((o_orderkey%7)-3)*0.2e0 as dec,
 60000.0e0+(o_orderkey%17)*10 as saturate, lpad(cast(o_orderkey%1000000 as {string}),6,'0') as serial
from orders
"""

# one row per frame and chip
CHIPS = "select e.*, {chip} as chip from exposures e {explode}"

TILES = "select i as field, 120.0e0+i*0.7e0 as ra, -30.0e0 as dec, lpad(cast(120+i as {string}),3,'0') || '-30' as radec from {range}"

# detector rows: 8 amplifiers of 8 columns, four or more frames
PIXELS_DUCK = """
select vec_id//125 as frame_id, cast(vec_id%125 as int) as y, cast(i-1 as int) as x, cast((i-1)//8 as int) as amp,
 cast(embedding[i] as double)*1000+200 as value
from embeddings, range(1,65) t(i)
"""
PIXELS_SPARK = """
select vec_id div 125 as frame_id, cast(vec_id%125 as int) as y, x, cast(x div 8 as int) as amp,
 cast(v as double)*1000+200 as value
from embeddings lateral view posexplode(embedding) t as x, v
"""
STRIPS_SPARK = """
select vec_id div 125 as frame_id, cast(vec_id%125 as int) as y, amp,
 transform(slice(embedding, amp*8+1, 8), v -> cast(v as double)*1000+200) as values
from embeddings lateral view explode(sequence(0,7)) t as amp
"""

UPLOADS = """
select event_id, ts, 'watch' as watch_dir,
 'kmt'||substr('sca',cast(user_id%3+1 as int),1) as prefix, {day} as date,
 case user_id%3 when 0 then 'SAAO' when 1 then 'CTIO' else 'SSO' end as site,
 'kmt'||substr('sca',cast(user_id%3+1 as int),1)||'.'||{day}||'.'||lpad(cast(event_id%1000000 as {string}),6,'0')||'.fits' as name,
 case when event_type='error' then 1000 else 1361664000 end as size
from events
"""

CANDIDATES = """
select s.*, 1-1/elongation as ellipticity, case when l_suppkey%20=19 then 1 else 0 end as imaflags_iso,
 cast(l_linenumber*7+l_suppkey%13 as double)*4 as background, fwhm_image*0.4e0/3600 as fwhm_world,
 30.0e0 as magzero
from sources s
"""

# catalogues of the inverted images: other tables, so they are naturally sparser than the candidates
INVERSE = """
select p_partkey as inv_id, case p_partkey%4 when 0 then 'kk' when 1 then 'mm' when 2 then 'tt' else 'nn' end as chip,
 121.0e0+(cast((p_partkey*131+p_size*977)%9216 as double)+0.25e0)*0.4e0/3600 as alpha_j2000,
 -30.0e0+(cast((p_partkey*197+p_size*613)%9232 as double)+0.25e0)*0.4e0/3600 as delta_j2000,
 -16.0e0+p_retailprice/800 as mag_auto
from part
"""
INVERSE_REF = """
select c_custkey as inv_id, case c_custkey%4 when 0 then 'kk' when 1 then 'mm' when 2 then 'tt' else 'nn' end as chip,
 121.0e0+(cast((c_custkey*149+c_nationkey*883)%9216 as double)+0.25e0)*0.4e0/3600 as alpha_j2000,
 -30.0e0+(cast((c_custkey*211+c_nationkey*571)%9232 as double)+0.25e0)*0.4e0/3600 as delta_j2000,
 -15.0e0+c_acctbal/9000 as mag_auto
from customer
"""
EPHEMERIS = """
select o_orderkey as object_id, case o_orderkey%4 when 0 then 'kk' when 1 then 'mm' when 2 then 'tt' else 'nn' end as chip,
 121.0e0+(cast((o_orderkey*173+o_custkey*37)%9216 as double)+0.25e0)*0.4e0/3600 as ra,
 -30.0e0+(cast((o_orderkey*227+o_custkey*53)%9232 as double)+0.25e0)*0.4e0/3600 as dec
from orders
"""

# tables that feed heavy operators
LARGE = {"lineitem", "orders", "embeddings"}
BASE = ["lineitem", "orders", "customer", "part", "supplier", "nation", "region", "events", "embeddings"]
DUCK = {"string": "varchar", "day": "strftime(ts,'%Y%m%d')", "range": "range(40) r(i)"}
SPARK = {"string": "string", "day": "date_format(ts,'yyyyMMdd')", "range": "(select cast(id as bigint) as i from range(40))"}

_DUCK_CHIPS = "select e.*, t.chip from exposures e cross join (values ('kk'),('mm'),('tt'),('nn')) t(chip)"
_SPARK_CHIPS = "select e.*, chip from exposures e lateral view explode(array('kk','mm','tt','nn')) t as chip"

DUCK_VIEWS = {
    "sources": SOURCES,
    "refcat": REFCAT,
    "exposures": EXPOSURES.format(**DUCK),
    "chips": _DUCK_CHIPS,
    "tiles": TILES.format(**DUCK),
    "pixels": PIXELS_DUCK,
    "uploads": UPLOADS.format(**DUCK),
    "candidates": CANDIDATES,
    "inverse": INVERSE,
    "inverse_ref": INVERSE_REF,
    "ephemeris": EPHEMERIS,
}
SPARK_VIEWS = {
    **DUCK_VIEWS,
    "exposures": EXPOSURES.format(**SPARK),
    "chips": _SPARK_CHIPS,
    "tiles": TILES.format(**SPARK),
    "pixels": PIXELS_SPARK,
    "strips": STRIPS_SPARK,
    "uploads": UPLOADS.format(**SPARK),
}
# views each view reads
DEPENDS = {"refcat": ["sources"], "chips": ["exposures"], "candidates": ["sources"]}


def _replace_names(spark: SparkSession, name: str, sf_dir: str) -> DataFrame:
    args = {}
    text = SPARK_VIEWS[name]
    for dep in DEPENDS.get(name, []):
        args[dep] = view(spark, dep, sf_dir)
    for table in BASE:
        if f"from {table}\n" in text + "\n" or f"from {table} " in text:
            args[table] = table_of(spark, table, sf_dir)
    for key in args:
        text = text.replace(f"from {key} ", f"from {{{key}}} ").replace(f"from {key}\n", f"from {{{key}}}\n")
        if text.rstrip().endswith(f"from {key}"):
            text = text.rstrip()[: -len(key)] + f"{{{key}}}"
    return spark.sql(text, **args) if args else spark.sql(text)


def table_of(spark: SparkSession, name: str, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(table) if name in LARGE else table


def view(spark: SparkSession, name: str, sf_dir: str) -> DataFrame:
    return _replace_names(spark, name, sf_dir)


def duck(*names: str) -> str:
    """``with`` clause defining the named views and what they need, in order."""
    order: list[str] = []

    def add(n: str) -> None:
        for dep in DEPENDS.get(n, []):
            add(dep)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return ",\n".join(f"{n} as ({DUCK_VIEWS[n].strip()})" for n in order)
