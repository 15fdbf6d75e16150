"""Candidate flags on the candidate view, one image per chip."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyflow.functions.wcs import tan_struct
from skyflow.operators import strips as sp, vetting as vt
from workload.q_pixels import HOT, REF_XY, WIDTH
from workload.sqlkit import match, query, sep, using
from workload.views import view

K = ["chip"]
STEP = (9216, 9232)

_STATS = """md as (select chip, median(fwhm_image*0.4e0) as seeing, median(ellipticity) as me, median(elongation) as ml, median(background) as bm, stddev_pop(background) as bs
  from candidates group by chip),
 cc as (select *, 1/(magerr_auto+0.0001e0) as snr, mag_auto+30 as mag_cal, fwhm_world*3600/seeing as rs, ellipticity/me as re from candidates join md using (chip))"""


def _near(name: str, table: str) -> str:
    return f"""{name} as (select c.number, min(struct_pack(s := {sep('c.alpha_j2000', 'c.delta_j2000', 'i.alpha_j2000', 'i.delta_j2000')}, i := i.inv_id, m := i.mag_auto)) as b
 from candidates c join {table} i on c.chip=i.chip group by c.number)"""


# difference images: each small frame less the next one, 8 columns at the start of each amplifier of a chip, every 73rd row
_DIFF = f"""df as materialized (select ['kk','mm','tt','nn'][s.frame_id%4+1] as chip, s.amp*1152+s.x%8 as x, (s.y+125*(s.frame_id//4))*73 as y,
  case when r.value is null or r.value>{HOT} then 1e-30 else 20*s.value-20*r.value end as value
  from pixels s left join pixels r on s.frame_id=r.frame_id-1 and s.x=r.x and s.y=r.y),
 bx as (select number, chip, background-25*bs as cut, greatest(0,floor(x_image-seeing/0.4e0)) as x0, greatest(0,floor(x_image+seeing/0.4e0)) as x1,
  cast(greatest(0,floor(y_image-seeing/0.4e0)) as int) as y0, cast(greatest(0,floor(y_image+seeing/0.4e0)) as int) as y1 from cc),
 br as materialized (select number, chip, cut, x0, x1, unnest(range(y0,y1)) as y from bx),
 hx as materialized (select number, count(*) as n_box, count(*) filter (where value<cut) as n_bad, count(*) filter (where value=1e-30) as n_null
  from br join df using (chip, y) where x>=x0 and x<x1 group by number),
 cov as (select number, 4600-({REF_XY[0]})/(0.4e0/3600) as x, 4600+({REF_XY[1]})/(0.4e0/3600) as y from candidates)"""

_F0 = match("mo", "candidates", "ephemeris", 5.0, "object_id", rpos=("ra", "dec"), keys=["chip"])
_ALL = (
    _STATS + ",\n" + _DIFF + ",\n" + _near("n1", "inverse") + ",\n" + _near("n2", "inverse_ref") + ",\n" + _F0
    + """,
 fl as (select cc.number, cc.chip, mo.sep is not null as flag_0,
  coalesce(n1.b.s<seeing/2 or mag_cal-n1.b.m-30>-0.1e0,false) as flag_1, coalesce(n2.b.s<seeing/2 or mag_cal-n2.b.m-30>-0.5e0,false) as flag_2,
  cc.x_image<4608-4608*0.99e0 or cc.x_image>4608+4608*0.99e0 or cc.y_image<4616-4616*0.99e0 or cc.y_image>4616+4616*0.99e0 as flag_3,
  false as flag_4, re>4 as flag_5, cc.flags>=4 or cc.imaflags_iso>0 as flag_6, rs<0.7e0 or rs>2.4e0 as flag_7,
  abs(cc.background-bm)>2*bs as flag_8, snr<5 as flag_9, coalesce(n_bad>n_box*0.1e0,false) as flag_10, coalesce(n_null<>0,false) as flag_11,
  cov.x<0 or cov.x>9216 or cov.y<0 or cov.y>9232 as flag_12, false as flag_13
  from cc left join n1 using (number) left join n2 using (number) left join mo using (number) left join hx using (number) join cov using (number)),
 fin as (select *, (flag_0 or flag_1 or flag_2 or flag_3 or flag_4 or flag_5 or flag_6 or flag_7 or flag_8 or flag_9
  or flag_10 or flag_11 or flag_12) and not flag_0 as flag from fl)"""
)
_VIEWS = ("candidates", "inverse", "inverse_ref", "ephemeris", "pixels")


def _prepared(spark, d):
    c = view(spark, "candidates", d)
    return vt.prepare(c, c, K)


def _differences(spark, d):
    """Difference strips of each chip, masked where the reference is bright."""
    s = view(spark, "strips", d).withColumn("values", F.transform("values", lambda v: 20 * v))
    shift = {"frame_id": F.col("frame_id") - 1}
    mask = view(spark, "pixels", d).where(F.col("value") > HOT).withColumns(shift).select("frame_id", "x", "y", F.lit(1).alias("code"))
    out = sp.difference(s, s.withColumns(shift), mask, ["frame_id"], WIDTH)
    chip = F.get(F.array(*[F.lit(c) for c in ("kk", "mm", "tt", "nn")]), (F.col("frame_id") % 4).cast("int"))
    y = ((F.col("y") + 125 * F.expr("frame_id div 4")) * 73).cast("int")
    return out.select(chip.alias("chip"), "amp", y.alias("y"), "values")


def vetted(spark, d, images=None):
    """All flags; with ``images`` (``chip, visit``) of the candidates on these only."""
    c = view(spark, "candidates", d)
    if images is not None:
        c = c.withColumn("visit", F.col("l_linenumber")).join(images, ["chip", "visit"], "left_semi").drop("visit")
    wcs = c.select("chip").distinct().select(
        "chip", tan_struct(F.lit(121.5), F.lit(-29.5), 0.4 / 3600, 4600.0).alias("wcs"), F.lit(9216).alias("naxis1"), F.lit(9232).alias("naxis2")
    )
    return vt.vet(
        c, c, K, inverse=view(spark, "inverse", d), inverse_ref=view(spark, "inverse_ref", d),
        ephemeris=view(spark, "ephemeris", d), step=STEP, inverse_id="inv_id", pixels=_differences(spark, d), wcs=wcs,
    )


@query("flag_0_moving_object__T0", using("candidates", "ephemeris", ctes=_F0) + "select number, mo.sep is not null as flag_0 from candidates left join mo using (number)")
def flag_0(spark, d):
    return vt.flag_0(view(spark, "candidates", d), view(spark, "ephemeris", d), K).select("number", "flag_0")


@query(
    "flag_1_inverse_difference__T1",
    using("candidates", "inverse", ctes=_STATS + ",\n" + _near("n1", "inverse"))
    + "select number, coalesce(b.s<seeing/2 or mag_cal-b.m-30>-0.1e0,false) as flag_1 from cc left join n1 using (number)",
)
def flag_1(spark, d):
    return vt.flag_1(_prepared(spark, d), view(spark, "inverse", d), K, "inv_id").select("number", "flag_1")


@query(
    "flag_2_inverse_reference__T2",
    using("candidates", "inverse_ref", ctes=_STATS + ",\n" + _near("n2", "inverse_ref"))
    + "select number, coalesce(b.s<seeing/2 or mag_cal-b.m-30>-0.5e0,false) as flag_2 from cc left join n2 using (number)",
)
def flag_2(spark, d):
    return vt.flag_2(_prepared(spark, d), view(spark, "inverse_ref", d), K, "inv_id").select("number", "flag_2")


@query(
    "flag_3_edge__T3",
    using("candidates") + "select number, x_image<4608-4608*0.99e0 or x_image>4608+4608*0.99e0 or y_image<4616-4616*0.99e0 or y_image>4616+4616*0.99e0 as flag_3 from candidates",
)
def flag_3(spark, d):
    return vt.flag_3(view(spark, "candidates", d), *STEP).select("number", "flag_3")


@query("flag_4_unused__T4", using("candidates") + "select number, false as flag_4 from candidates")
def flag_4(spark, d):
    return vt.flag_4(view(spark, "candidates", d)).select("number", "flag_4")


@query("flag_5_ellipticity__T5", using("candidates", ctes=_STATS) + "select number, re>4 as flag_5 from cc")
def flag_5(spark, d):
    return vt.flag_5(_prepared(spark, d)).select("number", "flag_5")


@query("flag_6_extraction__T6", using("candidates") + "select number, flags>=4 or imaflags_iso>0 as flag_6 from candidates")
def flag_6(spark, d):
    return vt.flag_6(view(spark, "candidates", d)).select("number", "flag_6")


@query("flag_7_fwhm__T7", using("candidates", ctes=_STATS) + "select number, rs<0.7e0 or rs>2.4e0 as flag_7 from cc")
def flag_7(spark, d):
    return vt.flag_7(_prepared(spark, d)).select("number", "flag_7")


@query("flag_8_background__T8", using("candidates", ctes=_STATS) + "select number, abs(background-bm)>2*bs as flag_8 from cc")
def flag_8(spark, d):
    return vt.flag_8(_prepared(spark, d)).select("number", "flag_8")


@query("flag_9_snr__T9", using("candidates", ctes=_STATS) + "select number, snr<5 as flag_9 from cc")
def flag_9(spark, d):
    return vt.flag_9(_prepared(spark, d)).select("number", "flag_9")


_COLS = ["number", "chip", *[f"flag_{n}" for n in vt.FLAGS], "flag"]


@query("find_transients__K8_T13", using(*_VIEWS, ctes=_ALL) + "select " + ", ".join(_COLS) + " from fin")
def find_transients(spark, d):
    return vetted(spark, d).select(*_COLS)


@query("kept_candidates__J10", using(*_VIEWS, ctes=_ALL) + "select number, chip from fin where not flag")
def kept_candidates(spark, d):
    return vt.transients(vetted(spark, d)).select("number", "chip")


_LONG = " union all ".join(
    f"select chip, '{c}' as flag_name, count(*) filter (where {t}) as n, count(*) as a from fin group by chip"
    for c, t in [*[(f"flag_{n}", f"flag_{n}") for n in vt.FLAGS], ("kept", "not flag")]
)


@query(
    "flag_summary__A12",
    using(*_VIEWS, ctes=_ALL) + f"select chip, flag_name, n, cast(floor(100*n/a) as bigint) as percent, round(100e0*n/a,3) as share from ({_LONG})",
)
def flag_summary(spark, d):
    return vt.flag_summary(vetted(spark, d), K)
