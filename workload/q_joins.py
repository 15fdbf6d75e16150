"""Positional joins, zero points, frame grading, stacking."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyflow.functions.naming import CHIPS
from skyflow.operators import cells, clip, match as mt, photometry as ph, quality as qa, selection as sel, stacking as st
from skyflow.session import stored
from workload.q_scalars import matched, zp_matched
from workload.sqlkit import clip as clip_sql, match, query, sep, using
from workload.views import table_of, view

_M = match("m", "sources", "refcat", 2.0, "ref_id", ["rmag", "e_rmag"])
_V = ("sources", "refcat")
# Separations have 6 decimals; the queries show 4, and the 3e-7 keeps halves off the edge where two engines may round apart.


@query("sky_match__J1", using(*_V, ctes=_M) + "select number, chip, ref_id, round(sep+3e-7,4) as sep, round(ref_rmag,9) as ref_rmag from m")
def sky_match(spark, d):
    return matched(spark, d).select("number", "chip", "ref_id", F.round(F.col("sep") + 3e-7, 4).alias("sep"), F.round("ref_rmag", 9).alias("ref_rmag"))


@query(
    "sky_match_keep_all__J1",
    using(*_V, ctes=match("m", "sources", "refcat", 0.5, "ref_id", keys=["chip"])) +
    "select number, m.ref_id, round(m.sep+3e-7,4) as sep from sources left join m using (number)",
)
def sky_match_keep_all(spark, d):
    return mt.sky_match(view(spark, "sources", d), view(spark, "refcat", d), 0.5, keys=["chip"], how="left").select("number", "ref_id", F.round(F.col("sep") + 3e-7, 4).alias("sep"))


_NEAR = f"""near as (select c.number, min(struct_pack(s := {sep('c.alpha_j2000', 'c.delta_j2000', 'i.alpha_j2000', 'i.delta_j2000')}, i := i.inv_id)) as b
 from candidates c join inverse i on c.chip=i.chip group by c.number)"""


@query(
    "sky_nearest__J2",
    using("candidates", "inverse", ctes=_NEAR) + "select number, b.i as near_inv_id, round(b.s+3e-7,4) as sep from near",
)
def sky_nearest(spark, d):
    return mt.sky_nearest(
        view(spark, "candidates", d), view(spark, "inverse", d), keys=["chip"], right_id="inv_id"
    ).select("number", "near_inv_id", F.round(F.col("sep") + 3e-7, 4).alias("sep"))


_RMS = {"kk": 0.1, "mm": 0.15, "tt": 0.2}


def _with_rms(spark, d):
    s = sel.amp_of(view(spark, "sources", d))
    rms = None
    for c, v in _RMS.items():
        rms = F.when(F.col("chip") == c, F.lit(v)) if rms is None else rms.when(F.col("chip") == c, F.lit(v))
    return s.withColumn("rms", rms)


_ADAPT = (
    match("m0", "sources", "refcat", 1.0, "ref_id", keys=["chip"], hidden="rn")
    + """,
 m as (select *, cast(floor(x_image/1152) as int) as amp, case chip when 'kk' then 0.1e0 when 'mm' then 0.15e0 when 'tt' then 0.2e0 end as rms from m0),
 k as (select chip, amp, case when count(*) filter (where raw<rms*1)>50 then 1 when count(*) filter (where raw<rms*2)>50 then 2
  when count(*) filter (where raw<rms*3)>50 then 3 when count(*) filter (where raw<rms*4)>50 then 4 else 5 end as match_k from m group by chip, amp),
 a as (select m.*, case when rms is not null then match_k end as match_k, coalesce(rms*match_k,0.5e0) as match_radius from m join k using (chip, amp))"""
)


@query(
    "adaptive_match__J3",
    using(*_V, ctes=_ADAPT) + "select number, chip, amp, ref_id, round(sep+3e-7,4) as sep, match_k, round(match_radius,6) as match_radius from a where raw<match_radius",
)
def adaptive_match(spark, d):
    sources = _with_rms(spark, d).select("number", "chip", "amp", "alpha_j2000", "delta_j2000", "rms")
    m = mt.adaptive_match(
        sources, view(spark, "refcat", d), group=["chip", "amp"], rms="rms", min_n=50, max_k=5, keys=["chip"]
    )
    return m.select("number", "chip", "amp", "ref_id", F.round(F.col("sep") + 3e-7, 4).alias("sep"), "match_k", F.round("match_radius", 6).alias("match_radius"))


@query(
    "nearest_tile__J4",
    using("exposures", "tiles", ctes=match(
        "m", "exposures", "tiles", 3600.0, "field", ["radec"], lid="frame_id", lpos=("ra", "dec"), rpos=("ra", "dec"), strict="<="
    )) + "select frame_id, lpad(cast(ref_field as varchar),4,'0') as tile_field, ref_radec as tile_radec, round(sep/3600,9) as tile_sep from m",
)
def nearest_tile(spark, d):
    return mt.nearest_tile(view(spark, "exposures", d), view(spark, "tiles", d)).select(
        "frame_id", "tile_field", "tile_radec", F.round("tile_sep", 9).alias("tile_sep")
    )


@query(
    "moving_object_flag__J5",
    using("candidates", "ephemeris", ctes=match("m", "candidates", "ephemeris", 5.0, "object_id", rpos=("ra", "dec"), keys=["chip"]))
    + "select number, m.sep is not null as flag_0 from candidates left join m using (number)",
)
def moving_object(spark, d):
    return mt.moving_object_flag(view(spark, "candidates", d), view(spark, "ephemeris", d), keys=["chip"]).select("number", "flag_0")


@query(
    "attach_image_stats__J6",
    using("candidates", ctes="md as (select chip, median(fwhm_image*0.4e0) as seeing, median(ellipticity) as med_ellipticity from candidates group by chip)")
    + "select number, chip, round(seeing,9) as seeing, round(med_ellipticity,9) as med_ellipticity from candidates join md using (chip)",
)
def attach_image_stats(spark, d):
    from skyflow.operators.vetting import image_stats

    c = view(spark, "candidates", d)
    return mt.attach(c, image_stats(c, ["chip"]), ["chip"]).select(
        "number", "chip", F.round("seeing", 9).alias("seeing"), F.round("med_ellipticity", 9).alias("med_ellipticity")
    )


_REF_SETS = """pa as (select field, band, 'a/'||field||'/ref.'||band||'.'||cast(cast(exptime as int) as varchar)||'sec.'||serial as path, exptime from exposures where site='SAAO' and badamp='00000000'),
 pb as (select field, band, 'b/'||field||'/ref.'||band||'.'||cast(cast(exptime as int) as varchar)||'sec.'||serial as path, exptime from exposures where site='CTIO'),
 la as (select field, band, path from (select *, row_number() over (partition by field, band order by exptime desc, path) rn from pa) where rn=1),
 lb as (select field, band, path from (select *, row_number() over (partition by field, band order by exptime desc, path) rn from pb) where rn=1),
 w as (select distinct field, band from exposures)"""


def _products(spark, d):
    e = view(spark, "exposures", d)

    def named(df, p):
        path = F.concat(F.lit(p + "/"), "field", F.lit("/ref."), "band", F.lit("."), F.col("exptime").cast("int").cast("string"), F.lit("sec."), "serial")
        return df.select("field", "band", path.alias("path"), "exptime")

    return e, named(e.where("site='SAAO' and badamp='00000000'"), "a"), named(e.where("site='CTIO'"), "b")


@query(
    "latest_reference__J7_O3",
    using("exposures", ctes=_REF_SETS) + "select w.field, w.band, coalesce(la.path, lb.path) as reference from w left join la using (field, band) left join lb using (field, band)",
)
def latest_reference(spark, d):
    e, a, b = _products(spark, d)
    return st.latest_reference(e.select("field", "band").distinct(), a, b)


_STACKABLE = """(qaresult and (badamp='00000000' or (badamp='00000010' and site='CTIO') or (badamp='00000001' and site='SAAO' and chip='nn')))"""


@query("stackable_chips__X11", using("chips") + f"select frame_id, chip, site, badamp from chips where {_STACKABLE}")
def stackable_chips(spark, d):
    return st.stackable(view(spark, "chips", d)).select("frame_id", "chip", "site", "badamp")


_FULL = f"""ok as (select * from chips where {_STACKABLE}), full_ids as (select frame_id from ok group by frame_id having count(distinct chip)=4),
 members as (select * from ok semi join full_ids using (frame_id))"""


@query("full_frames__J9", using("chips", ctes=_FULL) + "select frame_id, chip from members")
def full_frames(spark, d):
    return st.full_frames(st.stackable(view(spark, "chips", d))).select("frame_id", "chip")


@query(
    "full_frame_intersection__U2",
    using("chips", ctes=_FULL) + "select frame_id from full_ids",
)
def full_frame_intersection(spark, d):
    return st.full_frame_sets(st.stackable(view(spark, "chips", d)))


@query(
    "stack_summary__A11",
    using("chips", ctes=_FULL) + """select site, field, band, count(*) filter (where chip='kk') as dither,
 round(arg_min(exptime, frame_id)*count(*) filter (where chip='kk'),6) as exptime,
 round(avg(epoch_us(date_obs)/86400e6+40587) filter (where chip='kk'),6) as mean_mjd, round_even(avg(fwhm),2) as fwhm,
 round_even(avg(saturate),0) as saturate, round_even(min(saturate),0) as undersat,
 string_agg(frame_id||' '||strftime(date_obs,'%Y-%m-%d')||' '||site, ',' order by frame_id) filter (where chip='kk') as images
from members group by site, field, band""",
)
def stack_summary(spark, d):
    s = st.stack_summary(st.full_frames(st.stackable(view(spark, "chips", d))))
    images = F.transform("images", lambda i: F.concat_ws(" ", i["name"], F.date_format(i["date"], "yyyy-MM-dd"), i["observatory"]))
    return s.drop("mean_date").withColumns(
        {"mean_mjd": F.round("mean_mjd", 6), "exptime": F.round("exptime", 6), "images": F.concat_ws(",", images)})


@query(
    "frame_numbers__W2",
    using("chips", ctes=_FULL) + """select frame_id, site, field, band, n as frame_number, substr('0123456789abcdef',cast(n%16+1 as int),1) as digit
from (select *, row_number() over (partition by site, field, band order by frame_id)-1 as n from members where chip='kk')""",
)
def frame_numbers(spark, d):
    n = st.frame_numbers(st.full_frames(st.stackable(view(spark, "chips", d))), ["site", "field", "band"])
    return n.select("frame_id", "site", "field", "band", F.col("frame_number").cast("long").alias("frame_number"), "digit")


@query(
    "sky_cells__J11",
    using("sources", ctes="""z as (select number, alpha_j2000 as a, cast(floor((delta_j2000+90)/0.01e0) as bigint) as zone from sources),
 n as (select *, greatest(1, cast(floor(36000e0*cos(radians((zone+0.5e0)*0.01e0-90))) as bigint)) as n from z)""")
    + "select number, zone*4294967296+least(n-1, cast(floor(a*n/360) as bigint)) as cell from n",
)
def sky_cells(spark, d):
    return cells.sky_cells(view(spark, "sources", d), "alpha_j2000", "delta_j2000", 0.0025, copies=False, h=0.01).select("number", "cell")


@query(
    "argmin_per_key__W1_O4",
    using("sources") + """select chip, flags, arg_min(number, struct_pack(a := mag_auto, b := number)) as brightest from sources group by chip, flags""",
)
def argmin_per_key(spark, d):
    return view(spark, "sources", d).groupBy("chip", "flags").agg(
        F.min_by("number", F.struct("mag_auto", "number")).alias("brightest")
    )


@query(
    "median_compared_rows__W4",
    using("sources", ctes="md as (select chip, flags, median(class_star) as mid from sources group by chip, flags)")
    + "select number, class_star>mid as above from sources join md using (chip, flags)",
)
def median_compared_rows(spark, d):
    s = view(spark, "sources", d)
    mid = clip.exact_median(s, ["chip", "flags"], "class_star", "mid")
    return s.join(mid, ["chip", "flags"]).select("number", (F.col("class_star") > F.col("mid")).alias("above"))


# --- clipping and zero points ------------------------------------------------

_CLIPPED = clip_sql("c", "sources", ["chip"], "mag_auto", 1.5, 60)


@query(
    "sigma_clip__A1",
    using("sources", ctes=_CLIPPED) + "select s.number, c.number is not null as kept from sources s left join c using (number)",
)
def sigma_clip(spark, d):
    return clip.sigma_clip(view(spark, "sources", d), ["chip"], "mag_auto", 1.5).select("number", "kept")


@query(
    "clipped_stats__A2",
    using("pixels", ctes=clip_sql("c", "pixels", ["frame_id"], "value", 3.0, 5))
    + "select frame_id, count(*) as n_kept, round(avg(v),6) as mean, round(median(v),6) as median, round(stddev_pop(v),6) as std from c group by frame_id",
)
def clipped_stats(spark, d):
    s = clip.clip_summary(view(spark, "pixels", d), ["frame_id"], "value", 3.0, 5)
    return s.select("frame_id", "n_kept", *[F.round(c, 6).alias(c) for c in ("mean", "median", "std")])


_ZP_STARS = _M + """,
 st as (select *, ref_rmag-mag_auto as zp from m where flags<=0 and ref_rmag<17 and ref_rmag>14 and ref_e_rmag<0.05e0 and magerr_auto<0.1e0
  and mag_auto<>99 and ref_rmag<>99)"""
_ZP = _ZP_STARS + ",\n" + clip_sql("c", "st", ["chip"], "zp", 2.0) + """,
 n as (select chip, count(*) as n_all from st group by chip)"""


def _zero_point(spark, d, m=None):
    s = view(spark, "sources", d)
    stars = sel.select_zp_stars(zp_matched(spark, d) if m is None else m, "ref_rmag", "ref_e_rmag", "magerr_auto")
    return ph.zero_point(stars, ["chip"], "mag_auto", "ref_rmag", bound=s)


@query(
    "stellar_zero_point__A4",
    using(*_V, ctes=_ZP) + """select chip, round(median(v),6) as zp, round(stddev_pop(v),6) as zper, count(*) as n_kept,
 any_value(n_all)-count(*) as n_clipped from c join n using (chip) group by chip""",
)
def stellar_zero_point(spark, d):
    return _zero_point(spark, d).withColumns({"zp": F.round("zp", 6), "zper": F.round("zper", 6)})


@query(
    "photometric_residual__A6",
    using(*_V, ctes=_ZP + """,
 z as (select chip, median(v) as zpv from c group by chip),
 rs as (select m.chip, mag_auto+zpv-ref_rmag as d from m join z using (chip) where flags<=0 and class_star>0.8e0 and ref_rmag<17 and ref_rmag>14 and mag_auto<>99),
 md as (select chip, median(d) as md from rs group by chip),
 """ + clip_sql("q", "rs", ["chip"], "d", 3.0)) + """select chip, round_even(any_value(md),3) as meddif, round_even(sqrt(avg(v*v)),3) as rmse from q join md using (chip) group by chip""",
)
def photometric_residual(spark, d):
    # both ask for clean sources, which hold before the match as well; it is written once for all that reads it
    m = matched(spark, d, where=F.col("flags") <= 0).select("chip", "flags", "class_star", "mag_auto", "magerr_auto", "ref_rmag", "ref_e_rmag")
    m = stored(m, "matched")
    return ph.photometric_residual(m, _zero_point(spark, d, m), ["chip"], "mag_auto", "ref_rmag", bound=view(spark, "sources", d))


@query(
    "match_rms__A7",
    using(*_V, ctes=_M + ",\n" + clip_sql("c", "m", ["chip"], "sep", 3.0))
    + "select chip, count(*) as aln_num, round_even(sqrt(avg(v*v)),5) as aln_rms, round_even(stddev_pop(v),5) as aln_std from c group by chip",
)
def match_rms(spark, d):
    return ph.match_rms(matched(spark, d, ()), ["chip"], bound=view(spark, "sources", d))


# --- frame grading -----------------------------------------------------------

# sources spread over frames; the sky level comes from the exposure table
_FRAME_VIEWS = """fs as (select s.*, l_orderkey//40 as frame_id from sources s),
 sky as (select o_orderkey//40 as frame_id, chip, round(avg(o_totalprice)/1500,9) as sky from orders cross join (values ('kk'),('mm'),('tt'),('nn')) t(chip) group by 1, 2)"""


def _frame_tables(spark, d):
    s = view(spark, "sources", d).withColumn("frame_id", F.expr("l_orderkey div 40"))
    o = table_of(spark, "orders", d)
    sky = (
        o.groupBy(F.expr("o_orderkey div 40").alias("frame_id")).agg(F.round(F.avg("o_totalprice") / 1500, 9).alias("sky"))
        .withColumn("chip", F.explode(F.array(*[F.lit(c) for c in CHIPS])))
    )
    return s, sky


_FS = clip_sql("fc", "fsel", ["frame_id", "chip"], "fwhm_image", 3.0, 10)
_QUALITY = _FRAME_VIEWS + """,
 fsel as (select frame_id, chip, fwhm_image from fs where mag_auto<>99 and magerr_auto<=0.005e0 and flags=0 and fwhm_image<=30),
 """ + _FS + """,
 fw as (select frame_id, chip, 0.4e0*median(v) as fwhm from fc group by frame_id, chip),
 el as (select frame_id, chip, avg(elongation) as elong from fs where mag_auto<>99 and magerr_auto<=0.005e0 and abs(theta_image)<88 group by frame_id, chip),
 ch as (select sky.frame_id, sky.chip, sky, coalesce(fwhm,99e0) as fwhm, coalesce(elong,99e0) as elong from sky left join fw using (frame_id, chip) left join el using (frame_id, chip)),
 q as (select frame_id, max(sky) filter (where chip='kk') as sky_kk, max(fwhm) filter (where chip='kk') as fwhm_kk, max(fwhm) filter (where chip='nn') as fwhm_nn,
  max(elong) filter (where chip='tt') as elong_tt, avg(sky) as sky_avg, avg(fwhm) as fwhm_avg, avg(elong) as elong_avg, min(sky) as sky_min, max(fwhm) as fwhm_max from ch group by frame_id)"""


@query(
    "frame_quality__A5",
    using("sources", ctes=_QUALITY) + """select frame_id, round(sky_kk,8) as sky_kk, round(fwhm_kk,8) as fwhm_kk, round(fwhm_nn,8) as fwhm_nn,
 round(elong_tt,8) as elong_tt, round(sky_avg,8) as sky_avg, round(fwhm_avg,8) as fwhm_avg, round(elong_avg,8) as elong_avg from q""",
)
def frame_quality(spark, d):
    s, sky = _frame_tables(spark, d)
    q = qa.frame_quality(s, sky)
    return q.select("frame_id", *[F.round(c, 8).alias(c) for c in ("sky_kk", "fwhm_kk", "fwhm_nn", "elong_tt", "sky_avg", "fwhm_avg", "elong_avg")])


@query(
    "reject_frames__X3",
    using("exposures") + """select frame_id, case when sky_min<=20 then 'badccderror' when ra=0 and dec=0 then 'badccderror' when fwhm_max>=6 then 'badseeing'
 when elong_avg>=2 then 'badtracking' end as reject_reason
from (select frame_id, saturate/60000*(frame_id%50)*3 as sky_min, case when frame_id%23=0 then 0 else ra end as ra, case when frame_id%23=0 then 0 else dec end as dec,
 fwhm*1.5e0 as fwhm_max, exptime/80 as elong_avg from exposures)""",
)
def reject_frames(spark, d):
    zero = F.col("frame_id") % 23 == 0
    e = view(spark, "exposures", d).select(
        "frame_id", (F.col("saturate") / 60000 * (F.col("frame_id") % 50) * 3).alias("sky_min"),
        F.when(zero, 0.0).otherwise(F.col("ra")).alias("ra"), F.when(zero, 0.0).otherwise(F.col("dec")).alias("dec"),
        (F.col("fwhm") * 1.5).alias("fwhm_max"), (F.col("exptime") / 80).alias("elong_avg"),
    )
    return qa.reject_frames(e).select("frame_id", "reject_reason")


# sections: a frame is (chip, l_linenumber); positions rounded down so that some lie on borders
def sections_sql(radius: float, x: str, y: str, factor: str) -> str:
    return match("m0", "sources", "refcat", radius, "ref_id", keys=["chip"]) + f""",
 ss as (select s.chip, s.l_linenumber as visit, s.number, {x} as x, {y} as y, m0.sep*{factor} as sep
  from sources s left join m0 using (number)),
 b as (select chip, visit, number, x, y, sep, i, j from ss, range(8) ti(i), range(8) tj(j)
  where x>=0.5e0+i*9216e0/8 and x<=0.5e0+(i+1)*9216e0/8 and y>=0.5e0+j*9232e0/8 and y<=0.5e0+(j+1)*9232e0/8),
 g as (select chip, visit, j*8+i as section, count(*) as n_all, count(sep) as n_match, sqrt(avg(sep*sep)) as r, stddev_pop(sep) as sd from b group by all),
 fr as (select distinct chip, visit from ss),
 f as (select chip, visit, i as section from fr, range(64) t(i)),
 sec as (select chip, visit, cast(section as int) as section, coalesce(n_all,0) as n_all, coalesce(n_match,0) as n_match,
  case when n_all is null then 1 else n_match/n_all end as ratio, case when n_all is null then 0 when n_match=0 then 99 else r end as rms,
  case when n_all is null then 0 when n_match=0 then 99 else sd end as std from f left join g using (chip, visit, section)),
 st as (select *, case when n_all=0 then 'empty' when ratio>0.6e0 and rms<1 then 'good' else 'bad' end as state from sec)"""


_SECT = sections_sql(0.5, "floor(s.x_image)+0.5e0", "floor(s.y_image)+0.5e0", "2.5e0")


def _sections(spark, d):
    m = mt.sky_match(view(spark, "sources", d), view(spark, "refcat", d), 0.5, keys=["chip"], how="left")
    m = m.select(
        "chip", F.col("l_linenumber").alias("visit"), (F.floor("x_image") + 0.5).alias("xwin_image"),
        (F.floor("y_image") + 0.5).alias("ywin_image"), (F.col("sep") * 2.5).alias("sep"),
    )
    return qa.section_qa(m, ["chip", "visit"])


@query(
    "section_qa__A8",
    using(*_V, ctes=_SECT) + "select chip, visit, section, n_all, n_match, round(ratio,6) as ratio, round(rms,6) as rms, round(std,6) as std, state from st",
)
def section_qa(spark, d):
    return _sections(spark, d).withColumns({c: F.round(c, 6) for c in ("ratio", "rms", "std")})


_VERDICT = _SECT + """,
 v as (select chip, visit, count(*) as n_sect, count(*) filter (where state='good') as n_good, count(*) filter (where state='bad') as n_bad,
  list_sort(list(section) filter (where state='empty')) as e from st group by chip, visit)"""


@query(
    "frame_verdict__A9",
    using(*_V, ctes=_VERDICT) + """select chip, visit, n_sect, n_good, n_bad, coalesce(len(e)=8 and e[1]<8 and e=list_transform(range(8), lambda k: e[1]+8*k),false) as bad_amp, n_bad<=2 as qaresult from v""",
)
def frame_verdict(spark, d):
    return qa.frame_verdict(_sections(spark, d), ["chip", "visit"]).drop("bad_sections")


@query(
    "bad_section_bitmap__A10",
    using(*_V, ctes=_SECT) + """select chip, visit, string_agg(substr('0123456789ABCDEF',cast(h+1 as int),1),'' order by q) as bad_sections
from (select chip, visit, section//4 as q, sum(case when state='bad' then 1<<(3-section%4) else 0 end) as h from st group by all) group by chip, visit""",
)
def bad_section_bitmap(spark, d):
    return qa.frame_verdict(_sections(spark, d), ["chip", "visit"]).select("chip", "visit", "bad_sections")


@query(
    "badamp_code__A20",
    using("sources", ctes="""a as (select l_linenumber as visit, chip, cast(floor(x_image/1152) as int) as amp, avg(fwhm_image) as f from sources group by all)""")
    + """select visit, chip, string_agg(case when bad then '1' else '0' end,'' order by i) as badamp, not bool_or(bad) as photqa
from (select v.visit, v.chip, r.i, coalesce(a.f>5.52e0,false) as bad from (select distinct visit, chip from a) v join range(8) r(i) on true
 left join a on a.visit=v.visit and a.chip=v.chip and a.amp=r.i) group by visit, chip""",
)
def badamp_code(spark, d):
    s = sel.amp_of(view(spark, "sources", d)).groupBy(F.col("l_linenumber").alias("visit"), "chip", "amp").agg(F.avg("fwhm_image").alias("f"))
    return ph.badamp_code(s.withColumn("bad", F.col("f") > 5.52), ["visit", "chip"])


@query("amp_zero_point_fit__A16")
def amp_zero_point_fit(spark, d):
    m = sel.amp_of(matched(spark, d, ["rmag"])).select("chip", "amp", "mag_auto", "ref_rmag", "y_image")
    m = stored(m, "matched")  # for the robust and the plain line
    return ph.amp_zero_point_fit(m, ["chip", "amp"], "mag_auto", "ref_rmag", bound=sel.amp_of(view(spark, "sources", d)))


_LINE = "(amp+1)*1e-5"
_BASE = "-29.5-case chip when 'kk' then 0.0 when 'mm' then 0.25 when 'nn' then 0.5 else 0.75 end"


@query(
    "exact_amp_zero_points__A16",
    using(*_V, ctes=f"""am as (select *, cast(greatest(0,least(7,floor(x_image/1152))) as int) as amp from sources)""")
    + f"""select chip, amp, round({_LINE},8) as slope, round({_BASE},5) as intercept, 1e0 as score, count(*) as n_fit, 'huber' as method, false as bad, true as converged
from am group by chip, amp""",
)
def exact_amp_zero_points(spark, d):
    """Magnitudes that lie on a line in y exactly, one for each amplifier: the robust fit has to find it."""
    s = sel.amp_of(view(spark, "sources", d))
    line = F.expr(_LINE.replace("e-5", "E-5").replace("1E-5", "1.0E-5D")) * F.col("y_image") + F.expr(_BASE).cast("double")
    out = ph.amp_zero_point_fit(s.withColumn("ref", F.col("mag_auto") - line), ["chip", "amp"], "mag_auto", "ref")
    return out.select("chip", "amp", F.round("slope", 8).alias("slope"), F.round("intercept", 5).alias("intercept"), F.round("score", 6).alias("score"), "n_fit", "method", "bad", "converged")


def _solve_sql(prefix: str, source: str) -> str:
    """Gaussian elimination of the 6 x 6 normal equations, one CTE per pivot."""
    terms = ph.POLY_TERMS
    cols = {}
    for i, a in enumerate(terms):
        for j, b in enumerate(terms):
            p, q = (a, b) if i <= j else (b, a)
            cols[(i, j)] = f"s_{p}_{q}"
        cols[(i, 6)] = f"t_{a}"
    steps = [f"{prefix}0 as materialized (select chip, n, " + ", ".join(f"{c} as a{i}{j}" for (i, j), c in cols.items()) + f" from {source})"]
    for p in range(6):
        parts = []
        for i in range(6):
            for j in range(7):
                if i == p:
                    parts.append(f"a{p}{j}/a{p}{p} as a{i}{j}")
                else:
                    parts.append(f"a{i}{j}-a{i}{p}*a{p}{j}/a{p}{p} as a{i}{j}")
        steps.append(f"{prefix}{p + 1} as materialized (select chip, n, {', '.join(parts)} from {prefix}{p})")
    return ",\n".join(steps)


def _moments_sql() -> str:
    basis = {"xx": "u*u", "yy": "v*v", "xy": "u*v", "x": "u", "y": "v", "one": "1"}
    t = ph.POLY_TERMS
    sums = [f"sum({basis[a]}*{basis[b]}) as s_{a}_{b}" for i, a in enumerate(t) for b in t[i:]]
    sums += [f"sum({basis[a]}*z) as t_{a}" for a in t]
    return f"""p as (select s.chip, s.x_image/4608e0-1 as u, s.y_image/4616e0-1 as v, s.mag_auto-r.rmag+s.x_image*s.x_image*1e-9 as z
  from sources s join refcat r on s.number=r.ref_id), mo as (select chip, count(*) as n, {', '.join(sums)} from p group by chip)"""


@query(
    "surface_fit__A17",
    using(*_V, ctes=_moments_sql() + ",\n" + _solve_sql("e", "mo"))
    + "select chip, n, " + ", ".join(f"round(a{i}6,6) as c_{t}" for i, t in enumerate(ph.POLY_TERMS)) + " from e6",
)
def surface_fit(spark, d):
    s = view(spark, "sources", d).join(view(spark, "refcat", d).select(F.col("ref_id").alias("number"), "rmag"), "number")
    s = s.withColumn("z", F.col("mag_auto") - F.col("rmag") + F.col("x_image") * F.col("x_image") * 1e-9)
    f = ph.poly2d_fit(s, ["chip"], "x_image", "y_image", "z")
    return f.select("chip", "n", *[F.round(f"c_{t}", 6).alias(f"c_{t}") for t in ph.POLY_TERMS])


@query("depth_from_errors__A18")
def depth_from_errors(spark, d):
    s = view(spark, "sources", d).select(
        "chip", "flags", F.lit(0.9).alias("class_star"), (F.col("mag_auto") + 34).alias("mag_aper"),
        (F.exp(0.85 * (F.col("mag_auto") + 34)) * 2e-9 * (1 + (F.col("l_linenumber") - 4) * 0.01)).alias("magerr_aper"),
    )
    return ph.depth_from_errors(s, ["chip"])


_DEPTH = "case chip when 'kk' then 20.03 when 'mm' then 20.17 when 'nn' then 19.88 else 20.41 end"


@query(
    "exact_depths__A18",
    using("sources", ctes=f"""er as (select chip, flags, mag_auto+34 as m, 0.2e0*exp(0.9e0*(mag_auto+34-cast({_DEPTH} as double))) as e from sources)""")
    + f"""select chip, cast({_DEPTH} as double) as depth, 0.9e0 as b, 1e0 as r2, 0.03e0 as cut, count(*) as n, true as converged from er where flags<4 and e>=0.03e0 and e<=0.5e0 group by chip""",
)
def exact_depths(spark, d):
    """Errors that grow exponentially without scatter: the depth is where they reach 5 sigma."""
    m = F.col("mag_auto") + 34
    s = view(spark, "sources", d).select(
        "chip", "flags", F.lit(0.9).alias("class_star"), m.alias("mag_aper"), (F.exp((m - F.expr(_DEPTH).cast("double")) * 0.9) * 0.2).alias("magerr_aper"),
    )
    out = ph.depth_from_errors(s, ["chip"])
    return out.select("chip", "depth", F.round("b", 6).alias("b"), F.round("r2", 6).alias("r2"), "cut", "n", "converged")


@query(
    "depth_from_sky__A19",
    using("pixels") + """select frame_id, round(zp,6) as zp, round(sig,6) as sky_sigma, round_even(zp-2.5e0*log10(5*sig*sqrt(pi()*pow(12.5e0/2,2))),3) as depth
from (select frame_id, 29.5e0+frame_id/100 as zp, median(abs(value-200)) as sig from pixels where value<>200 group by frame_id)""",
)
def depth_from_sky(spark, d):
    p = view(spark, "pixels", d).withColumn("value", F.abs(F.col("value") - 200))
    zp = p.select("frame_id").distinct().withColumn("zp", F.lit(29.5) + F.col("frame_id") / 100)
    out = ph.depth_from_sky(p, zp, ["frame_id"])
    return out.select("frame_id", F.round("zp", 6).alias("zp"), F.round("sky_sigma", 6).alias("sky_sigma"), "depth")
