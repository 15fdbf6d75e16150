"""Names, angles, times, colours, selections."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from skyflow.functions import angles, naming, photsys, timeconv
from skyflow.operators import cells, clip, photometry, selection
from skyflow.session import stored
from workload.sqlkit import match, query, sep, using
from workload.views import table_of, view

_SEXA = """select o_orderkey,
 case when o_custkey%2=0 then '-' else '' end || lpad(cast(o_orderkey%90 as varchar),2,'0') || ':' ||
 lpad(cast(o_custkey%60 as varchar),2,'0') || ':' || lpad(cast(o_orderkey%60 as varchar),2,'0') || '.5' as dms,
 lpad(cast(o_orderkey%24 as varchar),2,'0') || ':' || lpad(cast(o_custkey%60 as varchar),2,'0') || ':' ||
 lpad(cast(o_orderkey%60 as varchar),2,'0') || '.25' as hms from orders"""


def _sexa(spark, d):
    o = table_of(spark, "orders", d)
    return o.sparkSession.sql(_SEXA.replace("varchar", "string").replace("from orders", "from {o}"), o=o)


@query(
    "sexagesimal_to_degrees__G1",
    f"""with t as ({_SEXA}) select o_orderkey,
 round(case when dms like '-%' then -1 else 1 end*(cast(split_part(ltrim(dms,'-'),':',1) as double)
  +cast(split_part(dms,':',2) as double)/60+cast(split_part(dms,':',3) as double)/3600),8) as dec_deg,
 round(15*(cast(split_part(hms,':',1) as double)+cast(split_part(hms,':',2) as double)/60
  +cast(split_part(hms,':',3) as double)/3600),8) as ra_deg from t""",
)
def sexagesimal_to_degrees(spark, d):
    return _sexa(spark, d).select(
        "o_orderkey", F.round(angles.dms_to_deg("dms"), 8).alias("dec_deg"), F.round(angles.hms_to_deg("hms"), 8).alias("ra_deg")
    )


@query(
    "degrees_to_sexagesimal__G2",
    using("exposures", ctes="""t as (select frame_id, cast(round_even(ra/15*3600*10000,0) as bigint) as h,
  cast(round_even(abs(dec)*3600*1000,0) as bigint) as g, dec from exposures)""") + """
select frame_id,
 lpad(cast(h//36000000 as varchar),2,'0')||':'||lpad(cast(h//600000%60 as varchar),2,'0')||':'||
 lpad(cast(h//10000%60 as varchar),2,'0')||'.'||lpad(cast(h%10000 as varchar),4,'0') as ra_hms,
 case when dec<0 then '-' else '+' end||lpad(cast(g//3600000 as varchar),2,'0')||':'||
 lpad(cast(g//60000%60 as varchar),2,'0')||':'||lpad(cast(g//1000%60 as varchar),2,'0')||'.'||
 lpad(cast(g%1000 as varchar),3,'0') as dec_dms from t""",
)
def degrees_to_sexagesimal(spark, d):
    return view(spark, "exposures", d).select(
        "frame_id", angles.deg_to_hms("ra").alias("ra_hms"), angles.deg_to_dms("dec").alias("dec_dms")
    )


@query(
    "sky_separation__G3",
    using("sources") + f"select number, {sep('alpha_j2000', 'delta_j2000', '121.5e0', '-29.5e0')} as sep_arcsec from sources",
)
def sky_separation(spark, d):
    s = angles.sky_sep("alpha_j2000", "delta_j2000", F.lit(121.5), F.lit(-29.5))
    return view(spark, "sources", d).select("number", F.round(F.radians(s) * angles.ARCSEC_PER_RADIAN, 6).alias("sep_arcsec"))


@query(
    "modified_julian_date__G6",
    """with t as (select event_id, epoch_us(ts)/86400e6+40587 as mjd from events)
select event_id, round(mjd,8) as mjd,
 strftime(make_timestamp(cast(round_even((mjd-40587)*86400e3,0) as bigint)*1000),'%Y-%m-%dT%H:%M:%S') as iso from t""",
)
def modified_julian_date(spark, d):
    e = table_of(spark, "events", d).withColumn("m", timeconv.to_mjd("ts"))
    return e.select("event_id", F.round("m", 8).alias("mjd"), timeconv.from_mjd("m").alias("iso"))


@query(
    "vega_to_ab__G7",
    using("sources", ctes="""t as (select number, class_star/10 as b_v, mag_auto+30 as bmag_vega, mag_auto+29.5e0 as vmag_vega,
  mag_auto+29e0 as r_mag, mag_auto+28.5e0+fwhm_image/10 as i_mag from sources)""") + """
select number, round(b_v-0.11e0,9) as b_v_ab, round(bmag_vega-0.09e0-0.27e0*(b_v-0.11e0),9) as bmag, round(vmag_vega+0.02e0,9) as vmag,
 round(r_mag-0.0576e0-0.3718e0*(r_mag-i_mag-0.2589e0),9) as rmag, round(i_mag,9) as imag from t""",
)
def vega_to_ab(spark, d):
    s = view(spark, "sources", d).select(
        "number", (F.col("class_star") / 10).alias("b_v"), (F.col("mag_auto") + 30).alias("bmag_vega"),
        (F.col("mag_auto") + 29.5).alias("vmag_vega"), (F.col("mag_auto") + 29.0).alias("r_mag"),
        (F.col("mag_auto") + 28.5 + F.col("fwhm_image") / 10).alias("i_mag"),
    )
    return photsys.vega_to_ab(s).select("number", *[F.round(c, 9).alias(c) for c in ("b_v_ab", "bmag", "vmag", "rmag", "imag")])


@query(
    "xp_to_landolt__G8",
    using("sources") + """select number, alpha_j2000 as raj2000, delta_j2000 as dej2000,
 round((mag_auto+30)-0.30e0*((mag_auto+30)-(mag_auto+29.4e0)),9) as bmag, round(mag_auto+29.4e0,9) as vmag,
 round((mag_auto+29e0)-0.04e0*((mag_auto+29.4e0)-(mag_auto+29e0)),9) as rmag, round(mag_auto+28.8e0,9) as imag from sources""",
)
def xp_to_landolt(spark, d):
    s = view(spark, "sources", d).select(
        "number", F.col("alpha_j2000").alias("ra"), F.col("delta_j2000").alias("dec"), (F.col("mag_auto") + 30).alias("xp_b"),
        (F.col("mag_auto") + 29.4).alias("xp_v"), (F.col("mag_auto") + 29.0).alias("xp_r"), (F.col("mag_auto") + 28.8).alias("xp_i"),
    )
    return photsys.xp_to_landolt(s).select(
        "number", "raj2000", "dej2000", *[F.round(c, 9).alias(c) for c in ("bmag", "vmag", "rmag", "imag")]
    )


@query(
    "root_sum_square__G9",
    using("sources") + "select number, round(sqrt(magerr_auto*magerr_auto+0.0025e0+class_star*class_star/1e4),9) as err from sources",
)
def root_sum_square(spark, d):
    return view(spark, "sources", d).select(
        "number", F.round(photsys.rss("magerr_auto", F.lit(0.05), F.col("class_star") / 100), 9).alias("err")
    )


@query(
    "flux_ratio__G10",
    using("sources") + "select number, round_even(pow(10e0,(mag_auto+16.0003e0)/2.5e0),4) as ratio from sources",
)
def flux_ratio(spark, d):
    return view(spark, "sources", d).select("number", photsys.flux_ratio(F.col("mag_auto") + 16.0003).alias("ratio"))


@query(
    "observatory_code__G11",
    using("uploads") + """select event_id, case when label like '%CTIO%' then '807' when label like '%SSO%' then 'Q60'
 when label like '%SAAO%' then 'M22' else '500' end as code
from (select event_id, case when event_id%9=0 then name else 'x.'||site||'.fits' end as label from uploads)""",
)
def observatory_code(spark, d):
    label = F.when(F.col("event_id") % 9 == 0, F.col("name")).otherwise(F.concat(F.lit("x."), F.col("site"), F.lit(".fits")))
    return view(spark, "uploads", d).select("event_id", naming.observatory_of(label).alias("code"))


_DATE_TEXT = "strftime(date_obs,'%Y-%m-%dT%H:%M:%S')"


@query(
    "rename_convention__G12",
    using("exposures") + f"""select frame_id, 'Calib.SURVEY_'||site||'.'||field||'.'||
 replace(replace(replace(coalesce(case when frame_id%3=0 then null else {_DATE_TEXT} end, '2024-01-01T00:00:00'),'-',''),':',''),'T','-')
 ||'.'||band||'.'||cast(cast(exptime as bigint) as varchar)||'.stack.fits' as name from exposures""",
)
def rename_convention(spark, d):
    e = view(spark, "exposures", d)
    text = F.date_format("date_obs", "yyyy-MM-dd'T'HH:mm:ss")
    return e.select(
        "frame_id",
        naming.rename_convention(
            "Calib", "site", "field", F.when(F.col("frame_id") % 3 != 0, text), F.lit("2024-01-01T00:00:00"), "band", "exptime", "SURVEY"
        ).alias("name"),
    )


@query(
    "product_names__G13",
    using("chips") + f"""select frame_id, chip, 'obj_'||field||'.120-30.'||band||'.'||strftime(date_obs,'%Y%m%d')||'.'||site||'.'||serial||'.'||chip||'.scaled.fits' as scaled,
 'ToO_'||field||'.120-30.'||band||'.'||strftime(date_obs,'%Y%m%d')||'.'||site||'.'||cast(cast(exptime as bigint) as varchar)||'sec.scaled.stack.fits' as stack,
 'diff.trim_0x0.'||lpad(cast(frame_id%1000000 as varchar),6,'0')||'.sub.fits' as stamp from chips""",
)
def product_names(spark, d):
    c = view(spark, "chips", d)
    text = F.date_format("date_obs", "yyyy-MM-dd'T'HH:mm:ss")
    return c.select(
        "frame_id", "chip",
        naming.scaled_name(F.lit("obj_x"), "field", F.lit("120-30"), "band", text, "site", "serial", "chip").alias("scaled"),
        naming.stack_name("field", F.lit("120-30"), "band", F.date_format("date_obs", "yyyyMMdd"), "site", "exptime").alias("stack"),
        naming.stamp_name(F.lit("diff.trim_0x0.fits"), F.col("frame_id") % 1000000, F.lit("sub")).alias("stamp"),
    )


@query(
    "parse_names__S7",
    using("uploads") + """select event_id, regexp_extract(name,'^(kmt[asc])\\.(\\d{8})\\.(\\d{6})\\.fits$',1) as site,
 regexp_extract(name,'^(kmt[asc])\\.(\\d{8})\\.(\\d{6})\\.fits$',2) as date,
 regexp_extract(name,'^(kmt[asc])\\.(\\d{8})\\.(\\d{6})\\.fits$',3) as serial
from (select event_id, case when event_id%10=0 then name||'.tmp' else name end as name from uploads)
where regexp_matches(name,'^(kmt[asc])\\.(\\d{8})\\.(\\d{6})\\.fits$')""",
)
def parse_names(spark, d):
    u = view(spark, "uploads", d).select(
        "event_id", F.when(F.col("event_id") % 10 == 0, F.concat("name", F.lit(".tmp"))).otherwise(F.col("name")).alias("name")
    )
    return naming.parse_name(u, "raw").drop("name")


@query(
    "chip_pointing__G14",
    using("chips") + """select frame_id, chip, round(ra/15+case when chip in ('mm','nn') then 0.03333e0 else -0.03333e0 end,8) as ra_hour,
 round(dec+case when chip in ('mm','kk') then 0.5e0 else -0.5e0 end,8) as chip_dec, 4600e0 as crpix1, -0.00011e0 as cd1_1, round(ra,8) as crval1 from chips""",
)
def chip_pointing(spark, d):
    c = view(spark, "chips", d).withColumn("p", naming.chip_pointing("ra", "dec", "chip"))
    return c.select(
        "frame_id", "chip", F.round("p.chip_ra_hour", 8).alias("ra_hour"), F.round("p.chip_dec", 8).alias("chip_dec"),
        "p.crpix1", "p.cd1_1", F.round("p.crval1", 8).alias("crval1"),
    )


@query(
    "photometric_reference__G16",
    using("exposures") + """select frame_id, band, case when band='I' then 'SMSS DR3' else 'APASS DR9' end as photref from exposures""",
)
def photometric_reference(spark, d):
    return view(spark, "exposures", d).select("frame_id", "band", naming.phot_reference("band").alias("photref"))


@query(
    "seeing_default__G17",
    using("exposures") + """select frame_id, round(coalesce(case when qaresult then fwhm end, 2e0),9) as seeing,
 coalesce(case when band='B' then 29e0 end, 30e0) as zp from exposures""",
)
def seeing_default(spark, d):
    return view(spark, "exposures", d).select(
        "frame_id", F.round(naming.seeing_or_default(F.when(F.col("qaresult"), F.col("fwhm"))), 9).alias("seeing"),
        naming.zero_point_or_default(F.when(F.col("band") == "B", F.lit(29.0))).alias("zp"),
    )


@query(
    "serial_and_site_letter__G18",
    using("uploads") + "select event_id, substr(name,15,6) as serial, substr(name,4,1) as letter from uploads",
)
def serial_and_site_letter(spark, d):
    return view(spark, "uploads", d).select(
        "event_id", naming.serial_of("name").alias("serial"), naming.site_letter_of("name").alias("letter")
    )


@query(
    "band_order__O1",
    using("exposures") + """select band, case band when 'B' then 1 when 'V' then 2 when 'R' then 3 else 4 end as ord, count(*) as n
from exposures group by band order by ord""",
)
def band_order(spark, d):
    g = view(spark, "exposures", d).groupBy("band").agg(F.count("*").alias("n"))
    return g.select("band", naming.band_order("band").cast("int").alias("ord"), "n").orderBy("ord")


@query("name_sorted__O2", using("uploads") + "select name, size from uploads order by name, size")
def name_sorted(spark, d):
    return view(spark, "uploads", d).select("name", "size").orderBy("name", "size")


# --- selections --------------------------------------------------------------

_MATCHED = match("m", "sources", "refcat", 2.0, "ref_id", ["rmag", "e_rmag"])
_MATCH_VIEWS = ("sources", "refcat")


def matched(spark, d, right_cols=("rmag", "e_rmag"), where=None, **kw):
    """Sources (those that pass ``where``) with their star; what later steps read of the star is ``right_cols``."""
    from skyflow.operators.match import sky_match

    s = view(spark, "sources", d)
    return sky_match(s if where is None else s.where(where), view(spark, "refcat", d), 2.0, right_cols=right_cols, **kw)


def zp_matched(spark, d):
    """Matches of the sources that can be zero-point stars: cuts of a source hold before its match as well as after it."""
    cuts = selection.zp_star_cuts("rmag", "e_rmag", "magerr_auto")
    return matched(spark, d, where=cuts["flag"] & cuts["err"])


@query(
    "zero_point_stars__P1",
    using(*_MATCH_VIEWS, ctes=_MATCHED) + """select number, chip, ref_id, round(ref_rmag,9) as ref_rmag from m
where flags<=0 and ref_rmag<17 and ref_rmag>14 and ref_e_rmag<0.05e0 and magerr_auto<0.1e0""",
)
def zero_point_stars(spark, d):
    return selection.select_zp_stars(zp_matched(spark, d), "ref_rmag", "ref_e_rmag", "magerr_auto").select(
        "number", "chip", "ref_id", F.round("ref_rmag", 9).alias("ref_rmag")
    )


@query(
    "zero_point_star_report__P1",
    using(*_MATCH_VIEWS, ctes=_MATCHED) + """select chip, count(*) as n_all, count(*) filter (where flags<=0) as n_flag,
 count(*) filter (where ref_rmag<17 and ref_rmag>14 and ref_e_rmag<0.05e0) as n_ref, count(*) filter (where magerr_auto<0.1e0) as n_err,
 count(*) filter (where flags<=0 and ref_rmag<17 and ref_rmag>14 and ref_e_rmag<0.05e0 and magerr_auto<0.1e0) as n_pass from m group by chip""",
)
def zero_point_star_report(spark, d):
    return selection.zp_star_report(matched(spark, d), ["chip"], "ref_rmag", "ref_e_rmag", "magerr_auto")


@query(
    "drop_incomplete__P2",
    using("sources") + """select number, rmag from (select number, case when flags=0 then null else mag_auto end as rmag,
 case when l_suppkey%7=0 then null else l_suppkey end as s from sources) where rmag is not null and s is not null""",
)
def drop_incomplete(spark, d):
    s = view(spark, "sources", d).select(
        "number", F.when(F.col("flags") != 0, F.col("mag_auto")).alias("rmag"), F.when(F.col("l_suppkey") % 7 != 0, F.col("l_suppkey")).alias("s")
    )
    return selection.drop_incomplete(s).select("number", "rmag")


@query(
    "clean_sources__P3",
    using("candidates") + """select number, round((3.5e0+class_star)*fwhm_image,9) as kron_radius_a from candidates where flags=0 and imaflags_iso=0""",
)
def clean_sources(spark, d):
    c = view(spark, "candidates", d).withColumns({"kron_radius": F.col("class_star") + 3.5, "a_image": F.col("fwhm_image")})
    return selection.clean_sources(c).select("number", F.round("kron_radius_a", 9).alias("kron_radius_a"))


@query(
    "fwhm_sample__P4",
    using("sources") + "select number, chip, round(fwhm_image,9) as fwhm_image from sources where mag_auto<>99 and magerr_auto<=0.005e0 and flags=0 and fwhm_image<=30",
)
def fwhm_sample(spark, d):
    return selection.fwhm_sample(view(spark, "sources", d)).select("number", "chip", F.round("fwhm_image", 9).alias("fwhm_image"))


@query(
    "elongation_sample__P4",
    using("sources") + "select number, chip, round(elongation,9) as elongation from sources where mag_auto<>99 and magerr_auto<=0.005e0 and abs(theta_image)<88",
)
def elongation_sample(spark, d):
    return selection.elong_sample(view(spark, "sources", d)).select("number", "chip", F.round("elongation", 9).alias("elongation"))


@query(
    "zero_point_sample__P5",
    using(*_MATCH_VIEWS, ctes=_MATCHED + """,
 a as (select *, cast(floor(x_image/1152) as int) as amp from m), md as (select chip, amp, median(class_star) as mid from a group by chip, amp)""")
    + "select number, chip, amp from a join md using (chip, amp) where mag_auto<>99 and flags<4 and ref_rmag is not null and class_star>mid",
)
def zero_point_sample(spark, d):
    m = selection.amp_of(matched(spark, d, ["rmag"])).select("number", "chip", "amp", "mag_auto", "flags", "class_star", "ref_rmag")
    m = stored(m, "matched")  # for the median and the sample
    return selection.zp_sample(m, ["chip", "amp"], "ref_rmag").select("number", "chip", "amp")


@query(
    "subtraction_stars__P6",
    using("sources") + """select number from (select number, flags, class_star, mag_auto+31 as mag_auto from sources)
where flags=0 and class_star>0.8e0 and mag_auto>14 and mag_auto<20""",
)
def subtraction_stars(spark, d):
    s = view(spark, "sources", d).select(
        "number", "flags", "class_star", (F.col("mag_auto") + 31).alias("mag_auto")
    )
    return selection.subtraction_stars(s).select("number")


@query(
    "seeing_sample__P7",
    using("sources", ctes="md as (select chip, median(class_star) as mid from sources group by chip)") +
    "select number, chip from sources join md using (chip) where class_star>mid and flags=0 and magerr_auto<0.05e0",
)
def seeing_sample(spark, d):
    return selection.seeing_sample(view(spark, "sources", d), ["chip"]).select("number", "chip")


@query(
    "section_coordinates__P8",
    using("sources") + """select number, cast(floor(x/2304) as bigint) as sect_x, cast(floor(y/2308) as bigint) as sect_y,
 round(x-floor(x/2304)*2304,9) as x_sect, round(y-floor(y/2308)*2308,9) as y_sect
from (select number, x_image-0.5e0 as x, y_image-0.5e0 as y from sources) where x>floor(x/2304)*2304 and y>floor(y/2308)*2308""",
)
def section_coordinates(spark, d):
    s = view(spark, "sources", d).select("number", (F.col("x_image") - 0.5).alias("x_image"), (F.col("y_image") - 0.5).alias("y_image"))
    return selection.section(s, 2304, 2308).select(
        "number", "sect_x", "sect_y", F.round("x_sect", 9).alias("x_sect"), F.round("y_sect", 9).alias("y_sect")
    )


@query(
    "amplifier_of__P9",
    using("sources") + """select number, cast(floor(x/1152) as int) as amp from (select number, x_image-0.5e0 as x from sources)
where x>floor(x/1152)*1152""",
)
def amplifier_of(spark, d):
    s = view(spark, "sources", d).select("number", (F.col("x_image") - 0.5).alias("x_image"))
    return selection.amp_of(s).select("number", "amp")


@query(
    "candidate_columns__P10",
    using("candidates", ctes="md as (select chip, median(fwhm_image*0.4e0) as seeing, median(ellipticity) as me, median(elongation) as ml from candidates group by chip)")
    + """select number, round(1/(magerr_auto+0.0001e0),5) as snr, round(mag_auto+30,9) as mag_cal, round(fwhm_world*3600/seeing,9) as ratio_seeing,
 round(ellipticity/me,9) as ratio_ellipticity, round(elongation/ml,9) as ratio_elongation from candidates join md using (chip)""",
)
def candidate_columns(spark, d):
    from skyflow.operators.vetting import image_stats

    c = view(spark, "candidates", d)
    out = selection.candidate_columns(c.join(image_stats(c, ["chip"]), "chip"))
    return out.select(
        "number", F.round("snr", 5).alias("snr"),
        *[F.round(x, 9).alias(x) for x in ("mag_cal", "ratio_seeing", "ratio_ellipticity", "ratio_elongation")],
    )


@query(
    "apply_zero_point__P11",
    using("sources", ctes="zp as (select chip, avg(mag_auto)+45.1234e0 as zp, stddev_pop(mag_auto)/10 as zper from sources group by chip)")
    + """select number, round(least(mag_auto*case when flags=0 then -9 else 1 end+round_even(zp,3),99),9) as mag_auto,
 round(sqrt(magerr_auto*magerr_auto+pow(round_even(zper,3),2)),9) as magerr_auto from sources join zp using (chip)""",
)
def apply_zero_point(spark, d):
    s = view(spark, "sources", d)
    zp = s.groupBy("chip").agg((F.avg("mag_auto") + 45.1234).alias("zp"), (F.stddev_pop("mag_auto") / 10).alias("zper"))
    flipped = s.withColumn("mag_auto", F.col("mag_auto") * F.when(F.col("flags") == 0, -9).otherwise(1))
    return selection.apply_zp(flipped, zp, ["chip"]).select(
        "number", F.round("mag_auto", 9).alias("mag_auto"), F.round("magerr_auto", 9).alias("magerr_auto")
    )


@query("invert_image__P12", using("pixels") + "select frame_id, x, y, round(-value,9) as value from pixels")
def invert_image(spark, d):
    from skyflow.operators.pixels import invert

    return invert(view(spark, "pixels", d)).select("frame_id", "x", "y", F.round("value", 9).alias("value"))


@query(
    "cone_search__P13",
    using("sources") + f"select number, round(alpha_j2000,8) as ra from sources where {sep('alpha_j2000', 'delta_j2000', '121.5e0', '-29.5e0')} < 1080",
)
def cone_search(spark, d):
    return cells.cone_search(view(spark, "sources", d), 121.5, -29.5, 0.3, "alpha_j2000", "delta_j2000").select(
        "number", F.round("alpha_j2000", 8).alias("ra")
    )


@query(
    "box_search__P14",
    using("sources") + """select number from sources where delta_j2000 between -29.7e0 and -29.3e0
 and alpha_j2000 between 121.5e0-0.2e0/cos(radians(-29.5e0)) and 121.5e0+0.2e0/cos(radians(-29.5e0))""",
)
def box_search(spark, d):
    return cells.box_search(view(spark, "sources", d), 121.5, -29.5, 0.4, "alpha_j2000", "delta_j2000").select("number")


# --- sets and windows --------------------------------------------------------


@query(
    "concatenate_logs__U1",
    using("uploads") + """select 'complete' as process, date, count(*) as frames from uploads where size>1000 group by date
union all select 'short' as process, date, count(*) as frames from uploads where size<=1000 group by date""",
)
def concatenate_logs(spark, d):
    u = view(spark, "uploads", d)
    a = u.where("size > 1000").groupBy("date").agg(F.count("*").alias("frames")).withColumn("process", F.lit("complete"))
    b = u.where("size <= 1000").groupBy("date").agg(F.count("*").alias("frames")).withColumn("process", F.lit("short"))
    return a.unionByName(b)


@query(
    "distinct_sets__U3",
    using("exposures") + "select distinct field, band, site from exposures",
)
def distinct_sets(spark, d):
    return view(spark, "exposures", d).select("field", "band", "site").distinct()


@query(
    "name_set_difference__U4",
    using("uploads") + """select distinct label from (select case event_id%3 when 0 then 'x.mask.' when 1 then 'x.crmap.' else 'x.scaled.' end||name as label from uploads)
where not regexp_matches(label,'mask|crmap')""",
)
def name_set_difference(spark, d):
    kind = F.when(F.col("event_id") % 3 == 0, "x.mask.").when(F.col("event_id") % 3 == 1, "x.crmap.").otherwise("x.scaled.")
    u = view(spark, "uploads", d).select(F.concat(kind, "name").alias("label"))
    return u.where(~F.col("label").rlike("mask|crmap")).distinct()


@query(
    "run_time_since_start__W5",
    """select event_type, date, max(sec) as elapsed from (select event_type, strftime(ts,'%Y%m%d') as date,
 round((epoch_us(ts)-min(epoch_us(ts)) over (partition by strftime(ts,'%Y%m%d')))/1e6,3) as sec from events) group by event_type, date""",
)
def run_time_since_start(spark, d):
    e = table_of(spark, "events", d).select("event_type", F.date_format("ts", "yyyyMMdd").alias("date"), F.unix_micros(F.col("ts").cast("timestamp")).alias("t"))
    per = e.groupBy("date", "event_type").agg(F.max("t").alias("t1"), F.min("t").alias("t0"))
    start = F.min("t0").over(Window.partitionBy("date"))
    return per.select("event_type", "date", F.round((F.col("t1") - start) / 1e6, 3).alias("elapsed"))


@query(
    "exact_median__A3",
    using("sources") + "select chip, flags, round(median(mag_auto),9) as median from sources group by chip, flags",
)
def exact_median(spark, d):
    return clip.exact_median(view(spark, "sources", d), ["chip", "flags"], "mag_auto").withColumn("median", F.round("median", 9))


@query(
    "linear_trend__A15",
    using("refcat", ctes="t as (select s.chip, cast(floor(s.x_image/1152) as int) as amp, s.y_image, s.mag_auto-r.rmag as d from sources s join refcat r on s.number=r.ref_id)")
    + """select chip, amp, count(*) as n, round(regr_slope(d,y_image),9) as slope, round(regr_intercept(d,y_image),6) as intercept,
 round(regr_r2(d,y_image),6) as r2 from t group by chip, amp""",
)
def linear_trend(spark, d):
    s = view(spark, "sources", d)
    j = selection.amp_of(s).join(view(spark, "refcat", d).select(F.col("ref_id").alias("number"), "rmag"), "number")
    t = photometry.linear_trend(j.withColumn("dm", F.col("mag_auto") - F.col("rmag")), ["chip", "amp"], "y_image", "dm")
    return t.select("chip", "amp", "n", F.round("slope", 9).alias("slope"), F.round("intercept", 6).alias("intercept"), F.round("r2", 6).alias("r2"))
