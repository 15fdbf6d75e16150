"""Pixel operators on detector rows of 8 amplifiers x 8 columns, 125 rows per frame."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyflow.functions.wcs import tan_struct
from skyflow.operators import masks as mk, pixels as px, resample as rs, stacking as st, strips as sp
from workload.sqlkit import clip as clip_sql, match, query, using
from workload.views import table_of, view

K = ["frame_id"]
WIDTH, HEIGHT, HOT = 8, 125, 380.0


def _long(strips, keys=K):
    out = px.strips_to_pixels(strips, keys, WIDTH)
    return out.select(*keys, "x", "y", F.round("value", 5).alias("value"))


def _to_tan(ra: str, dec: str, ra0: str, dec0: str) -> tuple[str, str]:
    """Tangent-plane coordinates (degrees) of a sky position, in SQL."""
    d, d0, da = f"radians({dec})", f"radians({dec0})", f"radians(({ra})-({ra0}))"
    cosc = f"(sin({d})*sin({d0})+cos({d})*cos({d0})*cos({da}))"
    return f"degrees(cos({d})*sin({da})/{cosc})", f"degrees((sin({d})*cos({d0})-cos({d})*sin({d0})*cos({da}))/{cosc})"


def _to_sky(xi: str, eta: str, ra0: str, dec0: str) -> tuple[str, str]:
    """Sky position (degrees) of tangent-plane coordinates in degrees, in SQL."""
    x, e, d0 = f"radians({xi})", f"radians({eta})", f"radians({dec0})"
    depth = f"(cos({d0})-{e}*sin({d0}))"
    return (
        f"({ra0})+degrees(atan2({x},{depth}))",
        f"degrees(atan2(sin({d0})+{e}*cos({d0}),sqrt({x}*{x}+{depth}*{depth})))",
    )


@query(
    "assemble_chip__X1",
    using("pixels", ctes="r as (select frame_id//4 as exposure, frame_id%4*8+amp+1 as ext, x%8 as lx, y, value from pixels)")
    + """select exposure, case (ext-1)//8 when 0 then 'mm' when 1 then 'kk' when 2 then 'nn' else 'tt' end as chip,
 cast((ext-1)%8*8+lx as int) as x, y, round(value,5) as value from r""",
)
def assemble_chip(spark, d):
    s = view(spark, "strips", d)
    raw = s.select(F.expr("frame_id div 4").alias("exposure"), (F.col("frame_id") % 4 * 8 + F.col("amp") + 1).cast("int").alias("ext"), "y", "values")
    return _long(px.assemble_chip(raw), ["exposure", "chip"])


_AMP = """am as (select frame_id, amp, median(value) as m from pixels group by frame_id, amp), cm as (select frame_id, median(m) as c from am group by frame_id)"""


@query(
    "level_amplifiers__X2",
    using("pixels", ctes=_AMP) + "select frame_id, x, y, round(value-(m-c),5) as value from pixels join am using (frame_id, amp) join cm using (frame_id)",
)
def level_amplifiers(spark, d):
    return _long(px.level_amps(view(spark, "strips", d), K))


@query("chip_sky__A3", using("pixels") + "select frame_id, round(median(value),6) as sky from pixels group by frame_id")
def chip_sky(spark, d):
    return px.chip_sky(view(spark, "pixels", d), K).withColumn("sky", F.round("sky", 6))


@query(
    "pattern_noise__X4",
    using("pixels", ctes="""f as (select *, case when amp<4 then 7-x%8 else x%8 end as fx from pixels),
 pt as (select frame_id, fx, y, median(value) as p from f group by frame_id, fx, y)""")
    + "select frame_id, x, y, round(case when frame_id%2=0 then value-p else value end,5) as value, round(p,5) as pattern from f join pt using (frame_id, fx, y)",
)
def pattern_noise(spark, d):
    s = px.pattern_noise(view(spark, "strips", d), K, WIDTH, subtract_if=F.col("frame_id") % 2 == 0)
    both = s.select("frame_id", "amp", "y", F.posexplode(F.arrays_zip("values", "pattern")).alias("i", "p"))
    return both.select(
        "frame_id", (F.col("amp") * WIDTH + F.col("i")).cast("int").alias("x"), "y",
        F.round("p.values", 5).alias("value"), F.round("p.pattern", 5).alias("pattern"),
    )


# (victim, aggressor, mirrored) written out, amplifiers 1..8
_PAIRS = """pairs(dst,src,flip) as (values
 (1,1,0),(1,3,0),(1,5,1),(2,2,0),(2,4,0),(2,6,1),(3,1,0),(3,3,0),(3,5,1),(3,7,1),(4,2,0),(4,4,0),(4,6,1),(4,8,1),
 (5,1,1),(5,3,1),(5,5,0),(5,7,0),(6,2,1),(6,4,1),(6,6,0),(6,8,0),(7,3,1),(7,5,0),(7,7,0),(8,4,1),(8,6,0),(8,8,0)),
 talk as (select frame_id, cast((dst-1)*8+case when flip=1 then 7-x%8 else x%8 end as int) as x, y, count(*) as code
  from pixels join pairs on src=amp+1 where value>380 and not (frame_id%4=2 and dst=7) group by all
  union all select frame_id, cast(48+i as int), cast(j as int), 4 from (select distinct frame_id from pixels where frame_id%4=2), range(8) a(i), range(125) b(j))"""


def _talk(spark, d):
    p = view(spark, "pixels", d)
    dead = p.select("frame_id").distinct().where(F.col("frame_id") % 4 == 2)
    return px.crosstalk_mask(p, K, HOT, WIDTH, dead=dead, height=HEIGHT)


@query("crosstalk_mask__X5", using("pixels", ctes=_PAIRS) + "select frame_id, x, y, code from talk")
def crosstalk_mask(spark, d):
    return _talk(spark, d)


@query("crosstalk_spans__X5", using("pixels", ctes=_PAIRS) + "select frame_id, x, y, code from talk")
def crosstalk_spans(spark, d):
    """The same from the saturated runs of strips; pixels appear only to be compared."""
    strips = view(spark, "strips", d)
    dead = strips.select("frame_id").distinct().where(F.col("frame_id") % 4 == 2)
    hot = mk.spans_of_strips(strips, K, lambda v: v > HOT, width=WIDTH)
    return mk.span_pixels(mk.crosstalk_spans(hot, K, WIDTH, dead=dead, height=HEIGHT), K)


# a column runs away from its amplifier; a trail ends where enough pixels in a row are dim again
_TRAILS = clip_sql("bc", "pixels", ["frame_id"], "value", 3.0, 5) + f""",
 bm as (select frame_id, median(v) as med, stddev_pop(v) as sig from bc group by frame_id),
 bl as materialized (select frame_id, x, case when {{down_p}} then {HEIGHT - 1}-y else y end as r, value as v, med, value<=med+{px.BLEED_SIGMA}*sig as dim from pixels join bm using (frame_id)),
 bw as materialized (select *, sum(v) over (partition by frame_id, x order by r) as cum,
  sum(cast(dim as int)) over (partition by frame_id, x order by r rows between {px.BLEED_STOP - 1} preceding and current row) as n_dim from bl),
 bs as (select h.frame_id, h.x, h.r as s from (select *, least(r+{px.BLEED_NEAR},{HEIGHT - 1}) as a, least(r+{px.BLEED_FAR},{HEIGHT - 1}) as b from bl where v>{HOT}) h
  join bw wa on wa.frame_id=h.frame_id and wa.x=h.x and wa.r=h.a join bw wb on wb.frame_id=h.frame_id and wb.x=h.x and wb.r=h.b
  where h.a<h.b and wb.cum-wa.cum+wa.v-h.med*(h.b-h.a+1)>100),
 be as (select bs.frame_id, bs.x, s, coalesce(min(w.r)+1-{px.BLEED_STOP},{HEIGHT}) as e from bs
  left join bw w on w.frame_id=bs.frame_id and w.x=bs.x and w.r-{px.BLEED_STOP}+1>=s and w.n_dim={px.BLEED_STOP} group by bs.frame_id, bs.x, s),
 trails as (select distinct bl.frame_id, bl.x, cast(case when {{down}} then {HEIGHT - 1}-r else r end as int) as y, 8 as code from bl join be on bl.frame_id=be.frame_id and bl.x=be.x and r>=s and r<e)"""


def trails_sql(down: str) -> str:
    """``down`` is a condition on ``{t}.frame_id``."""
    return _TRAILS.replace("{down_p}", down.format(t="pixels")).replace("{down}", down.format(t="bl"))


@query("bleed_mask__X6", using("pixels", ctes=trails_sql("{t}.frame_id%2=0")) + "select frame_id, x, y, code from trails")
def bleed_mask(spark, d):
    return px.bleed_mask(view(spark, "pixels", d), K, F.col("frame_id") % 2 == 0, limit=HOT, excess=100.0)


_MESH = """pm as (select frame_id, x//16 as mx, y//16 as my, value from pixels),
 """ + clip_sql("c", "pm", ["frame_id", "mx", "my"], "value", 3.0, 5) + """,
 raw as (select frame_id, mx, my, median(v) as raw from c group by all),
 bg as (select a.frame_id, a.mx, a.my, median(b.raw) as background from raw a join raw b on a.frame_id=b.frame_id and abs(a.mx-b.mx)<=1 and abs(a.my-b.my)<=1 group by all)"""


@query(
    "background_map__X7",
    using("pixels", ctes=_MESH) + "select frame_id, x, y, round(value-background,5) as value from (select *, x//16 as mx, y//16 as my from pixels) join bg using (frame_id, mx, my)",
)
def background_map(spark, d):
    s = view(spark, "strips", d)
    return _long(sp.subtract_background(s, sp.background_map(s, K, 16, WIDTH), K, 16, WIDTH))


_FITS = """fit as (select frame_id, amp, regr_slope(value,y)/1000 as slope, -30+avg(value)/1000 as intercept, amp=3 as bad from pixels group by frame_id, amp)"""


def _fits(spark, d):
    return view(spark, "pixels", d).groupBy("frame_id", "amp").agg(
        (F.regr_slope("value", "y") / 1000).alias("slope"), (F.avg("value") / 1000 - 30).alias("intercept")
    ).withColumn("bad", F.col("amp") == 3)


@query(
    "scale_zero_point__X8",
    using("pixels", ctes=_FITS) + """select frame_id, x, y, round(value*case when bad then 1 else round_even(pow(10e0,(30+slope*y+intercept)/2.5e0),4) end,5) as value
from pixels join fit using (frame_id, amp)""",
)
def scale_zero_point(spark, d):
    return _long(px.scale_zero_point(view(spark, "strips", d), _fits(spark, d), K))


@query(
    "scaled_saturation__G15",
    using("pixels", ctes=_FITS) + """select frame_id, round(60000*median(case when bad then 1 else round_even(pow(10e0,(30+slope*y+intercept)/2.5e0),4) end),5) as saturate
from fit, range(125) t(y) group by frame_id""",
)
def scaled_saturation(spark, d):
    return px.scaled_saturation(_fits(spark, d), K, HEIGHT).withColumn("saturate", F.round("saturate", 5))


_BPM = """bpm as (select frame_id, x, y, 16 as code from pixels where value<60),
 fr as (select distinct frame_id, case frame_id%3 when 0 then '00000000' when 1 then '01000010' else '11100000' end as badamp from pixels),
 bad as (select frame_id, i as a from fr, range(8) t(i) where substr(badamp,cast(i+1 as int),1)='1'),
 upd as (select frame_id, x, y, sum(code) as code from (
  select t.frame_id, x, y, code from talk t anti join bad b on t.frame_id=b.frame_id and t.x//8=b.a
  union all select frame_id, a*8+i, j, 4 from bad, range(8) p(i), range(125) q(j) union all select * from bpm) group by all)"""


def _updated(spark, d):
    p = view(spark, "pixels", d)
    bpm = p.where("value < 60").select("frame_id", "x", "y", F.lit(16).alias("code"))
    code = F.when(F.col("frame_id") % 3 == 0, "00000000").when(F.col("frame_id") % 3 == 1, "01000010").otherwise("11100000")
    frames = p.select("frame_id").distinct().withColumn("badamp", code)
    return px.update_bad_pixel_mask(_talk(spark, d), bpm, frames, K, WIDTH, HEIGHT)


@query(
    "update_bad_pixel_mask__X9",
    using("pixels", ctes=_PAIRS + ",\n" + _BPM) + "select frame_id, cast(x as int) as x, cast(y as int) as y, cast(code as bigint) as code from upd where code<>0",
)
def update_bad_pixel_mask(spark, d):
    return _updated(spark, d)[0]


@query(
    "bad_amp_photqa__X9",
    using("pixels", ctes=_PAIRS + ",\n" + _BPM) + "select frame_id, length(replace(badamp,'0',''))::int as n_bad_amps, length(replace(badamp,'0',''))<3 as photqa from fr",
)
def bad_amp_photqa(spark, d):
    return _updated(spark, d)[1]


@query(
    "combine_masks__J8",
    using("pixels", ctes="""m as (select frame_id, x, y, 1 as code from pixels where value>300 union all select frame_id-1, x, y, 2 from pixels where value>320
 union all select frame_id, x, y, 16 from pixels where value<60 union all select frame_id, x, y, 1 from pixels where round(value,0)=200)""")
    + "select frame_id, x, y, cast(sum(code) as bigint) as code from m group by frame_id, x, y",
)
def combine_masks(spark, d):
    p = view(spark, "pixels", d)

    def mask(df, code):
        return df.select("frame_id", "x", "y", F.lit(code).alias("code"))

    zero = px.zero_pixels(p.withColumn("value", F.round("value", 0) - 200), K)
    return px.combine_masks(
        [mask(p.where("value > 300"), 1), mask(p.where("value > 320").withColumn("frame_id", F.col("frame_id") - 1), 2), mask(p.where("value < 60"), 16), zero], K
    )


def _coadd_sql() -> str:
    scale, center = "(0.4e0/3600)", ("121.0e0", "-30.0e0")
    own = tuple(f"({c}+frame_id*{scale})" for c in center)
    ra, dec = _to_sky(f"(-x*{scale})", f"(y*{scale})", *own)
    xi, eta = _to_tan("ra", "dec", *center)
    return using("pixels", ctes=f"""sky as (select value, {ra} as ra, {dec} as dec from pixels),
 g as (select value, cast(floor(-({xi})/{scale}+0.5e0) as int) as x, cast(floor(({eta})/{scale}+0.5e0) as int) as y from sky)""") + (
        "select 1 as stack_id, x, y, round(avg(value),6) as value, count(*) as n from g group by x, y"
    )


@query("coadd__X10", _coadd_sql())
def coadd(spark, d):
    p = view(spark, "pixels", d)
    frames = p.select("frame_id").distinct()
    shift = F.col("frame_id") * (0.4 / 3600)
    wcs = frames.select(
        "frame_id", F.lit(1).alias("stack_id"), tan_struct(F.lit(121.0) + shift, F.lit(-30.0) + shift, 0.4 / 3600).alias("wcs")
    )
    return st.coadd(p, wcs, K, ["stack_id"], F.lit(121.0), F.lit(-30.0)).withColumn("value", F.round("value", 6))


@query("stack_strips__X10", _coadd_sql())
def stack_strips(spark, d):
    """The same stack from strips, without a row per pixel until it is compared."""
    s = view(spark, "strips", d)
    shift = F.col("frame_id") * (0.4 / 3600)
    wcs = s.select("frame_id").distinct().withColumns(
        {"stack_id": F.lit(1), "wcs": tan_struct(F.lit(121.0) + shift, F.lit(-30.0) + shift, 0.4 / 3600)})
    spans = rs.stack_strips(s, wcs, K, ["stack_id"], F.lit(121.0), F.lit(-30.0), width=WIDTH)
    return rs.span_pixels(spans, ["stack_id"]).withColumns({"value": F.round("value", 6), "n": F.col("n").cast("long")})


@query("median_stack__X10", _coadd_sql().replace("avg(value)", "median(value)"))
def median_stack(spark, d):
    s = view(spark, "strips", d)
    shift = F.col("frame_id") * (0.4 / 3600)
    wcs = s.select("frame_id").distinct().withColumns(
        {"stack_id": F.lit(1), "wcs": tan_struct(F.lit(121.0) + shift, F.lit(-30.0) + shift, 0.4 / 3600)})
    spans = rs.stack_strips(s, wcs, K, ["stack_id"], F.lit(121.0), F.lit(-30.0), combine="median", width=WIDTH)
    return rs.span_pixels(spans, ["stack_id"]).withColumns({"value": F.round("value", 6), "n": F.col("n").cast("long")})


@query(
    "tile_image__X12",
    using("pixels") + """select frame_id, x, y, cast(least(x//16,3)*4+least(y//31,3) as int) as tile, cast(x-16*least(x//16,3) as int) as x_tile, cast(y-31*least(y//31,3) as int) as y_tile from pixels""",
)
def tile_image(spark, d):
    t = sp.tile_strips(view(spark, "strips", d), 64, 125, 4, 4, WIDTH)
    t = t.select("frame_id", "sect_x", "y", "tile", "x_tile", "y_tile", F.posexplode("values").alias("i", "value"))
    x_tile = F.col("x_tile") + F.col("i")
    return t.select("frame_id", (F.col("sect_x") * 16 + x_tile).alias("x"), "y", "tile", x_tile.alias("x_tile"), "y_tile")


@query(
    "difference_image__X13",
    using("pixels") + """select s.frame_id, s.x, s.y, round(case when r.value is null or r.value>380 then 1e-30 else s.value-r.value end,5) as value
from pixels s left join pixels r on s.frame_id=r.frame_id-1 and s.x=r.x and s.y=r.y""",
)
def difference_image(spark, d):
    shift = {"frame_id": F.col("frame_id") - 1}
    mask = view(spark, "pixels", d).where(F.col("value") > HOT).withColumns(shift).select("frame_id", "x", "y", F.lit(1).alias("code"))
    s = view(spark, "strips", d)
    return _long(sp.difference(s, s.withColumns(shift), mask, K, WIDTH))


@query(
    "convolution_side__X14",
    using("exposures") + """select frame_id, coalesce(ref_fwhm>sci_fwhm,false) as inverted, case when ref_fwhm>sci_fwhm then 'science' else 'reference' end as convolved
from (select frame_id, fwhm as sci_fwhm, case when qaresult then 2.5e0+frame_id%3 end as ref_fwhm from exposures)""",
)
def convolution_side(spark, d):
    e = view(spark, "exposures", d).select(
        "frame_id", F.col("fwhm").alias("sci_fwhm"), F.when(F.col("qaresult"), F.col("frame_id") % 3 + 2.5).alias("ref_fwhm")
    )
    return px.pick_convolution_side(e).select("frame_id", "inverted", "convolved")


_STAMP = """sci as (select number, chip, x_image, y_image, alpha_j2000, delta_j2000, flags, class_star, mag_auto+31 as mag_auto from sources),
 rf as (select number, chip, alpha_j2000+((l_suppkey%5)-2)*0.1e0/3600 as alpha_j2000, delta_j2000, flags, class_star, mag_auto+31 as mag_auto from sources),
 s2 as (select * from sci where flags=0 and class_star>0.8e0 and mag_auto>14 and mag_auto<20),
 r2 as (select * from rf where flags=0 and class_star>0.9e0 and mag_auto>14 and mag_auto<20),
 """ + match("m", "s2", "r2", 0.4, "number", rpos=("alpha_j2000", "delta_j2000"), keys=["chip"])


@query(
    "stamp_list__X15",
    using("sources", ctes=_STAMP) + """select chip, cast(floor(x_image/2304) as bigint) as sect_x, cast(floor(y_image/2308) as bigint) as sect_y, count(*) as n_stamps, count(*)>20 as use_list
from m group by all""",
)
def stamp_list(spark, d):
    s = view(spark, "sources", d).withColumn("mag_auto", F.col("mag_auto") + 31)
    ref = s.withColumn("alpha_j2000", F.col("alpha_j2000") + ((F.col("l_suppkey") % 5) - 2) * 0.1 / 3600)
    return px.stamp_list(s, ref, ["chip"], 2304.0, 2308.0)[1]


# candidates on the small frames
_BOXES = """cd as (select ((l_orderkey*8+l_linenumber)*1000+l_suppkey)*20000+l_partkey as number, l_suppkey%4 as frame_id,
  cast(l_partkey*37%640 as double)/10 as x_image, cast(l_orderkey*29%1250 as double)/10 as y_image, l_quantity*12 as background from lineitem),
 sg as (select frame_id, stddev_pop(background)/10 as sky_sigma from cd group by frame_id)"""


def _boxes(spark, d):
    n = table_of(spark, "lineitem", d).select(
        F.expr("((l_orderkey*8+l_linenumber)*1000+l_suppkey)*20000+l_partkey").alias("number"), F.expr("l_suppkey%4").alias("frame_id"),
        (F.expr("l_partkey*37%640") / 10.0).alias("x_image"), (F.expr("l_orderkey*29%1250") / 10.0).alias("y_image"),
        (F.col("l_quantity") * 12).alias("background"),
    )
    return n.join(n.groupBy("frame_id").agg((F.stddev_pop("background") / 10).alias("sky_sigma")), "frame_id")


def _box_pixels(spark, d):
    """Difference strips with some null values."""
    return view(spark, "strips", d).withColumn("values", F.transform("values", lambda v: F.when(v > HOT, F.lit(1e-30)).otherwise(v)))


@query(
    "pixel_stats__A13_T10_T11",
    using("pixels", ctes=_BOXES + """,
 bx as (select number, frame_id, background-25*sky_sigma as cut, cast(greatest(0,floor(x_image-3.7e0)) as int) as x0, cast(greatest(0,floor(x_image+3.7e0)) as int) as x1,
  cast(greatest(0,floor(y_image-3.7e0)) as int) as y0, cast(greatest(0,floor(y_image+3.7e0)) as int) as y1 from cd join sg using (frame_id)),
 ex as (select number, frame_id, cut, x0+i as x, y0+j as y from bx, range(9) a(i), range(9) b(j) where x0+i<x1 and y0+j<y1),
 h as (select number, count(*) as n_box, count(*) filter (where (case when value>380 then 1e-30 else value end)<cut) as n_bad, count(*) filter (where value>380) as n_null
  from ex join pixels using (frame_id, x, y) group by number)""")
    + """select number, coalesce(n_box,0) as n_box, coalesce(n_bad,0) as n_bad, coalesce(n_null,0) as n_null,
 case when n_box>0 then round(n_bad/n_box,6) else -99 end as ratio_bad, coalesce(n_bad>n_box*0.1e0,false) as flag_10, coalesce(n_null<>0,false) as flag_11 from cd left join h using (number)""",
)
def pixel_stats(spark, d):
    from skyflow.operators.vetting import flags_10_11

    c = _boxes(spark, d)
    out = flags_10_11(c, _box_pixels(spark, d), K, half=F.lit(3.7), width=WIDTH)
    return out.select("number", "n_box", "n_bad", "n_null", F.round("ratio_bad", 6).alias("ratio_bad"), "flag_10", "flag_11")


@query(
    "background_stats__A14",
    using("candidates") + "select chip, round(median(background),6) as sky_median, round(stddev_pop(background),6) as sky_sigma from candidates group by chip",
)
def background_stats(spark, d):
    from skyflow.operators.photometry import background_stats as stats

    return stats(view(spark, "candidates", d), ["chip"]).withColumns({c: F.round(c, 6) for c in ("sky_median", "sky_sigma")})


@query(
    "cutouts__X16",
    using("pixels", ctes=_BOXES + """,
 bx as (select number, frame_id, cast(floor(x_image) as int)-2 as x0, cast(floor(y_image) as int)-2 as y0 from cd),
 im as (select frame_id, 'new' as kind, x, y, value from pixels union all select frame_id, 'ref', x, y, value*2 from pixels union all select frame_id, 'sub', x, y, -value from pixels),
 ex as (select number, frame_id, kind, j*5+i as slot, x0+i as x, y0+j as y from bx, range(5) a(i), range(5) b(j), (values ('new'),('ref'),('sub')) k(kind))""")
    + """select number, kind, round(sum(coalesce(value,0)*(slot+1)),4) as checksum, count(value) as n_inside from ex left join im using (frame_id, kind, x, y)
 group by number, kind""",
)
def cutouts(spark, d):
    factor = F.when(F.col("kind") == "ref", 2).when(F.col("kind") == "sub", -1).otherwise(1)
    images = (
        view(spark, "strips", d).withColumn("kind", F.explode(F.array(F.lit("new"), F.lit("ref"), F.lit("sub"))))
        .withColumn("values", F.transform("values", lambda v: v * factor))
    )
    c = sp.cutouts(_boxes(spark, d), images, K, 5, width=WIDTH)
    weighted = F.aggregate(F.transform("stamp", lambda v, i: v * (i + 1)), F.lit(0.0), lambda a, b: a + b)
    inside = F.size(F.filter("stamp", lambda v: v != 0)).cast("long")
    return c.select("number", "kind", F.round(weighted, 4).alias("checksum"), inside.alias("n_inside"))


REF_XY = _to_tan("alpha_j2000", "delta_j2000", "121.5e0", "-29.5e0")


@query(
    "reference_coverage__X17_T12",
    using("candidates", ctes=f"""t as (select number, chip, 4600-({REF_XY[0]})/(0.4e0/3600) as x, 4600+({REF_XY[1]})/(0.4e0/3600) as y from candidates)""")
    + "select number, chip, round(x,3) as x_refim, round(y,3) as y_refim, x<0 or x>9216 or y<0 or y>9232 as flag_12 from t",
)
def reference_coverage(spark, d):
    c = view(spark, "candidates", d)
    wcs = c.select("chip").distinct().select(
        "chip", tan_struct(F.lit(121.5), F.lit(-29.5), 0.4 / 3600, 4600.0).alias("wcs"), F.lit(9216).alias("naxis1"), F.lit(9232).alias("naxis2")
    )
    return px.reference_coverage(c, wcs, ["chip"]).select("number", "chip", F.round("x_refim", 3).alias("x_refim"), F.round("y_refim", 3).alias("y_refim"), "flag_12")


def _cubic(u: str, v: str) -> str:
    """The distortion below, written out."""
    return f"({u}+1e-3*{u}*{u}-5e-4*{u}*{v}+2e-3*{v}*{v}-1e-3*{u}*{u}*{u}-1e-3*{u}*{v}*{v})"


_WORLD = _to_sky("xi", "eta", "121.5e0", "-29.5e0")


@query(
    "pixel_to_sky_and_back__G4_G5",
    using("sources", ctes=f"""p as (select number, -(0.4e0/3600)*(x_image-4600) as u, (0.4e0/3600)*(y_image-4600) as v from sources),
 t as (select number, {_cubic("u", "v")} as xi, {_cubic("v", "u")} as eta from p)""")
    # the way back has to return to the pixel it came from
    + f"select number, round({_WORLD[0]},7) as ra, round({_WORLD[1]},7) as dec, true as x_ok, true as y_ok from t",
)
def pixel_to_sky_and_back(spark, d):
    from skyflow.functions.wcs import to_pixel, to_world

    s = view(spark, "sources", d).select("number", F.col("x_image").alias("x0"), F.col("y_image").alias("y0"))
    s = s.withColumn("wcs", tan_struct(F.lit(121.5), F.lit(-29.5), 0.4 / 3600, 4600.0))
    # a mild third-order distortion
    pv = F.array(*[F.lit(v) for v in (0.0, 1.0, 0.0, 0.0, 1e-3, -5e-4, 2e-3, -1e-3, 0.0, -1e-3, 0.0, 0.0)])
    s = s.withColumn("wcs", F.col("wcs").withField("pv1", pv).withField("pv2", pv))
    out = to_pixel(to_world(s, "x0", "y0"), "ra", "dec", "wcs", "x1", "y1")
    return out.select(
        "number", F.round("ra", 7).alias("ra"), F.round("dec", 7).alias("dec"),
        (F.abs(F.col("x1") - F.col("x0")) < 1e-3).alias("x_ok"), (F.abs(F.col("y1") - F.col("y0")) < 1e-3).alias("y_ok"),
    )
