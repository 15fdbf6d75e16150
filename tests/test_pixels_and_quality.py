import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from skyflow.functions import angles, naming, timeconv, wcs as wcs_fn
from skyflow.functions.sqlfuncs import register
from skyflow.operators import photometry as ph, pixels as px, quality as qa, selection as sel, stacking as st, vetting as vt


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_scalars(spark):
    r = one(
        spark, angles.dms_to_deg(F.lit("-00:30:00")).alias("d"), angles.hms_to_deg(F.lit("12:00:00")).alias("h"),
        timeconv.to_mjd(F.lit("2024-01-01T12:00:00").cast("timestamp")).alias("m"), timeconv.from_mjd(F.lit(60310.5)).alias("t"),
        angles.deg_to_hms(F.lit(359.99999999)).alias("w"), angles.deg_to_dms(F.lit(-0.5)).alias("n"),
        naming.observatory_of(F.lit("x.SAAO.fits")).alias("o"), naming.observatory_of(F.lit("x")).alias("u"),
    )
    assert (r["d"], r["h"], r["m"], r["t"]) == (-0.5, 180.0, 60310.5, "2024-01-01T12:00:00")
    assert (r["w"], r["n"], r["o"], r["u"]) == ("00:00:00.0000", "-00:30:00.000", "M22", "500")
    register(spark)
    q = spark.sql("select sky_sep(0,0,0,1) s, hms_to_deg('01:00:00') h, to_mjd(timestamp'2024-01-01 12:00:00') m, flux_ratio(2.5) f").first()
    assert q["s"] == pytest.approx(1.0) and (q["h"], q["m"], q["f"]) == (15.0, 60310.5, 10.0)


# a made-up distortion; a round trip works with any
PV1 = [0.004, 1.012, -0.006, 0.0, 0.0007, -0.0003, 0.0015, 0.009, 0.002, -0.008, 0.0, 0.0006]
PV2 = [-0.005, 1.018, 0.007, 0.0, -0.0009, 0.0012, 0.0004, -0.011, 0.001, 0.009, 0.0, -0.0002]


def test_distorted_round_trip(spark):
    arr = lambda v: F.array(*[F.lit(x) for x in v])
    sol = F.struct(
        F.lit(-300.5).alias("crpix1"), F.lit(-520.25).alias("crpix2"), F.lit(359.99).alias("crval1"), F.lit(-30.0).alias("crval2"),
        F.lit(-0.000112).alias("cd1_1"), F.lit(-2.0e-07).alias("cd1_2"), F.lit(1.1e-06).alias("cd2_1"), F.lit(0.000111).alias("cd2_2"),
        arr(PV1).alias("pv1"), arr(PV2).alias("pv2"),
    )
    grid = spark.createDataFrame([(float(x), float(y)) for x in range(1, 9300, 1500) for y in range(1, 9300, 1500)], "x0 double, y0 double").withColumn("wcs", sol)
    out = wcs_fn.to_pixel(wcs_fn.to_world(grid, "x0", "y0"), "ra", "dec", "wcs", "x1", "y1").toPandas()
    assert np.abs(out.x1 - out.x0).max() < 1e-3 and np.abs(out.y1 - out.y0).max() < 1e-3
    assert out.ra.between(0, 360).all()


def test_crosstalk_of_one_pixel(spark):
    p = spark.createDataFrame([(1, 2, 5, 60000.0)], "frame_id int, x int, y int, value double")
    got = {(r["x"], r["y"], r["code"]) for r in px.crosstalk_mask(p, ["frame_id"]).collect()}
    # amplifier 1 marks itself and 3 at the same column, 5 mirrored; 7 is too far
    assert got == {(2, 5, 1), (2 * 1152 + 2, 5, 1), (4 * 1152 + 1152 - 1 - 2, 5, 1)}


def bleed(column, down=False):
    return px.bleed_rows(np.asarray(column, float), 100.0, 10.0, down, 52000.0, 20, 40, 3000.0).tolist()


def test_bleed_trail():
    col = np.full(200, 100.0)
    col[50] = 60000
    assert bleed(col) == []  # nothing bright ahead
    col[51:95] = 5000
    assert bleed(col) == list(range(50, 95))  # the five dim pixels that end it are not masked
    assert bleed(col[::-1], down=True) == sorted(199 - i for i in range(50, 95))
    col[60:64] = 100  # four dim pixels do not end it
    assert bleed(col) == list(range(50, 95))


def test_bleed_mask_on_frames(spark):
    col = np.full(200, 100.0)
    col[50:95] = 60000
    rng = np.random.default_rng(0)
    rows = pd.DataFrame({"frame_id": 1, "x": np.repeat([0, 1], 200), "y": np.tile(np.arange(200), 2), "value": np.concatenate([col, rng.normal(100, 5, 200)])})
    got = px.bleed_mask(spark.createDataFrame(rows), ["frame_id"], F.lit(False)).toPandas()
    assert set(got.x) == {0} and sorted(got.y) == list(range(50, 95)) and set(got.code) == {8}


def test_section_borders_and_verdict(spark):
    w = 9216 / 8
    s = spark.createDataFrame([(1, 0.5 + w, 10.0, 0.1), (1, 5000.0, 5000.0, None)], "g int, xwin_image double, ywin_image double, sep double")
    sec = qa.section_qa(s, ["g"])
    state = {r["section"]: (r["n_all"], r["state"]) for r in sec.collect()}
    assert len(state) == 64 and state[0] == (1, "good") and state[1] == (1, "good")  # the border star counts twice
    assert [k for k, v in state.items() if v[1] == "bad"] == [4 + 8 * 4]
    full = spark.createDataFrame([(1, i) for i in range(64)], "g int, section int")
    def verdict(bad, empty):
        st_ = F.when(F.col("section").isin(bad), "bad").when(F.col("section").isin(empty), "empty").otherwise("good")
        return qa.frame_verdict(full.withColumn("state", st_), ["g"]).first()
    v = verdict([0, 5, 63], [-1])
    assert v["bad_sections"] == "8400000000000001" and not v["qaresult"] and not v["bad_amp"]
    v = verdict([-1], [2 + 8 * j for j in range(8)])
    assert v["bad_amp"] and v["qaresult"] and v["bad_sections"] == "0" * 16
    assert not verdict([-1], [2, 10])["bad_amp"]


def test_sections_strict_borders_drop_rows(spark):
    s = spark.createDataFrame([(100.0, 50.0), (150.0, 50.0)], "x_image double, y_image double")
    assert [(r["sect_x"], r["x_sect"]) for r in sel.section(s, 100, 100).collect()] == [(1, 50.0)]
    assert sel.amp_of(s, naxis1=800, n=8).count() == 1


def test_badamp_digits(spark):
    amps = spark.createDataFrame([("f", i, i == 1) for i in range(8)] + [("g", 0, False)], "k string, amp int, bad boolean")
    got = {r["k"]: (r["badamp"], r["photqa"]) for r in ph.badamp_code(amps, ["k"]).collect()}
    assert got == {"f": ("01000000", False), "g": ("00000000", True)}


def test_coadd_averages_shifted_frames(spark):
    p = spark.createDataFrame([(1, x, y, 10.0) for x in range(5) for y in range(5)] + [(2, x, y, 20.0) for x in range(5) for y in range(5)], "frame_id int, x int, y int, value double")
    scale = 0.4 / 3600
    w = spark.createDataFrame([(1, 1), (2, 1)], "frame_id int, stack_id int").withColumn(
        "wcs", wcs_fn.tan_struct(F.lit(10.0), F.lit(0.0) + F.when(F.col("frame_id") == 2, 2 * scale).otherwise(0.0), scale)
    )
    got = {(r["x"], r["y"]): (r["value"], r["n"]) for r in st.coadd(p, w, ["frame_id"], ["stack_id"], F.lit(10.0), F.lit(0.0), scale).collect()}
    assert got[(0, 0)] == (10.0, 1) and got[(0, 2)] == (15.0, 2) and got[(0, 6)] == (20.0, 1)


def test_cutout_is_zero_padded(spark):
    p = spark.createDataFrame([("i", k, x, y, float(10 * y + x)) for k in ("new", "ref", "sub") for x in range(4) for y in range(4)], "image_id string, kind string, x int, y int, value double")
    c = spark.createDataFrame([("i", 7, 0.0, 0.0)], "image_id string, number int, x_image double, y_image double")
    stamps = {r["kind"]: r["stamp"] for r in px.cutouts(c, p, ["image_id"], 3, cell=2).collect()}
    assert stamps["new"] == [0, 0, 0, 0, 0, 1, 0, 10, 11] and len(stamps) == 3


def test_reference_coverage(spark):
    c = spark.createDataFrame([(1, "i", 10.0, 0.0), (2, "i", 11.0, 0.0)], "number int, image_id string, alpha_j2000 double, delta_j2000 double")
    w = spark.createDataFrame([("i", 100, 100)], "image_id string, naxis1 int, naxis2 int").withColumn("wcs", wcs_fn.tan_struct(F.lit(10.0), F.lit(0.0), 0.4 / 3600, 50.0))
    assert {r["number"]: r["flag_12"] for r in px.reference_coverage(c, w, ["image_id"]).collect()} == {1: False, 2: True}


def test_final_flag_keeps_asteroids(spark):
    df = spark.createDataFrame([(1, True, True), (2, False, True), (3, False, False)], "number int, flag_0 boolean, flag_9 boolean")
    assert {r["number"]: r["flag"] for r in vt.final_flag(df).collect()} == {1: False, 2: True, 3: False}
    share = {r["flag_name"]: (r["n"], r["percent"]) for r in vt.flag_summary(vt.final_flag(df)).collect()}
    assert share["flag_9"] == (2, 66) and share["kept"] == (2, 66)


def test_longest_exposure_tie_takes_first_name(spark):
    p = spark.createDataFrame([("f", "b", 60), ("f", "a", 60), ("f", "0", 30)], "field string, path string, exptime int")
    assert st.longest(p, ["field"]).first()["path"] == "a"


def test_polynomial_scaling_of_strips(spark):
    s = spark.createDataFrame([(1, 0, 3, [1.0, 2.0]), (1, 1, 3, [1.0, 2.0])], "frame_id int, amp int, y int, values array<double>")
    zero = {f"c_{t}": F.lit(0.0) for t in ph.POLY_TERMS}
    f = spark.createDataFrame([(1, 0, False), (1, 1, True)], "frame_id int, amp int, bad boolean").withColumns({**zero, "c_one": F.lit(-27.5)})
    got = {r["amp"]: r["values"] for r in px.scale_zero_point(s, f, ["frame_id"], "2DPOLYNOMIAL", 2).collect()}
    assert got == {0: [10.0, 20.0], 1: [1.0, 2.0]}


def test_strips_place_by_x_and_stamps_are_never_lost(spark):
    p = spark.createDataFrame([(1, 3, 0, 7.0), (1, 1, 0, 5.0), (1, 10, 0, 9.0)], "frame_id int, x int, y int, value double")
    strips = {r["amp"]: r["values"] for r in px.pixels_to_strips(p, ["frame_id"], 8).collect()}
    assert strips == {0: [None, 5.0, None, 7.0], 1: [None, None, 9.0]}
    assert {(r["x"], r["value"]) for r in px.strips_to_pixels(px.pixels_to_strips(p, ["frame_id"], 8), ["frame_id"], 8).where("value is not null").collect()} == {(1, 5.0), (3, 7.0), (10, 9.0)}
    c = spark.createDataFrame([(1, 1, 3.0, 0.0), (1, 2, 500.0, 500.0)], "frame_id int, number int, x_image double, y_image double")
    stamps = px.cutouts(c, p.withColumn("kind", F.lit("new")), ["frame_id"], 3, cell=2).collect()
    assert len(stamps) == 6 and all(len(r["stamp"]) == 9 for r in stamps)
    assert {(r["number"], r["kind"]) for r in stamps if r["covered"]} == {(1, "new")}


def test_difference_keeps_uncovered_pixels_and_tiles_keep_the_rest(spark):
    p = spark.createDataFrame([(1, 0, 0, 7.0), (1, 9, 9, 5.0)], "frame_id int, x int, y int, value double")
    none = p.limit(0).select("frame_id", "x", "y", F.lit(1).alias("code"))
    got = {r["x"]: r["value"] for r in px.difference(p, p.where("x = 0"), none, ["frame_id"]).collect()}
    assert got == {0: 0.0, 9: px.NULL_PIXEL}
    assert {(r["x"], r["tile"], r["x_tile"], r["y_tile"]) for r in px.tile_image(p, 10, 10, 3, 3).collect()} == {(0, 0, 0, 0), (9, 8, 3, 3)}


def test_no_pixel_behind_the_tangent_plane(spark):
    arr = lambda v: F.array(*[F.lit(x) for x in v])
    sol = F.struct(
        *[F.lit(v).alias(k) for k, v in {"crpix1": 1.0, "crpix2": 1.0, "crval1": 10.0, "crval2": 0.0, "cd1_1": 1e-4, "cd1_2": 0.0, "cd2_1": 0.0, "cd2_2": 1e-4}.items()],
        arr(PV1).alias("pv1"), arr(PV2).alias("pv2"),
    )
    r = wcs_fn.to_pixel(spark.createDataFrame([(190.0, 0.0)], "ra double, dec double").withColumn("wcs", sol), "ra", "dec").first()
    assert r["x"] is None and r["y"] is None


def test_filter_on_a_projected_pixel_stays_small(spark):
    sol = wcs_fn.tan_struct(F.lit(10.0), F.lit(0.0), 0.4 / 3600, 50.0)
    sky = spark.createDataFrame([(10.0, 0.0), (10.1, 0.0)], "ra double, dec double").withColumn("wcs", sol)
    near = wcs_fn.to_pixel(sky, "ra", "dec").where("abs(x) < 100 or abs(y) < 10")
    assert len(near._jdf.queryExecution().optimizedPlan().toString()) < 100_000
    assert [round(r["x"], 6) for r in near.collect()] == [50.0]


def test_candidates_without_a_reference_image_are_outside(spark):
    from skyflow.functions.wcs import tan_struct

    rows = [(1, "a", 10.0, 20.0), (2, "a", 190.0, -20.0), (3, "b", 10.0, 20.0), (4, "a", None, 20.0), (5, "a", 10.5, 20.0), (6, None, 10.0, 20.0)]
    df = spark.createDataFrame(rows, "number int, chip string, alpha_j2000 double, delta_j2000 double")
    from pyspark.sql import functions as F

    wcs = spark.range(1).select(F.lit("a").alias("chip"), tan_struct(F.lit(10.0), F.lit(20.0), 0.4 / 3600, 0.0).alias("wcs"), F.lit(100).alias("naxis1"), F.lit(100).alias("naxis2"))
    got = {r["number"]: r["flag"] for r in vt.final_flag(vt.flag_12(df, wcs, ["chip"])).collect()}
    assert got.pop(1) in (True, False) and got == {2: True, 3: True, 4: True, 5: True, 6: True}


def test_an_amplifier_without_a_valid_pixel_stays(spark):
    rows = [("k", a, 0, None if a == 2 else [float(a), float(a) + 2]) for a in range(4)] + [("k", 2, 1, [None, None])]
    df = spark.createDataFrame(rows, "chip string, amp int, y int, values array<double>")
    got = {(r["amp"], r["y"]): r["values"] for r in px.level_amps(df, ["chip"]).collect()}
    assert got[2, 0] is None and got[2, 1] == [None, None]
    assert got[0, 0] == got[1, 0] == got[3, 0] == [1.0, 3.0]
