"""The calibration job over several apertures."""

import math
import statistics

import pytest
from pyspark.sql import functions as F

from skyflow.operators import photometry as ph
from skyflow.plans import jobs

APERTURES = [("mag_aper", "magerr_aper"), ("mag_auto", "magerr_auto")]


@pytest.fixture(scope="module")
def tables(spark):
    rows = []
    for i in range(400):
        mag = -15.0 + (i % 40) * 0.05
        aper = 99.0 if i % 50 == 7 else mag + 0.5 + (i % 3) * 0.01
        rows.append((i, "a" if i % 2 else "b", 10 + i * 0.003, 0.1 * (i % 7), mag, 0.01, aper, 0.02, 0, 0.9, 3.0 + (i % 5)))
    schema = "number int, image string, alpha_j2000 double, delta_j2000 double, mag_auto double, magerr_auto double, mag_aper double, magerr_aper double, flags int, class_star double, fwhm_image double"
    sources = spark.createDataFrame(rows, schema).withColumn("rms", F.when(F.col("image") == "a", 0.3))
    ref = [(i, r[2], r[3] + 0.35 / 3600 * (i % 4 == 1), r[4] + 30.0 + (0.02 if i % 4 < 2 else -0.02), 0.01) for i, r in enumerate(rows)]
    return rows, sources, spark.createDataFrame(ref, "ref_id int, raj2000 double, dej2000 double, rmag double, e_rmag double")


def test_each_aperture_has_its_zero_point_and_the_radius_adapts(spark, tables):
    rows, sources, refcat = tables
    c = jobs.calibrate_catalog(sources, refcat, ["image"], apertures=APERTURES, rms="rms", min_n=100, with_depth=False)
    got = {r["image"]: r for r in c.summary.collect()}
    for image in "ab":
        # image "a" has 100 of 200 stars within 0.3 arcsec, not more, so it goes on to 0.6
        own = [(i, r) for i, r in enumerate(rows) if r[1] == image and r[6] != 99]
        shift = {i: 0.02 if i % 4 < 2 else -0.02 for i, _ in own}
        assert got[image]["zp"] == pytest.approx(statistics.median(30 + shift[i] for i, _ in own))
        assert got[image]["zp_mag_aper"] == pytest.approx(statistics.median(r[4] + 30 + shift[i] - r[6] for i, r in own))
        assert got[image]["n_kept"] == len(own)
        assert got[image]["match_radius"] == pytest.approx(0.6 if image == "a" else 0.5)
    by = {r["number"]: r for r in c.catalog.collect()}
    assert len(by) == len(rows) and by[7]["mag_aper"] == 99 and by[7]["mag_auto"] != 99
    zp, zper = got["b"]["zp_mag_aper"], got["b"]["zper_mag_aper"]
    assert by[0]["mag_aper"] == pytest.approx(rows[0][6] + round(zp, 3))
    assert by[0]["magerr_aper"] == pytest.approx(math.hypot(0.02, round(zper, 3)))


def test_one_aperture_at_a_fixed_radius(spark, tables):
    rows, sources, refcat = tables
    c = jobs.calibrate_catalog(sources, refcat, ["image"], radius=0.2, with_depth=False)
    got = {r["image"]: r for r in c.summary.collect()}
    assert got["a"]["n_kept"] == 100 and got["b"]["n_kept"] == 200 and got["a"]["match_radius"] == 0.2
    assert got["b"]["zp"] == pytest.approx(30.0) and "zp_mag_aper" not in c.summary.columns


def test_summaries_read_one_written_match(spark, tables):
    _, sources, refcat = tables
    for rms in (None, "rms"):
        c = jobs.calibrate_catalog(sources, refcat, ["image"], apertures=APERTURES, rms=rms, min_n=100, with_depth=False)
        plan = c.summary._jdf.queryExecution().optimizedPlan().toString()
        assert "_sites" not in plan and any("/matched-" in f for f in c.summary.inputFiles())


def test_depth_follows_the_first_aperture(spark, tables):
    _, sources, refcat = tables
    grown = sources.withColumn("magerr_aper", F.exp((F.col("mag_auto") + 13) * 0.9) * 0.2)
    # the reference is exact here, so that no spread is added to the errors
    exact = refcat.withColumn("rmag", F.col("rmag") - F.when(F.col("ref_id") % 4 < 2, 0.02).otherwise(-0.02))
    exact_aper = grown.withColumn("mag_aper", F.col("mag_auto") + 0.5)
    bright = exact_aper.withColumn("magerr_aper", F.when(F.col("number") % 3 == 0, 0.01).otherwise(F.col("magerr_aper")))
    c = jobs.calibrate_catalog(bright, exact, ["image"], apertures=APERTURES)
    want = ph.depth_from_errors(c.catalog, ["image"], "mag_aper", "magerr_aper")
    depths = {r["image"]: r["depth"] for r in c.summary.collect()}
    assert depths == {r["image"]: r["depth"] for r in want.collect()} and set(depths) == {"a", "b"}
    assert all(d == pytest.approx(17.0, abs=0.02) for d in depths.values())


def test_surfaces_of_amplifiers_and_those_without_enough_stars(spark):
    from skyflow.operators import pixels as px

    rows = [(0, a, float(x), float(y), 15.0, 45.0 - 1e-5 * x + 2e-9 * x * y) for a in (0, 1) for x in range(a * 40 + 1, a * 40 + 40, 9) for y in range(5, 9000, 1500)]
    rows += [(0, 2, 90.0 + i, 10.0, 15.0, 45.0) for i in range(5)]
    stars = spark.createDataFrame(rows, "frame_id int, amp int, x_image double, y_image double, mag_auto double, ref_rmag double")
    fits = ph.amp_surface_fit(stars, ["frame_id", "amp"], "mag_auto", "ref_rmag")
    fits = ph.amps_after_fit(fits, stars, ["frame_id"], 4)
    assert {r["amp"]: r["bad"] for r in fits.collect()} == {0: False, 1: False, 2: True, 3: True}
    strips = spark.createDataFrame([(0, a, 7, [1.0] * 40) for a in range(4)], "frame_id int, amp int, y int, values array<double>")
    scaled = {r["amp"]: r["values"] for r in px.scale_zero_point(strips, fits, ["frame_id"], "2DPOLYNOMIAL", 40).collect()}
    want = [round(10 ** ((1e-5 * x - 2e-9 * x * 7) / 2.5), 4) for x in range(80)]
    assert scaled[0] + scaled[1] == pytest.approx(want, abs=1.01e-4) and scaled[2] == scaled[3] == [1.0] * 40
    middle = px.scaled_saturation_2d(fits, ["frame_id"], 40, 9).collect()
    scales = sorted([1.0] * (2 * 40 * 9) + [round(10 ** ((1e-5 * x - 2e-9 * x * y) / 2.5), 4) for x in range(80) for y in range(9)])
    assert len(middle) == 1 and middle[0]["saturate"] == pytest.approx(60000 * statistics.median(scales), abs=6.1)
    with pytest.raises(ValueError):
        jobs.scale_zeropoints(stars, stars, "rmag", mode="3D")


def test_spread_does_not_sort(spark):
    """A scan of one split is dealt out as it streams, all of its rows, in about equal parts."""
    from skyflow.session import spread

    one = spark.range(0, 4000, 1, 1).withColumn("hot", F.lit(None).cast("long"))
    out = spread(one)
    assert "RoundRobin" not in out._jdf.queryExecution().executedPlan().toString()
    parts = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(parts) == 4000 and len(parts) == spark.sparkContext.defaultParallelism and max(parts) < 1200
    assert out.columns == one.columns and out.distinct().count() == 4000
