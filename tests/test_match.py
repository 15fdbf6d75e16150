import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from skyflow.operators import match as mt
from skyflow.operators.cells import box_search, cone_search

SAME = dict(right_pos=("alpha_j2000", "delta_j2000"), right_id="number")


def sky(n, seed):
    """A third all over the sky, a third in one tight cluster, a third around the pole and the RA wrap."""
    rng = np.random.default_rng(seed)
    k = n // 3
    ra = np.concatenate([rng.uniform(0, 360, k), 120 + rng.normal(0, 1e-4, k), rng.normal(0, 0.01, n - 2 * k) % 360])
    dec = np.concatenate(
        [np.degrees(np.arcsin(rng.uniform(-1, 1, k))), -30 + rng.normal(0, 1e-4, k), np.where(rng.random(n - 2 * k) < 0.5, 89.99, 0) + rng.uniform(-0.005, 0.005, n - 2 * k)]
    )
    return pd.DataFrame({"number": np.arange(n), "alpha_j2000": ra, "delta_j2000": dec, "g": np.arange(n) % 2})


def vectors(p):
    a, d = np.radians(p.alpha_j2000.to_numpy()), np.radians(p.delta_j2000.to_numpy())
    return np.stack([np.cos(d) * np.cos(a), np.cos(d) * np.sin(a), np.sin(d)], axis=1)


def brute(left, right):
    chord = np.linalg.norm(vectors(left)[:, None, :] - vectors(right)[None], axis=2)
    sep = np.round(2 * np.arcsin(np.minimum(1, chord / 2)) * 206264.80624709636, 6)
    i = sep.argmin(axis=1)
    return right.number.to_numpy()[i], sep[np.arange(len(left)), i]


@pytest.fixture(scope="module")
def catalogs():
    return sky(900, 1), sky(700, 2)


@pytest.mark.parametrize("radius,dense", [(20.0, 128), (7200.0, 16)])
def test_match_equals_brute_force(spark, catalogs, radius, dense):
    left, right = catalogs
    got = mt.sky_match(spark.createDataFrame(left), spark.createDataFrame(right), radius, dense=dense, **SAME)
    got = got.select("number", "ref_number", "sep").toPandas().sort_values("number")
    ids, sep = brute(left, right)
    assert got.number.tolist() == left.number[sep < radius].tolist()
    assert got.ref_number.tolist() == ids[sep < radius].tolist()
    assert np.allclose(got.sep, sep[sep < radius], atol=2e-6)


def test_nearest_equals_brute_force(spark, catalogs):
    left, right = catalogs
    got = mt.sky_nearest(spark.createDataFrame(left), spark.createDataFrame(right), keys=["g"])
    got = got.select("number", "g", "near_number").toPandas().sort_values("number")
    for g in (0, 1):
        ids, _ = brute(left[left.g == g], right[right.g == g])
        assert got[got.g == g].near_number.tolist() == ids.tolist()


def table(spark, rows, names="number long, alpha_j2000 double, delta_j2000 double"):
    return spark.createDataFrame(rows, names)


def test_wrap_pole_ties_and_copies(spark):
    left = table(spark, [(1, 359.9999, 0.0), (2, 10.0, 89.9999), (3, 50.0, 0.0), (4, None, 0.0)])
    right = table(spark, [(9, 0.0001, 0.0), (8, 190.0, 89.9999), (7, 50.0001, 0.0), (6, 49.9999, 0.0), (5, 50.0001, 0.0)])
    got = {r["number"]: r for r in mt.sky_match(left, right, 2.0, **SAME).collect()}
    assert set(got) == {1, 2, 3}
    assert got[1]["ref_number"] == 9 and abs(got[1]["sep"] - 0.72) < 1e-4
    assert got[2]["ref_number"] == 8
    assert got[3]["ref_number"] == 5  # 5, 6, 7 are equally far


def test_strict_radius_and_left_join(spark):
    left = table(spark, [(1, 50.0, 0.0), (2, 60.0, 0.0)])
    right = table(spark, [(9, 50.0, 2.0 / 3600)])
    assert mt.sky_match(left, right, 2.0, **SAME).count() == 0
    assert mt.sky_match(left, right, 2.0, inclusive=True, **SAME).count() == 1
    kept = mt.sky_match(left, right, 3.0, how="left", **SAME).orderBy("number").collect()
    assert [r["ref_number"] for r in kept] == [9, None]


def test_radius_is_not_tested_on_the_rounded_separation(spark):
    left = spark.createDataFrame([(1, 0.0, 0.0)], "number int, ra double, dec double")
    right = spark.createDataFrame([(7, 1.9999997 / 3600, 0.0)], "ref_id int, ra double, dec double")
    for dense in (128, 0):
        row = mt.sky_match(left, right, 2.0, left_pos=("ra", "dec"), right_pos=("ra", "dec"), dense=dense).first()
        assert (row["ref_id"], row["sep"]) == (7, 2.0)


def test_empty_right_side(spark):
    left = table(spark, [(1, 50.0, 0.0)])
    right = table(spark, [])
    assert mt.sky_match(left, right, 2.0, **SAME).count() == 0
    assert mt.sky_nearest(left, right).first()["near_number"] is None


def test_hot_position_is_searched_once(spark):
    """A third of all rows at one position on both sides: no pair explosion, all rows kept."""
    hot = spark.range(20000).select(F.col("id").alias("number"), F.lit(10.0).alias("alpha_j2000"), F.lit(5.0).alias("delta_j2000"))
    got = mt.sky_match(hot, hot, 1.0, **SAME)
    assert got.groupBy("ref_number").count().collect()[0].asDict() == {"ref_number": 0, "count": 20000}


def test_adaptive_radius(spark):
    rows = [(i, 10.0 + i * 0.01, 0.0, "a", 1.0) for i in range(60)] + [(100 + i, 20.0 + i * 0.01, 0.0, "b", 1.0) for i in range(10)]
    left = table(spark, rows, "number long, alpha_j2000 double, delta_j2000 double, g string, rms double")
    right = table(spark, [(n, ra + 0.5 / 3600, d) for n, ra, d, _, _ in rows])
    got = mt.adaptive_match(left, right, group=["g"], rms="rms", min_n=50, max_k=5, **SAME)
    assert {(r["g"], r["match_k"]) for r in got.collect()} == {("a", 1), ("b", 5)}
    unknown = mt.adaptive_match(left.withColumn("rms", F.lit(None).cast("double")), right, group=["g"], rms="rms", **SAME)
    assert unknown.count() == 0  # 0.5 arcsec, strict


def test_adaptive_match_counts_and_returns_one_written_match(spark):
    left = table(spark, [(i, 10.0 + i * 0.01, 0.0, 1.0) for i in range(20)], "number long, alpha_j2000 double, delta_j2000 double, rms double")
    got = mt.adaptive_match(left, left.drop("rms"), group=["rms"], rms="rms", min_n=5, **SAME)
    assert "_sites" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert got.count() == 20


def test_cone_and_box_across_the_wrap(spark):
    t = table(spark, [(1, 359.95, 0.0), (2, 0.05, 0.0), (3, 1.0, 0.0), (4, 0.0, 89.99)])
    assert {r["number"] for r in cone_search(t, 0.0, 0.0, 0.1, "alpha_j2000", "delta_j2000").collect()} == {1, 2}
    assert {r["number"] for r in box_search(t, 0.0, 0.0, 0.2, "alpha_j2000", "delta_j2000").collect()} == {1, 2}
    assert {r["number"] for r in cone_search(t, 180.0, 89.99, 0.1, "alpha_j2000", "delta_j2000").collect()} == {4}


def test_groups_match_in_cells_of_their_own_radius(spark):
    import math
    import random

    rnd = random.Random(8)
    refs = [(i, rnd.uniform(0, 360), rnd.uniform(-89, 89), k) for i, k in enumerate(["a", "b", None] * 60)]
    # one key with a radius of many degrees, one of an arcsecond, one without a radius
    rms = {"a": 20_000.0, "b": 0.4, "c": None}
    left = []
    for n in range(240):
        group = "abc"[n % 3]
        i, ra, dec, _ = refs[rnd.randrange(len(refs))]
        off = rnd.uniform(0, 3) * (rms[group] or 0.3) / 3600
        left.append((n, group, ra, max(-89.9, min(89.9, dec + off)), rms[group]))
    s = spark.createDataFrame(left, "number long, g string, alpha_j2000 double, delta_j2000 double, rms double")
    r = spark.createDataFrame([(i, a, d) for i, a, d, _ in refs], "ref_id long, raj2000 double, dej2000 double")
    got = {x["number"]: x for x in mt.adaptive_match(s, r, group=["g"], rms="rms", min_n=30, max_k=3).collect()}

    def apart(a, b):
        x, y = ([math.cos(math.radians(d)) * math.cos(math.radians(r)), math.cos(math.radians(d)) * math.sin(math.radians(r)), math.sin(math.radians(d))] for r, d in (a, b))
        return math.degrees(2 * math.asin(min(1, math.dist(x, y) / 2))) * 3600

    nearest = {n: min((round(apart((ra, dec), (a, d)), 6), i) for i, a, d, _ in refs) for n, _, ra, dec, _ in left}
    for group, value in rms.items():
        mine = [n for n, g, *_ in left if g == group]
        k = next((k for k in (1, 2) if value and sum(nearest[n][0] < value * k for n in mine) > 30), 3)
        limit = value * k if value else 0.5
        near = {n for n in mine if nearest[n][0] < limit - 1e-5}
        assert near <= {n for n in mine if n in got} <= {n for n in mine if nearest[n][0] < limit + 1e-5}
        assert all(abs(got[n]["sep"] - nearest[n][0]) < 1e-4 for n in near)
    plan = mt.adaptive_match(s, r, group=["g"], rms="rms")._jdf.queryExecution().optimizedPlan().toString()
    assert "_class" in plan


@pytest.mark.parametrize("how", ["match", "nearest"])
def test_dense_fields_do_not_descend_row_by_row(spark, monkeypatch, how):
    rng = np.random.default_rng(5)
    left, right = (
        pd.DataFrame({"number": np.arange(n), "alpha_j2000": 120 + rng.random(n) * 0.02, "delta_j2000": -30 + rng.random(n) * 0.02, "g": 0})
        for n in (1500, 2500)
    )
    descended, descent = [], mt.nearest_by_descent

    def counted(rows, *args):
        descended.append(rows.count())
        return descent(rows, *args)

    monkeypatch.setattr(mt, "nearest_by_descent", counted)
    l, r = spark.createDataFrame(left), spark.createDataFrame(right)
    got = mt.sky_match(l, r, 5.0, keys=["g"], dense=16, **SAME) if how == "match" else mt.sky_nearest(l, r, keys=["g"], sep_col="sep", prefix="ref_")
    got = got.select("number", "ref_number", "sep").toPandas().sort_values("number")
    ids, sep = brute(left, right)
    assert got.number.tolist() == left.number.tolist() and got.ref_number.tolist() == ids.tolist()
    assert np.allclose(got.sep, sep, atol=2e-6)
    assert sum(descended) < 30


def test_batched_cells_keep_rows_without_key_or_sites(spark):
    left = spark.createDataFrame([(1, "a", 10.0, 0.0), (2, None, 10.0, 0.0), (3, "b", 10.0, 0.0), (4, "a", None, 0.0)], "number long, k string, alpha_j2000 double, delta_j2000 double")
    right = spark.createDataFrame([(100 + i, "a", 10.0 + i * 1e-5, 0.0) for i in range(200)] + [(7, None, 10.0, 0.0)], "number long, k string, alpha_j2000 double, delta_j2000 double")
    for dense in (64, 8):  # batches at the radius, and closer first
        got = mt.sky_match(left, right, 2.0, keys=["k"], how="left", dense=dense, **SAME).select("number", "k", "ref_number").collect()
        assert sorted(map(tuple, got)) == [(1, "a", 100), (2, None, None), (3, "b", None), (4, "a", None)]


def test_dense_matches_shuffle_places_only(spark):
    rows = [(i, 10 + (i % 40) * 1e-4, 20 + (i // 40) * 1e-4) for i in range(400)]
    right = spark.createDataFrame(rows, "ref_id long, raj2000 double, dej2000 double")
    left = spark.createDataFrame([(i, str(a), d + 2e-5) for i, a, d in rows], "number long, alpha_j2000 string, delta_j2000 double")
    sites = mt._reference_sites(right, ("raj2000", "dej2000"), "ref_id", [], [])
    h = mt.cell_height(1 / 3600)
    copies = mt.sky_cells(sites, "_ra", "_dec", 1 / 3600, copies=True, h=h, out="_cell")
    cells = left.withColumn("_cell", mt.own_cell(F.col("alpha_j2000").cast("double"), F.col("delta_j2000"), h))
    pos = ("alpha_j2000", "delta_j2000")
    found = mt._within_dense(cells, pos, copies, ["_cell"], lambda b: b["raw"] < 1, "left")
    got = {r["number"]: (r["alpha_j2000"], r["_best"]["s"]["id"], r["_best"]["sep"]) for r in found.collect()}
    assert got == {i: (str(a), i, 0.072) for i, a, _ in rows}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("RepartitionByExpression"):]
    assert "Union" in below and "_lx" not in below and "_x#" not in below


def test_close_pass_is_written_once_for_positions(spark, monkeypatch):
    """Rows of one position share one search, which no step behind it computes again."""
    from skyflow.operators import match as mt

    monkeypatch.setattr(mt, "DENSE", 4)
    stars = spark.createDataFrame([(i, 10 + i % 20 * 1e-3, i // 20 * 1e-3, float(i)) for i in range(400)], "number long, alpha_j2000 double, delta_j2000 double, m double")
    rows = [(i, 10.0 + i % 7 * 1e-3 + 1e-4, 2e-3) for i in range(70)] + [(70, 11.0, 0.0), (71, None, 0.0)]
    left = spark.createDataFrame(rows, "id long, alpha_j2000 double, delta_j2000 double")
    near = mt.sky_nearest(left, stars, right_cols=["m"])
    assert any("/near-" in f for f in near.inputFiles())
    assert "_near(" not in near._jdf.queryExecution().optimizedPlan().toString().replace("/near-", "")
    got = {r["id"]: r["near_m"] for r in near.collect()}
    assert len(got) == 72 and got[71] is None
    assert all(got[i] == 40 + i % 7 for i in range(70)) and got[70] in range(19, 400, 20)


def test_cells_are_compared_in_blocks_as_in_pairs(spark, monkeypatch):
    from skyflow.operators import match as mt

    stars = spark.createDataFrame([(i, 10 + i * 37 % 101 * 1e-5, i * 53 % 97 * 1e-5) for i in range(900)], "ref_id long, raj2000 double, dej2000 double")
    left = spark.createDataFrame([(i, 10 + i * 29 % 103 * 1e-5 + 3e-6, i * 31 % 89 * 1e-5) for i in range(300)], "number long, alpha_j2000 double, delta_j2000 double")
    found = []
    for block in (0, 1 << 40):
        monkeypatch.setattr(mt, "BLOCK", block)
        found.append(sorted(tuple(r) for r in mt.sky_match(left, stars, 0.5, dense=64).select("number", "ref_id", "sep").collect()))
    assert found[0] == found[1] and len(found[0]) > 200
