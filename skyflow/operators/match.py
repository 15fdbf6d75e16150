"""Nearest-neighbour joins on the sphere.

``sky_match`` (bounded radius) joins on cells of a few radii; each cell's
reference stars travel as one short array, so a source is matched inside a
single projection and never fans out into candidate pairs. Where cells hold more
than a few ``DENSE`` stars (a crowded field), the same join runs first with a radius
that fits their density: a source with a star that near has its nearest. Only
sources without one, and cells that stay crowded (a hot position), are searched by
``nearest_by_descent``, which walks a tree of nested cells and keeps only branches
that can still hold the nearest star. ``sky_nearest`` (no radius) does the same
from the top.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, DoubleType

from skyflow.functions.angles import ARCSEC_PER_RADIAN, SEP_DECIMALS, SEP_EXACT, chord_angle, unit_vector
from skyflow.operators.cells import cell_height, own_cell, sky_cells
from skyflow.session import cut_lineage, stored

# Reference positions per cell that are still compared one by one, CROWDED times as many as arrays of a batch; where a
# cell typically has more than one in SPARSE of them, arrays of a batch are faster.
DENSE, CROWDED, SPARSE = 128, 4, 16
# Pairs a cell from which on a batch is compared cell by cell, not pair by pair.
BLOCK = 8192
# Reference positions that a disc of the close radius holds on average: few sources see none (e**-12).
CLOSE = 12
# Separations closer to the close radius (arcsec) are not final: a tie could lie outside.
CLOSE_EDGE = 2e-6
# Radius classes (arcsec): the smallest, the step between two, and how many; the last holds the whole sky.
CLASS_BASE, CLASS_STEP, CLASSES = 0.5, 4, 12
# Cells of one key that may form the first level of a descent.
ROOTS = 64
# Nested cell sizes (degrees) of an all-sky descent, each 4 times finer.
TREE_LEVELS = [22.5 / 4**i for i in range(10)]
# A cell with at most this many positions is compared directly at the end of a descent.
LEAF = 32
# Slack (radians) of the branch bounds: wider than the rounding step of separations, so ties survive.
SLACK = 1e-11


def _hit_struct(angle: Column, site: Column) -> Column:
    """What a match is ranked by (rounded separation, then id) and the separation that is held against a radius."""
    arcsec = angle * ARCSEC_PER_RADIAN
    return F.struct(F.round(arcsec, SEP_DECIMALS).alias("sep"), site.alias("s"), F.round(arcsec, SEP_EXACT).alias("raw"))


def _out_name(c: str, prefix: str) -> str:
    return c if c.startswith(prefix) else prefix + c


def _reference_sites(right: DataFrame, pos, rid: str, keys, cols) -> DataFrame:
    """One row per distinct reference position: copies cost nothing downstream."""
    ra, dec = pos
    extra = [c for c in cols if c != rid]
    best = F.min(F.struct(F.col(rid).alias("id"), *[F.col(c).alias(f"p_{c}") for c in extra])).alias("_s")
    return (
        right.where(F.col(ra).isNotNull() & F.col(dec).isNotNull())
        .groupBy(*keys, F.pmod(F.col(ra).cast("double"), F.lit(360.0)).alias("_ra"), F.col(dec).cast("double").alias("_dec"))
        .agg(best)
    )


def _site_struct(sites: DataFrame) -> DataFrame:
    """Attach unit vectors and pack what a comparison needs into one struct."""
    x, y, z = unit_vector("_ra", "_dec")
    return sites.withColumns({"_x": x, "_y": y, "_z": z}).withColumn("_site", F.struct("_s", "_x", "_y", "_z"))


def _chord2(x: Column, y: Column, z: Column, bx: Column, by: Column, bz: Column) -> Column:
    dx, dy, dz = x - bx, y - by, z - bz
    return dx * dx + dy * dy + dz * dz


def _ranked(sites: Column, x: Column, y: Column, z: Column, keep) -> Column:
    """Smallest ``(sep, id)`` of an array of sites that pass ``keep``; null when there is none."""
    measured = F.transform(sites, lambda s: _hit_struct(chord_angle(x, y, z, s["_x"], s["_y"], s["_z"]), s["_s"]))
    return F.array_min(F.filter(measured, keep))


def _sites_within(sites: Column, x: Column, y: Column, z: Column, chord2: Column) -> Column:
    """Cheap prefilter: few sites reach the exact comparison."""
    return F.filter(sites, lambda s: _chord2(x, y, z, s["_x"], s["_y"], s["_z"]) <= chord2)


def _once(df: DataFrame, best: Column, keep) -> DataFrame:
    """``_best`` evaluated once per row: a generator, unlike a projection, is not inlined into filters."""
    return df.withColumn("_best", F.explode_outer(F.filter(F.array(best), keep)))


def _spread(df: DataFrame, rid: str, cols, prefix: str, sep_col: str) -> DataFrame:
    """Unpack the winning struct ``_best`` into output columns."""
    out = {sep_col: F.col("_best.sep"), _out_name(rid, prefix): F.col("_best.s.id")}
    for c in cols:
        if c != rid:
            out[_out_name(c, prefix)] = F.col("_best.s")[f"p_{c}"]
    return df.withColumns(out).drop("_best")


def _within(
    left: DataFrame, left_pos: tuple[str, str], copies: DataFrame, on: list[str], radius_deg: float | Column, hit, how: str
) -> DataFrame:
    """``_best`` of every left row among the ``copies`` of its cell (the columns ``on``) that pass ``hit``."""
    # shuffled as they are, before they grow to arrays and unit vectors
    cells = _site_struct(copies.repartition(*on)).groupBy(*on).agg(F.collect_list("_site").alias("_sites"))
    x, y, z = unit_vector(*[F.col(c).cast("double") for c in left_pos])
    found = left.join(cells, on, how).withColumns({"_lx": x, "_ly": y, "_lz": z})
    xyz = (F.col("_lx"), F.col("_ly"), F.col("_lz"))
    if isinstance(radius_deg, Column):
        reach = 2 * F.sin(F.least(F.radians(radius_deg) + 1e-9, F.lit(math.pi)) / 2)
    else:
        reach = 2 * math.sin(min(math.radians(radius_deg) + 1e-9, math.pi) / 2)
    near = _ranked(_sites_within(F.col("_sites"), *xyz, F.lit(reach * reach)), *xyz, hit)
    return _once(found, near, hit).drop("_sites", "_lx", "_ly", "_lz")


def _near_sites(schema) -> Column:
    """UDF for rows sorted by cell, sites first: the sites as near to a source as its nearest one, but for rounding.

    Takes the site (null for sources), x, y and z, then the columns of the cell. Sites of one cell are held at a time.
    """
    most, slack = 1 << 18, 4 * CLOSE_EDGE / ARCSEC_PER_RADIAN

    @F.arrow_udf(ArrayType(schema))
    def near(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        import numpy as np
        import pyarrow.compute as pc

        held, last = None, None
        for sites, x, y, z, *cell in batches:
            n = len(sites)
            at = np.stack([c.to_numpy(zero_copy_only=False) for c in (x, y, z)], 1) if n else np.zeros((0, 3))
            new = np.zeros(n, bool)
            for c in cell:
                new[1:] |= pc.fill_null(pc.not_equal(c[1:], c[:-1]), True).to_numpy(zero_copy_only=False)
            first = [c[0].as_py() for c in cell] if n else None
            if held is not None and n and first == last and None not in first:
                sites, at, new = pa.concat_arrays([held[0], sites]), np.concatenate([held[1], at]), np.r_[np.zeros(len(held[0]), bool), new]
            skip = len(sites) - n
            is_site = sites.is_valid().to_numpy(zero_copy_only=False)
            group = np.cumsum(new)
            place = np.flatnonzero(is_site)
            edges = np.searchsorted(group, np.arange(group[-1] + 2 if n else 1))
            begin = np.searchsorted(place, edges[:-1])
            count = np.diff(np.r_[begin, len(place)])
            source = np.flatnonzero(~is_site)
            pairs = np.cumsum(count[group[source]])
            taken, sizes, lo = [], np.zeros(len(sites), np.int64), 0
            if len(source) and pairs[-1] > BLOCK * len(count):
                # rows of a cell are together, its sites first: a block of its sources against all of its sites at a time
                for start, sited, end in zip(edges[:-1].tolist(), (edges[:-1] + count).tolist(), edges[1:].tolist()):
                    x, y, z = at[start:sited].T.copy()
                    for lo in range(sited, end if sited > start else sited, max(1, most // max(1, sited - start))):
                        part = at[lo : min(lo + max(1, most // (sited - start)), end)]
                        square = (part[:, :1] - x) ** 2 + (part[:, 1:2] - y) ** 2 + (part[:, 2:] - z) ** 2
                        reach = np.sqrt(square.min(1)) + slack
                        which, with_ = np.nonzero(square <= (reach * reach)[:, None])
                        taken.append(with_ + start)
                        sizes[lo : lo + len(part)] = np.bincount(which, minlength=len(part))
                lo = len(source)
            while lo < len(source):
                before = pairs[lo - 1] if lo else 0
                hi = max(lo + 1, int(np.searchsorted(pairs, before + most)))
                part = source[lo:hi]
                part = part[count[group[part]] > 0]
                k = count[group[part]]
                start = np.cumsum(k) - k
                with_ = place[np.arange(k.sum()) - np.repeat(start - begin[group[part]], k)]
                d = at[with_] - np.repeat(at[part], k, axis=0)
                chord = np.sqrt(np.einsum("ij,ij->i", d, d))
                if len(part):
                    keep = chord <= np.repeat(np.minimum.reduceat(chord, start) + slack, k)
                    taken.append(with_[keep])
                    sizes[part] = np.add.reduceat(keep, start, dtype=np.int64)
                lo = hi
            offsets = np.r_[0, np.cumsum(sizes[skip:])].astype(np.int32)
            picked = sites.take(pa.array(np.concatenate(taken) if taken else np.zeros(0, np.int64)))
            if n:
                tail = place[group[place] == group[-1]]
                held, last = (sites.take(pa.array(tail)), at[tail]), [c[len(c) - 1].as_py() for c in cell]
            yield pa.ListArray.from_arrays(pa.array(offsets), picked)

    return near.asNondeterministic()  # the order of its rows counts


def _within_dense(left: DataFrame, left_pos: tuple[str, str], copies: DataFrame, on: list[str], hit, how: str) -> DataFrame:
    """``_within`` for many sites a cell: both sides in order of cells, compared as arrays of a batch.

    Rows are shuffled and sorted as they are, before they grow to unit vectors; a site's place goes in the column of
    the sources' one where that is a double.
    """
    types = {f.name: f.dataType for f in left.schema.fields}
    place = []
    for c, name in zip(left_pos, ("_pra", "_pdec")):
        if types.get(c) == DoubleType() and c not in on:
            place.append(c)
        else:
            left, place = left.withColumn(name, F.col(c).cast("double")), [*place, name]
    sites = copies.where(" and ".join(f"`{k}` is not null" for k in on))
    sites = sites.select(*[F.col(k).cast(types[k]).alias(k) for k in on], "_s", F.col("_ra").alias(place[0]), F.col("_dec").alias(place[1]))
    both = left.unionByName(sites, allowMissingColumns=True)
    both = both.repartition(*on).sortWithinPartitions(*on, F.col("_s").isNull())
    x, y, z = unit_vector(*[F.col(c) for c in place])
    both = both.withColumns({"_lx": x, "_ly": y, "_lz": z})
    xyz = (F.col("_lx"), F.col("_ly"), F.col("_lz"))
    site = F.struct("_s", *[c.alias(f"_{c_}") for c, c_ in zip(xyz, "xyz")])
    both = both.withColumn("_site", F.when(F.col("_s").isNotNull(), site))
    near = _near_sites(both.schema["_site"].dataType)
    found = both.withColumn("_sites", near("_site", *xyz, *on)).where("_s is null")
    found = _once(found, _ranked(F.col("_sites"), *xyz, hit), hit).drop("_sites", "_site", "_s", "_pra", "_pdec", "_lx", "_ly", "_lz")
    return found if how == "left" else found.where("_best is not null")


def _close_first(
    left: DataFrame, left_pos: tuple[str, str], sites: DataFrame, radius: float | Column, keys: list[str],
    all_sites: DataFrame, on: list[str], levels: Sequence[float], most: int,
) -> DataFrame:
    """``_near`` (the nearest site however far, as ``nearest_by_descent``) by a join within a close ``radius`` (arcsec).

    Positions without a site that near, or in cells of more than ``most`` sites, descend into ``all_sites`` (by ``on``).
    Positions alone are searched, and what they found is written once, for the rest and for the rows.
    """
    radius_deg = radius / 3600.0
    h = radius_deg * 4
    copies = sky_cells(sites, "_ra", "_dec", radius_deg, copies=True, h=h, out="_close")
    near_on = [*keys, "_close"]
    hot = cut_lineage(copies.groupBy(*near_on).agg(F.count("*").alias("_n")).where(F.col("_n") > most).select(*near_on))
    if not hot.isEmpty():
        copies = copies.join(hot, near_on, "left_anti")
    ra, dec = (F.col(c).cast("double") for c in left_pos)
    at = [*dict.fromkeys([*on, *keys]), "_ara", "_adec"]
    left = left.withColumns({"_ara": ra, "_adec": dec})
    places = left.select(*at).where(" and ".join(f"`{c}` is not null" for c in at)).distinct()
    places = places.withColumn("_close", own_cell(F.col("_ara"), F.col("_adec"), h))
    near = _within_dense(places, ("_ara", "_adec"), copies, near_on, lambda b: b["raw"] <= radius - CLOSE_EDGE, "left")
    near = stored(near.withColumnRenamed("_best", "_near").drop("_close"), "near")
    rest = near.where("_near is null").select(*at)
    if not rest.isEmpty():
        if on != keys:
            all_sites = all_sites.join(rest.select(*on).distinct(), on, "left_semi")
        far = nearest_by_descent(rest, ("_ara", "_adec"), all_sites, on, levels)
        near = near.where("_near is not null").unionByName(far)
    return left.join(near, at, "left").drop("_ara", "_adec")


def sky_match(
    left: DataFrame,
    right: DataFrame,
    radius: float | Column,
    *,
    left_pos: tuple[str, str] = ("alpha_j2000", "delta_j2000"),
    right_pos: tuple[str, str] = ("raj2000", "dej2000"),
    right_id: str = "ref_id",
    right_cols: Sequence[str] = (),
    keys: Sequence[str] = (),
    prefix: str = "ref_",
    sep_col: str = "sep",
    how: str = "inner",
    inclusive: bool = False,
    dense: int = DENSE,
    raw_col: str | None = None,
    limit: Column | None = None,
) -> DataFrame:
    """Nearest right row within ``radius`` arcsec of every left row; with ``limit``, closer than that column too.

    A column as ``radius`` is an expression of ``keys``, which both sides have.

    Adds ``sep`` (arcsec, 6 decimals), the right id and ``right_cols``; ``raw_col``
    also holds the separation that was compared. Separations equal to 6 decimals tie
    and the smaller id wins. ``how="left"`` keeps unmatched rows with nulls.
    """
    keys, cols = list(keys), list(right_cols)
    radius_deg = radius / 3600.0
    h = cell_height(radius_deg)
    sites = _reference_sites(right, right_pos, right_id, keys, cols)
    copies = sky_cells(sites, "_ra", "_dec", radius_deg, copies=True, h=h, out="_cell")
    lra, ldec = (F.col(c).cast("double") for c in left_pos)
    sources = left.withColumn("_cell", own_cell(lra, ldec, h))
    on = keys + ["_cell"]

    def hit(b: Column) -> Column:
        near = (b["raw"] <= radius) if inclusive else (b["raw"] < radius)
        return near if limit is None else near & (b["raw"] < limit)

    counts = copies.groupBy(*on).agg(F.count("*").alias("_n"))
    typical, largest = counts.agg(F.sum(F.col("_n") * F.col("_n")) / F.sum("_n"), F.max("_n")).first()
    few, side = typical is None or typical <= dense / SPARSE, "left" if how == "left" else "inner"
    if few and (largest is None or largest <= dense):
        found = _within(sources, left_pos, copies, on, radius_deg, hit, side)
    elif not few and typical <= CROWDED * dense and largest <= CROWDED**2 * dense:
        found = _within_dense(sources, left_pos, copies, on, hit, side)
    else:
        busy, busy_copies = sources, copies
        if few:
            crowded = cut_lineage(counts.where(F.col("_n") > dense))  # a row for that many reference positions
            busy, busy_copies = (df.join(crowded, on, "left_semi") for df in (sources, copies))
            sources, copies = (df.join(crowded, on, "left_anti") for df in (sources, copies))
            typical = crowded.agg(F.sum(F.col("_n") * F.col("_n")) / F.sum("_n")).first()[0]
        # a cell of four radii with its margin covers 36 square radii
        share = min(1.0, math.sqrt(CLOSE * 36 / (math.pi * typical)))
        far = _close_first(
            busy, left_pos, sites, radius * share, keys, busy_copies, on, [h / 4**i for i in range(1, 10)], CROWDED * DENSE,
        )
        far = _once(far, F.col("_near"), hit).drop("_near")
        found = far if not few else _within(sources, left_pos, copies, on, radius_deg, hit, side).unionByName(far)
    if how == "inner":
        found = found.where(F.col("_best").isNotNull())
    if raw_col:
        found = found.withColumn(raw_col, F.col("_best.raw"))
    return _spread(found, right_id, cols, prefix, sep_col).drop("_cell")


def sky_nearest(
    left: DataFrame,
    right: DataFrame,
    *,
    left_pos: tuple[str, str] = ("alpha_j2000", "delta_j2000"),
    right_pos: tuple[str, str] = ("alpha_j2000", "delta_j2000"),
    right_id: str = "number",
    right_cols: Sequence[str] = (),
    keys: Sequence[str] = (),
    prefix: str = "near_",
    sep_col: str = "sep",
) -> DataFrame:
    """Nearest right row however far; rows whose key has no right row get nulls."""
    keys, cols = list(keys), list(right_cols)
    sites = _reference_sites(right, right_pos, right_id, keys, cols)
    radius = _close_radius(sites, keys)
    if radius is None:
        near = nearest_by_descent(left, left_pos, sites, keys, TREE_LEVELS)
    else:
        near = _close_first(left, left_pos, sites, radius, keys, sites, keys, TREE_LEVELS, CROWDED * DENSE)
    return _spread(near.withColumnRenamed("_near", "_best"), right_id, cols, prefix, sep_col)


def _nested_cell(ra: Column, dec: Column, size: float) -> Column:
    return F.shiftleft(F.floor((dec + 90.0) / size).cast("long"), 32) + F.floor(ra / size).cast("long")


def _close_radius(sites: DataFrame, keys: list[str]) -> float | None:
    """Arcsec within which a site has about ``CLOSE`` others of its key; None if the keys are small."""
    names = [f"_c{i}" for i in range(len(TREE_LEVELS))]
    cells = sites.select(*keys, *[_nested_cell(F.col("_ra"), F.col("_dec"), s).alias(c) for c, s in zip(names, TREE_LEVELS)])
    counts = cells.rollup(*keys, *names).agg(F.count("*").alias("_n"), F.grouping_id().alias("_gid"))
    load = F.sum(F.col("_n") * F.col("_n")) / F.sum("_n")
    loads = {r["_gid"]: r["n"] for r in counts.groupBy("_gid").agg(load.alias("n")).collect()}
    # a level is grouped by its cell and all coarser ones; the last is grouped by the keys only
    if loads.get((1 << len(names)) - 1, 0) <= DENSE:
        return None
    for i in reversed(range(len(names))):
        n = loads[(1 << (len(names) - 1 - i)) - 1]
        if n >= CLOSE:
            return TREE_LEVELS[i] * math.sqrt(CLOSE / (math.pi * n)) * 3600
    return None


def _tree_shape(sites: DataFrame, keys: list[str], levels: list[float]) -> tuple[int, int]:
    """(first level, leaf level) from the largest occupancies; -1 leaf means no tree is needed."""
    names = [f"_c{i}" for i in range(len(levels))]
    gid = F.grouping_id().alias("_gid")
    counts = sites.rollup(*keys, *names).agg(F.count("*").alias("_n"), gid)
    per_key = counts.groupBy("_gid", *keys).agg(F.max("_n").alias("_max"), F.count("*").alias("_cells"))
    rows = per_key.groupBy("_gid").agg(F.max("_max").alias("m"), F.max("_cells").alias("c")).collect()
    shape = {r["_gid"]: r for r in rows}
    if not rows:
        return 0, -1
    whole = shape.get((1 << len(names)) - 1)
    if whole is not None and whole["m"] <= DENSE:
        return 0, -1
    # level i is grouped by its cell and all coarser ones
    level = [shape[(1 << (len(names) - 1 - i)) - 1] for i in range(len(names))]
    start = max([i for i, r in enumerate(level) if r["c"] <= ROOTS], default=0)
    leaf = next((i for i, r in enumerate(level) if i >= start and r["m"] <= LEAF), len(levels) - 1)
    return start, leaf


def nearest_by_descent(
    left: DataFrame, left_pos: tuple[str, str], sites: DataFrame, keys: Sequence[str], levels: Sequence[float]
) -> DataFrame:
    """Exact nearest site per left row by branch and bound over nested cells.

    Each level is an equi-join on the parent cell that keeps the children whose
    nearest possible member is not farther than the best member seen so far. Adds
    ``_near = struct(sep, s, raw)``. Equal left positions are searched once.
    """
    keys, levels = list(keys), list(levels)
    ra, dec = (F.col(c).cast("double") for c in left_pos)
    pos = keys + ["_lra", "_ldec"]
    left = left.withColumns({"_lra": ra, "_ldec": dec})
    sites = _site_struct(
        sites.withColumns({f"_c{i}": _nested_cell(F.col("_ra"), F.col("_dec"), s) for i, s in enumerate(levels)})
    )
    start, leaf = _tree_shape(sites, keys, levels)
    if not keys:
        # a constant key keeps this an equi-join; the other side is one short row
        keys = ["_one"]
        pos = keys + pos
        left, sites = left.withColumn("_one", F.lit(1)), sites.withColumn("_one", F.lit(1))
    x, y, z = unit_vector("_lra", "_ldec")
    cand = left.select(*pos).where(F.col("_lra").isNotNull() & F.col("_ldec").isNotNull()).distinct()
    cand = cand.withColumns({"_lx": x, "_ly": y, "_lz": z})
    xyz = (F.col("_lx"), F.col("_ly"), F.col("_lz"))
    own = [*pos, "_lx", "_ly", "_lz"]
    tree = {i: _cells(sites, keys, [f"_c{i - 1}"] if i > start else [], f"_c{i}") for i in range(start, leaf + 1)}
    # first bound: one member of the source's own cell, at the finest level where that cell is occupied
    bounds = [F.lit(2.1)]
    for i, cells in tree.items():
        here = f"_own{i}"
        member = cells.select(*keys, F.col(f"_c{i}").alias(here), *[F.col(c).alias(f"{c}{i}") for c in ("rx", "ry", "rz")])
        cand = cand.withColumn(here, _nested_cell(F.pmod(F.col("_lra"), F.lit(360.0)), F.col("_ldec"), levels[i]))
        cand = cand.join(member, [*keys, here], "left")
        bounds.append(F.sqrt(_chord2(*xyz, *[F.col(f"{c}{i}") for c in ("rx", "ry", "rz")])))
    bound = F.least(*bounds) if len(bounds) > 1 else bounds[0]
    cand = cand.select(*own, bound.alias("_ub"))
    parent: list[str] = []
    for i, cells in tree.items():
        # chords obey the triangle inequality: a member is at least (centre - radius) away
        edge = F.sqrt(_chord2(*xyz, F.col("cx"), F.col("cy"), F.col("cz"))) - F.col("rad")
        cand = cand.join(cells, keys + parent).where(edge <= F.col("_ub") + SLACK)
        if i < leaf:
            # share the best representative of a source's cells before going deeper
            seen = F.least("_ub", F.sqrt(_chord2(*xyz, F.col("rx"), F.col("ry"), F.col("rz"))))
            cand = cand.withColumn("_ub", F.min(seen).over(Window.partitionBy(*pos))).where(edge <= F.col("_ub") + SLACK)
        cand = cand.select(*own, "_ub", f"_c{i}")
        parent = [f"_c{i}"]
    members = sites.select(*keys, *parent, "_s", "_x", "_y", "_z")
    chord2 = _chord2(*xyz, F.col("_x"), F.col("_y"), F.col("_z"))
    limit = F.col("_ub") + SLACK
    near = cand.join(members, keys + parent).where(chord2 <= limit * limit)
    measured = _hit_struct(chord_angle(*xyz, F.col("_x"), F.col("_y"), F.col("_z")), F.col("_s"))
    near = near.groupBy(*pos).agg(F.min(measured).alias("_near"))
    return left.join(near, pos, "left").drop("_lra", "_ldec", "_one")


def _cells(sites: DataFrame, keys: list[str], parent: list[str], cell: str) -> DataFrame:
    """Occupied cells of one level: a bounding circle (centre, radius as a chord) and one member."""
    members = sites.groupBy(*keys, *parent, cell).agg(
        F.min("_ra").alias("a0"), F.max("_ra").alias("a1"), F.min("_dec").alias("d0"), F.max("_dec").alias("d1"),
        F.min(F.struct("_x", "_y", "_z")).alias("rep"),
    )
    mid_ra, mid_dec = (F.col("a0") + F.col("a1")) / 2, (F.col("d0") + F.col("d1")) / 2
    cx, cy, cz = unit_vector(mid_ra, mid_dec)
    # along the middle parallel, then along a meridian: never shorter than the true distance
    radius = F.radians(F.col("d1") - F.col("d0")) / 2 + F.radians(F.col("a1") - F.col("a0")) / 2 * F.cos(F.radians(mid_dec))
    return members.select(
        *keys, *parent, cell, cx.alias("cx"), cy.alias("cy"), cz.alias("cz"), radius.alias("rad"),
        F.col("rep._x").alias("rx"), F.col("rep._y").alias("ry"), F.col("rep._z").alias("rz"),
    )


def radius_class(radius: Column) -> Column:
    """Power of ``CLASS_STEP`` (from ``CLASS_BASE`` arcsec) that holds a radius."""
    power = F.ceil(F.log(float(CLASS_STEP), F.greatest(radius, F.lit(CLASS_BASE)) / CLASS_BASE) - 1e-9)
    return F.least(F.greatest(power, F.lit(0)), F.lit(CLASSES - 1)).cast("int")


def class_match(
    left: DataFrame, right: DataFrame, radius: Column, *, keys: Sequence[str] = (), raw_col: str | None = None,
    class_col: str | None = None, **match_args,
) -> DataFrame:
    """Nearest right row closer than each left row's own ``radius`` (arcsec, a column); ``class_col`` gets its class.

    Cells of all classes share one equi-join, on class, key and cell: a reference star is copied into the cells of the
    classes that the sources of its key have. Null radii match nothing.
    """
    keys = list(keys)
    left = left.withColumns({"_reach": radius.cast("double"), "_class": radius_class(radius)}).where("_reach is not null")
    classes = left.select(*keys, "_class").distinct()
    if keys:
        copies = right.join(classes, keys)
    else:  # as many rows as classes, on a constant key
        copies = right.withColumn("_one", F.lit(1)).join(classes.withColumn("_one", F.lit(1)), "_one").drop("_one")
    size = F.lit(CLASS_BASE) * F.pow(F.lit(float(CLASS_STEP)), F.col("_class"))
    found = sky_match(left, copies, size, keys=[*keys, "_class"], raw_col=raw_col, limit=F.col("_reach"), **match_args)
    if class_col:
        found = found.withColumn(class_col, F.col("_class"))
    return found.drop(*{"_reach", "_class"} - {class_col})


def adaptive_match(
    left: DataFrame,
    right: DataFrame,
    *,
    group: Sequence[str],
    rms: str,
    min_n: int = 50,
    max_k: int = 5,
    default_radius: float = 0.5,
    **match_args,
) -> DataFrame:
    """Grow the radius ``k * rms`` (k = 1..max_k) per group until more than ``min_n`` rows match.

    ``rms`` is a left column (arcsec, one value per group); groups without it use
    ``default_radius``. One match at a group's largest radius serves all k: a row
    belongs to radius k exactly when its nearest separation is below ``k * rms``.
    Groups are matched in cells of their own radius class, so a wide one widens no
    other's cells. The match is written once; its counts and its rows are read from there.
    """
    group = list(group)
    found = class_match(left, right, F.coalesce(F.col(rms) * max_k, F.lit(default_radius)), raw_col="_raw", class_col="_class", **match_args)
    found = stored(found, "matched")
    sep = F.col("_raw")
    per_k = found.groupBy(*group).agg(
        *[F.count_if(sep < F.col(rms) * k).alias(f"_n{k}") for k in range(1, max_k)]
    )
    chosen = None
    for k in range(1, max_k):
        enough = F.col(f"_n{k}") > min_n
        chosen = F.when(enough, F.lit(k)) if chosen is None else chosen.when(enough, F.lit(k))
    chosen = chosen.otherwise(F.lit(max_k)) if chosen is not None else F.lit(max_k)
    per_group = per_k.select(*group, chosen.alias("match_k"))
    limit = F.coalesce(F.col(rms) * F.col("match_k"), F.lit(default_radius))
    return (
        found.join(per_group, group)
        .withColumn("match_radius", limit)
        .withColumn("match_k", F.when(F.col(rms).isNotNull(), F.col("match_k")))
        .where(sep < F.col("match_radius"))
        .drop("_raw", "_class")
    )


def nearest_tile(
    exposures: DataFrame, tiles: DataFrame, max_sep_deg: float = 1.0, pos: tuple[str, str] = ("ra", "dec")
) -> DataFrame:
    """Nearest grid tile (``field, ra, dec[, radec]``) up to ``max_sep_deg``; others are dropped."""
    extra = [c for c in ("radec",) if c in tiles.columns]
    found = sky_match(
        exposures, tiles, max_sep_deg * 3600.0, left_pos=pos, right_pos=("ra", "dec"), right_id="field",
        right_cols=extra, prefix="tile_", sep_col="tile_sep", inclusive=True,
    )
    return found.withColumns(
        {"tile_field": F.lpad(F.col("tile_field").cast("string"), 4, "0"), "tile_sep": F.col("tile_sep") / 3600.0}
    )


def moving_object_flag(
    candidates: DataFrame,
    ephemeris: DataFrame,
    *,
    keys: Sequence[str] = (),
    radius: float = 5.0,
    ephemeris_pos: tuple[str, str] = ("ra", "dec"),
    ephemeris_id: str = "object_id",
    out: str = "flag_0",
) -> DataFrame:
    """True where a known moving object (same ``keys``, e.g. epoch and image) is within 5 arcsec."""
    found = sky_match(
        candidates, ephemeris, radius, right_pos=ephemeris_pos, right_id=ephemeris_id, keys=keys,
        prefix="mov_", sep_col="mov_sep", how="left",
    )
    return found.withColumn(out, F.col("mov_sep").isNotNull()).drop("mov_sep", "mov_" + ephemeris_id)


def attach(left: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Scalar statistics of an image back onto its rows; AQE broadcasts them when they are small."""
    return left.join(stats, list(keys), "left")
