"""Exact medians and iterative sigma clipping, safe for groups of any size.

Clipping keeps an interval of values, so its whole state per group is that
interval. Groups up to ``LARGE`` rows are clipped inside one Arrow group (values
only); larger groups take distributed passes, each one aggregate over the group.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from skyflow.session import cut_lineage, stored

# Largest group that is handed to one task as a block of doubles (8 MB).
LARGE = 1_000_000
# Sketch accuracy and half width of the rank bracket around the middle.
ACCURACY, BRACKET = 10000, 0.001


def null_if_nan(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def exact_median(df: DataFrame, keys: Sequence[str], col: str, out: str = "median") -> DataFrame:
    """Exact grouped median (even counts averaged) without holding a group in one task.

    A mergeable quantile sketch brackets the middle ranks; only the values inside
    the bracket (about 0.2 % of a large group) are then ranked.
    """
    keys = list(keys)
    values = df.select(*keys, F.col(col).cast("double").alias("_v"))
    values = values.where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    key = keys or ["_all"]
    if not keys:
        values = values.withColumn("_all", F.lit(1))
    # middle element(s): 0-based ranks (n-1) div 2 and n div 2
    bracket = values.groupBy(*key).agg(
        F.percentile_approx("_v", [0.5 - BRACKET, 0.5 + BRACKET], ACCURACY).alias("_b"), F.count("*").alias("_n")
    )
    tagged = _null_safe_join(values, bracket, key, "inner")
    lo, hi = F.col("_b")[0], F.col("_b")[1]
    # everything below the bracket collapses to one row per key
    counted = (
        tagged.where(F.col("_v") <= hi)
        .withColumn("_v", F.when(F.col("_v") >= lo, F.col("_v")))
        .groupBy(*key, "_v")
        .agg(F.count("*").alias("_c"), F.first("_n").alias("_n"))
    )
    upto = F.sum("_c").over(Window.partitionBy(*key).orderBy(F.col("_v").asc_nulls_first()))
    ranked = counted.withColumn("_hi", upto).withColumn("_lo", F.col("_hi") - F.col("_c"))
    first, second = F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2)

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_lo") <= rank) & (rank < F.col("_hi")), F.col("_v")))

    result = ranked.groupBy(*key).agg(((at(first) + at(second)) / 2).alias(out))
    return result.select(*keys, out)


def exact_medians(df: DataFrame, keys: Sequence[str], columns: dict[str, Column]) -> DataFrame:
    """Exact grouped medians of several values in one pass: ``keys`` and a column per name."""
    keys = list(keys)
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("n"), c.cast("double").alias("v")) for n, c in columns.items()]))
    long = df.select(*keys, each.alias("_e")).select(*keys, F.col("_e.n").alias("_name"), F.col("_e.v").alias("_value"))
    found = exact_median(long, [*keys, "_name"], "_value", "_m")
    return found.groupBy(*keys).agg(*[F.max(F.when(F.col("_name") == n, F.col("_m"))).alias(n) for n in columns])


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join that also pairs null keys with null keys."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        cond = c if cond is None else cond & c
    joined = left.join(renamed, cond, how)
    return joined if how in ("left_anti", "left_semi") else joined.drop(*[f"_r_{k}" for k in keys])


def clip_values(v: np.ndarray, sigma: float, maxiters: int | None) -> tuple[float, float, int]:
    """Kept interval of a block of values and the number of passes that removed something."""
    v = np.sort(v)
    passes = 0
    while v.size and (maxiters is None or passes < maxiters):
        keep = v[np.abs(v - np.median(v)) <= sigma * np.std(v)]
        if keep.size in (0, v.size):
            break
        v, passes = keep, passes + 1
    return float(v[0]), float(v[-1]), passes


def large_groups(
    values: DataFrame, keys: Sequence[str], large: int | None = None, bound: DataFrame | None = None
) -> DataFrame | None:
    """Keys of the groups above ``large`` rows, or None when there are none.

    ``bound`` is a cheaper table with at least as many rows per group (for example
    the catalogue before a match); when it has no large group, ``values`` has none
    and its own plan need not run for the check.
    """
    limit = LARGE if large is None else large

    def over(df: DataFrame) -> DataFrame:
        return df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > limit).select(*keys)

    if bound is not None and over(bound).isEmpty():
        return None
    big = over(values)
    return None if big.isEmpty() else big


def split_large(
    values: DataFrame, keys: Sequence[str], large: int | None = None, bound: DataFrame | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """``values`` and the keys of their groups above ``large`` rows, or None when there are none.

    Values that may have large groups are written once and read from there: each pass over a large group reads them,
    and none of them runs the plan (a match, say) that they come from. ``bound`` is as in ``large_groups``.
    """
    if bound is not None:
        if large_groups(bound.select(*keys), keys, large) is None:
            return values, None
        values = stored(values, "values")
        return values, large_groups(values, keys, large)
    if large_groups(values, keys, large) is None:
        return values, None
    values = stored(values, "values")
    return values, large_groups(values, keys, large)


def clip_bounds(
    df: DataFrame, keys: Sequence[str], col: str, sigma: float, maxiters: int | None = None,
    large: int | None = None, bound: DataFrame | None = None,
) -> DataFrame:
    """Per group the smallest and largest kept value: ``keys, clip_lo, clip_hi, clip_passes``."""
    keys = list(keys)
    values = df.select(*keys, F.col(col).cast("double").alias("_v"))
    values = values.where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    if not keys:
        return clip_bounds(
            values.withColumn("_all", F.lit(1)), ["_all"], "_v", sigma, maxiters, large
        ).drop("_all")
    values, big = split_large(values, keys, large, bound)
    small = values if big is None else _null_safe_join(values, big, keys, "left_anti")
    schema = T.StructType(
        [values.schema[k] for k in keys]
        + [
            T.StructField("clip_lo", T.DoubleType()),
            T.StructField("clip_hi", T.DoubleType()),
            T.StructField("clip_passes", T.IntegerType()),
        ]
    )

    def one_group(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        lo, hi, passes = clip_values(block["_v"].to_numpy(), sigma, maxiters)
        return pd.DataFrame([[*key, lo, hi, passes]], columns=schema.names)

    bounds = small.groupBy(*keys).applyInPandas(one_group, schema)
    if big is not None:
        distributed = _clip_passes(_null_safe_join(values, big, keys, "left_semi"), keys, sigma, maxiters)
        bounds = bounds.unionByName(distributed.select(*schema.names))
    return bounds


def _clip_passes(values: DataFrame, keys: list[str], sigma: float, maxiters: int | None) -> DataFrame:
    """Clipping of large groups, written before: each pass narrows ``[clip_lo, clip_hi]`` by one aggregate."""
    state = values.groupBy(*keys).agg(
        F.min("_v").alias("clip_lo"), F.max("_v").alias("clip_hi"), F.count("*").alias("_n"),
        F.lit(0).alias("clip_passes"), F.lit(False).alias("_done"),
    )
    state = cut_lineage(state)
    passes = 0
    while (maxiters is None or passes < maxiters) and not state.where(~F.col("_done")).isEmpty():
        kept = _within(values, state.where(~F.col("_done")), keys)
        spread = kept.groupBy(*keys).agg(F.stddev_pop("_v").alias("_std"))
        limits = _null_safe_join(spread, exact_median(kept, keys, "_v", "_med"), keys, "inner")
        inside = F.abs(F.col("_v") - F.col("_med")) <= sigma * F.col("_std")
        narrowed = (
            _null_safe_join(kept, limits, keys, "inner")
            .where(inside)
            .groupBy(*keys)
            .agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count("*").alias("_kept"))
        )
        joined = _null_safe_join(state, narrowed, keys, "left")
        moved = F.coalesce(F.col("_kept") < F.col("_n"), F.lit(False))
        state = cut_lineage(
            joined.select(
                *keys,
                F.when(moved, F.col("_lo")).otherwise(F.col("clip_lo")).alias("clip_lo"),
                F.when(moved, F.col("_hi")).otherwise(F.col("clip_hi")).alias("clip_hi"),
                F.when(moved, F.col("_kept")).otherwise(F.col("_n")).alias("_n"),
                (F.col("clip_passes") + moved.cast("int")).alias("clip_passes"),
                (~moved).alias("_done"),
            )
        )
        passes += 1
    return state.select(*keys, "clip_lo", "clip_hi", "clip_passes")


def _within(values: DataFrame, bounds: DataFrame, keys: Sequence[str]) -> DataFrame:
    return (
        _null_safe_join(values, bounds.select(*keys, "clip_lo", "clip_hi"), list(keys), "inner")
        .where(F.col("_v").between(F.col("clip_lo"), F.col("clip_hi")))
        .drop("clip_lo", "clip_hi")
    )


def sigma_clip(
    df: DataFrame, keys: Sequence[str], col: str, sigma: float = 3.0, maxiters: int | None = None,
    out: str = "kept", large: int | None = None, bound: DataFrame | None = None,
) -> DataFrame:
    """Every row with a boolean ``kept``; rows without a value are null."""
    keys = list(keys)
    bounds = clip_bounds(df, keys, col, sigma, maxiters, large, bound).drop("clip_passes")
    if keys:
        joined = _null_safe_join(df, bounds, keys, "left")
    else:
        joined = df.withColumn("_all", F.lit(1)).join(bounds.withColumn("_all", F.lit(1)), "_all", "left").drop("_all")
    v = F.col(col).cast("double")
    kept = F.when(~F.isnan(v), v.between(F.col("clip_lo"), F.col("clip_hi")))
    return joined.withColumn(out, kept).drop("clip_lo", "clip_hi")


def clip_summary(
    df: DataFrame, keys: Sequence[str], col: str, sigma: float = 3.0, maxiters: int | None = None,
    large: int | None = None, bound: DataFrame | None = None,
) -> DataFrame:
    """Statistics of the kept values: ``n_all, n_kept, mean, median, std, rms`` per group.

    Small groups yield everything from the one Arrow block they are clipped in;
    large groups aggregate inside their clip bounds.
    """
    keys = list(keys)
    if not keys:
        tagged = df.withColumn("_all", F.lit(1))
        return clip_summary(tagged, ["_all"], col, sigma, maxiters, large).drop("_all")
    values = df.select(*keys, F.col(col).cast("double").alias("_v"))
    values = values.where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    values, big = split_large(values, keys, large, bound)
    small = values if big is None else _null_safe_join(values, big, keys, "left_anti")
    names = ["n_all", "n_kept", "mean", "median", "std", "rms"]
    schema = T.StructType(
        [values.schema[k] for k in keys]
        + [T.StructField(n, T.LongType() if n.startswith("n_") else T.DoubleType()) for n in names]
    )

    def one_group(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        v = block["_v"].to_numpy()
        lo, hi, _ = clip_values(v, sigma, maxiters)
        k = v[(v >= lo) & (v <= hi)]
        row = [*key, v.size, k.size, k.mean(), np.median(k), k.std(), np.sqrt(np.mean(k * k))]
        return pd.DataFrame([row], columns=schema.names)

    stats = small.groupBy(*keys).applyInPandas(one_group, schema)
    if big is None:
        return stats
    huge = _null_safe_join(values, big, keys, "left_semi")
    kept = _within(huge, _clip_passes(huge, keys, sigma, maxiters), keys)
    agg = kept.groupBy(*keys).agg(
        F.count("*").alias("n_kept"), F.avg("_v").alias("mean"), F.stddev_pop("_v").alias("std"),
        F.sqrt(F.avg(F.col("_v") * F.col("_v"))).alias("rms"),
    )
    totals = huge.groupBy(*keys).agg(F.count("*").alias("n_all"))
    return stats.unionByName(
        _null_safe_join(_null_safe_join(totals, agg, keys, "inner"), exact_median(kept, keys, "_v"), keys, "inner").select(*schema.names)
    )
