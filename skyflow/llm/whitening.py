"""Whitening of embeddings from the singular values of their centred rows; the covariance matrix is never formed.

Tasks reduce their centred rows to a triangle by blockwise QR, triangles are stacked and reduced again in a tree. The
last one (dimensions x dimensions) comes to the driver, where Householder reflections make it bidiagonal, the shifted
differential quotient-difference algorithm (dqds) finds all singular values, and twisted factorisations give the
directions of the largest. A last pass measures the covariance of the whitened rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyflow.llm.common import prepare, written

#: Vectors become floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: Entries beyond this are taken as it, so that sums of a batch stay whole numbers.
LIMIT = 1 << 52
FANS = 64
EPS = float(np.finfo(float).eps)


def whole_vectors(rows: DataFrame) -> DataFrame:
    """vec_id and x, the whole-number vectors of all rows whose embedding is neither null nor holds null, NaN, infinity."""
    value = F.col("embedding").cast("array<double>")
    # null > inf is null, so a null entry has to be asked for; NaN is larger than infinity
    bad = F.exists(value, lambda v: v.isNull() | (F.abs(v) >= float("inf")))
    kept = rows.where(F.col("embedding").isNotNull() & ~bad)
    bound = lambda v: F.least(F.greatest(v * SCALE, F.lit(-float(LIMIT))), F.lit(float(LIMIT)))
    return kept.select("vec_id", F.transform(value, lambda v: F.floor(bound(v)).cast("long") + SHIFT).alias("x"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as a matrix; entries that shorter rows lack are components of zero."""
    ends, flat = np.asarray(column.offsets), column.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(ends)
    out = np.full((len(sizes), width), SHIFT, np.int64)
    out[np.arange(width) < sizes[:, None]] = flat[ends[0] : ends[-1]]
    return out


def spread_from_mean(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - sums, exactly: int64 where that holds it, else Python's whole numbers."""
    top = int(np.abs(x).max(initial=0)) * n + max((abs(int(s)) for s in sums), default=0)
    if top < 1 << 62:
        return x * n - sums.astype(np.int64)
    return x.astype(object) * n - sums


def squares(d: np.ndarray) -> list[int]:
    top = int(np.abs(d).max(initial=0))
    exact = d if d.dtype == np.int64 and top * top * d.shape[1] < 1 << 63 else d.astype(object)
    return [int(v) for v in (exact * exact).sum(1)]


def tree(parts: DataFrame, merge: Callable[[list[np.ndarray]], np.ndarray]) -> np.ndarray | None:
    """States of tasks (array columns of one length) merged in FANS tasks, then in one; None without any."""

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for b in batches:
            for item in b.column("state"):
                new = np.asarray(item.values.to_numpy())
                state = new if state is None else merge([state, new])
        if state is not None:
            yield pa.RecordBatch.from_pydict({"state": pa.array([state.tolist()], pa.list_(pa.float64()))})

    fans = parts.repartition(FANS, F.pmod("part", F.lit(FANS))).select("state").mapInArrow(merged, "state array<double>")
    found = fans.repartition(1).mapInArrow(merged, "state array<double>").collect()
    return np.array(found[0]["state"]) if found else None


def states(rows: DataFrame, step: Callable[[np.ndarray | None, np.ndarray], np.ndarray], width: int) -> DataFrame:
    """One state a task: ``step`` takes the state so far (None at first) and the next rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        state = None
        for b in batches:
            if b.num_rows:
                state = step(state, matrix(b.column("x"), width))
        if state is not None:
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "state": pa.array([state.ravel().tolist()], pa.list_(pa.float64()))})

    return rows.select("x").mapInArrow(run, "part int, state array<double>")


def column_sums(rows: DataFrame, width: int) -> tuple[int, np.ndarray]:
    """Number of rows and exact sums of their entries; tasks send one number a dimension, Spark adds them up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * width
        for b in batches:
            x = matrix(b.column("x"), width)
            for lo in range(0, len(x), 512):
                sums = [s + int(v) for s, v in zip(sums, x[lo : lo + 512].sum(0))]
            n += len(x)
        if n:
            yield pa.RecordBatch.from_pydict({"dim": pa.array(range(-1, width), pa.int32()), "s": pa.array([Decimal(v) for v in (n, *sums)], pa.decimal128(38, 0))})

    parts = rows.select("x").mapInArrow(run, "dim int, s decimal(38,0)")
    found = {r["dim"]: int(r["s"]) for r in parts.groupBy("dim").agg(F.sum("s").alias("s")).collect()}
    return found.get(-1, 0), np.array([found.get(k, 0) for k in range(width)], object)


def reflector(x: np.ndarray) -> np.ndarray | None:
    """Unit vector v with (1 - 2 v v') x along the first axis; None where x is there already."""
    rest = np.abs(x[1:]).max(initial=0)
    if rest == 0:
        return None
    v = x / max(rest, abs(x[0]))
    v[0] += np.copysign(np.linalg.norm(v), v[0])
    return v / np.linalg.norm(v)


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
    """Diagonal, superdiagonal and right reflectors of Q' r P by Householder reflections."""
    a, size, right = r.copy(), len(r), []
    for k in range(size):
        v = reflector(a[k:, k].copy())
        if v is not None:
            a[k:, k:] -= np.outer(2 * v, v @ a[k:, k:])
        if k + 2 < size:
            v = reflector(a[k, k + 1 :].copy())
            if v is not None:
                a[k:, k + 1 :] -= np.outer(a[k:, k + 1 :] @ (2 * v), v)
                right.append((k + 1, v))
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), right


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squares of the singular values of a bidiagonal matrix, falling, each to high relative accuracy."""
    found: list[float] = []
    blocks = [((diagonal**2).tolist(), (above**2).tolist(), 0.0)]
    while blocks:
        q, e, shift = blocks.pop()
        while q:
            m = len(q)
            small = next((k for k in range(m - 2, -1, -1) if e[k] <= EPS * EPS * (shift + min(q[k], q[k + 1]))), None)
            if m == 1 or small == m - 2:
                found.append(shift + q.pop())
                e = e[:-1]
                continue
            if small is not None:  # the block falls apart; both halves keep their own shift
                blocks.append((q[: small + 1], e[:small], shift))
                q, e = q[small + 1 :], e[small + 1 :]
                continue
            tau = lower_bound(q, e)
            while (new := dqds_step(q, e, tau)) is None:
                tau = tau / 4 if tau > EPS * shift else 0.0
            (q, e), shift = new, shift + tau
    return np.sort(np.array(found))[::-1]


def lower_bound(q: list[float], e: list[float]) -> float:
    """Not more than the least eigenvalue: one over the trace of the inverse (0 for a singular matrix)."""
    row = total = 0.0
    for k in range(len(q) - 1, -1, -1):
        if q[k] <= 0:
            return 0.0
        row = (1 + (e[k] * row if k < len(e) else 0.0)) / q[k]
        total += row
    return (1 - 16 * len(q) * EPS) / total if 0 < total < float("inf") else 0.0


def dqds_step(q: list[float], e: list[float], tau: float) -> tuple[list[float], list[float]] | None:
    """One transform with a shift; None where the shift was too large."""
    d, q2, e2 = q[0] - tau, [], []
    if d < 0:
        return None
    for k in range(len(e)):
        top = d + e[k]
        ratio = q[k + 1] / top if top > 0 else 0.0
        q2.append(top)
        e2.append(e[k] * ratio)
        d = d * ratio - tau if top > 0 else q[k + 1] - tau
        if d < 0:
            if d < -4 * EPS * tau:
                return None
            d = 0.0
    return [*q2, d], e2


def twisted(diagonal: np.ndarray, above: np.ndarray, value: float) -> tuple[np.ndarray, list, list]:
    """Eigenvector of B'B at ``value``, with the pivots and multipliers of its factorisation from the top."""
    size, tiny = len(diagonal), EPS * EPS * max(value, 1e-300)
    pivot = lambda p: p if abs(p) > tiny else tiny
    q, ratio = (diagonal**2).tolist(), (above / diagonal[:-1]).tolist()
    down, top, s = [], [], [-value]
    for k in range(size - 1):  # stationary, from the top
        top.append(pivot(q[k] + s[k]))
        down.append(q[k] * ratio[k] / top[k])
        s.append(down[k] * ratio[k] * s[k] - value)
    top.append(pivot(q[-1] + s[-1]))
    up, p = [0.0] * (size - 1), [0.0] * size
    p[-1] = q[-1] - value
    for k in range(size - 2, -1, -1):  # progressive, from the bottom
        share = q[k] / pivot(q[k] * ratio[k] ** 2 + p[k + 1])
        up[k] = ratio[k] * share
        p[k] = p[k + 1] * share - value
    k = min(range(size), key=lambda k: abs(s[k] + p[k] + value))
    z = np.zeros(size)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(k, size - 1):
        z[i + 1] = -up[i] * z[i]
    return z / np.linalg.norm(z), top, down


def solve(top: list, down: list, z: np.ndarray) -> np.ndarray:
    z = z.copy()
    for i in range(len(down)):
        z[i + 1] -= down[i] * z[i]
    z /= np.array(top)
    for i in range(len(down) - 1, -1, -1):
        z[i] -= down[i] * z[i + 1]
    return z / np.linalg.norm(z)


def singular(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values of a square matrix, all, and the right singular vectors of the ``count`` largest."""
    size, scale = len(r), np.abs(r).max(initial=0)
    if scale == 0:
        return np.zeros(size), np.eye(size)[:, :count]
    diagonal, above, right = bidiagonal(r / scale)
    values = dqds(diagonal, above)
    # a diagonal of zero would leave no ratios; the least change that rounding makes anyway stands in for it
    diagonal = np.where(np.abs(diagonal) < EPS * EPS, EPS * EPS, diagonal)
    vectors: list[np.ndarray] = []
    random = np.random.default_rng(0)
    for k in range(count):
        z, top, down = twisted(diagonal, above, values[k])
        near = [v for v, other in zip(vectors, values) if abs(other - values[k]) <= 1e-3 * values[0]]
        for attempt in range(6):
            rest = z.copy()
            for _ in range(2):
                for v in near:
                    rest -= (v @ rest) * v
            length = np.linalg.norm(rest)
            if length > 0.5 and attempt != 1:
                break
            # as good as parallel to a vector of a value as good as equal: inverse iteration from elsewhere
            z = solve(top, down, rest / length if length > EPS and attempt else random.standard_normal(size))
        vectors.append(rest / length)
    out = np.array(vectors).T
    for start, v in reversed(right):
        out[start:] -= np.outer(2 * v, v @ out[start:])
    return values * scale**2, out


def whiten(rows: DataFrame, components: int = 8) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error of whole vectors (``whole_vectors``).

    One row for each vector and component up to ``components`` (or the dimensions, if fewer), by falling variance;
    ``deviation`` is a whole number (decimal), exact. Shorter vectors end with components of zero; entries are whole
    numbers of at most 2^52. Null ids and rows that repeat count like any other. A component without variance, as all
    are for one vector or equal ones, has whitened and explained 0 and is left out of ``identity_error``, which is 0 if
    there are none. No rows give none. Other columns are not looked at.
    """
    prepare(rows.sparkSession)
    id_type = rows.schema["vec_id"].dataType.simpleString()
    rows = written(rows.select("vec_id", "x"), "whole-vectors")
    width = rows.agg(F.max(F.size("x"))).first()[0] or 0
    n, sums = column_sums(rows, width)
    count = min(components, width)

    def centred(x: np.ndarray) -> np.ndarray:
        return spread_from_mean(x, n, sums).astype(float) / n

    def triangle(state: np.ndarray | None, x: np.ndarray) -> np.ndarray:
        y = centred(x)
        r = np.linalg.qr(y if state is None else np.vstack([state, y]), mode="r")
        return r if len(r) == width else np.vstack([r, np.zeros((width - len(r), width))])

    def stacked(pair: list[np.ndarray]) -> np.ndarray:
        return np.linalg.qr(np.vstack([p.reshape(width, width) for p in pair]), mode="r").ravel()

    r = tree(states(rows, triangle, width), stacked) if n and width else None
    squared, directions = singular(np.zeros((width, width)) if r is None else r.reshape(width, width), count)
    total = float(squared.sum())
    seen = np.sqrt(squared[:count]) > 8 * width * EPS * np.sqrt(squared.max(initial=0))
    scaled = np.where(seen, directions / np.sqrt(np.where(seen, squared[:count] / max(n, 1), 1)), 0.0)
    explained = np.where(seen, squared[:count] / (total or 1), 0.0)

    def moments(state: np.ndarray | None, x: np.ndarray) -> np.ndarray:
        z = centred(x) @ scaled
        mean = z.mean(0)
        new = np.concatenate([[len(z)], mean, ((z - mean).T @ (z - mean)).ravel()])
        return new if state is None else joined([state, new])

    def joined(pair: list[np.ndarray]) -> np.ndarray:
        (a, m, v), (b, w, u) = ((s[0], s[1 : count + 1], s[count + 1 :]) for s in pair)
        gap = w - m
        return np.concatenate([[a + b], m + gap * (b / (a + b)), v + u + np.outer(gap, gap).ravel() * (a * b / (a + b))])

    found = tree(states(rows, moments, width), joined) if n and count else None
    error = 0.0
    if found is not None and seen.any():
        covariance = found[count + 1 :].reshape(count, count) / n
        error = float(np.abs(covariance - np.eye(count))[np.ix_(seen, seen)].max())

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column("x"), width)
            d = spread_from_mean(x, n, sums)
            deviation = pa.array([Decimal(v) for v in squares(d)], pa.decimal128(38, 0))
            row = pa.array(np.repeat(np.arange(len(x)), count))
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id").take(row), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))), pa.array(np.full(len(row), n)),
                 deviation.take(row), pa.array((d.astype(float) / n @ scaled).ravel()), pa.array(np.tile(explained, len(x))), pa.array(np.full(len(row), error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    schema = f"vec_id {id_type}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    return rows.mapInArrow(out, schema)
