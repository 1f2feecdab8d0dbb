"""Embedding whitening by a bidiagonal qd solver.

1. Every distinct vector counts once. Tasks reduce their centred rows by QR,
   block after block, to one triangle each; triangles meet in groups of
   ``FAN`` until one is left. R' R is n times the covariance, and nothing
   was squared on the way.
2. Householder reflections make R bidiagonal. dqds finds its singular values to
   high relative accuracy.
3. Each direction comes from a twisted factorisation: the factors from the top and
   from the bottom meet where the twist is least, and two short recurrences
   give the vector. Directions of close singular values are made orthogonal.
4. Rows are projected on the directions, each divided by its deviation.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, stored
from .vectors import as_long, matrix, squares, whole_vectors

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
#: Rows of a QR block, and triangles that meet in one task.
BLOCK, FAN = 4096, 64
_EPS = float(np.finfo(float).eps)
_TINY = 1e-290


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, P): r = U B P' with a on the diagonal of B and b above it."""
    r = np.array(r, dtype=float)
    d = len(r)
    p = np.eye(d)

    def reflector(x):
        """(v, beta) with (1 - beta v v') x along the first axis."""
        v, norm = x.copy(), float(np.linalg.norm(x))
        if norm == 0 or not np.any(x[1:]):
            return v, 0.0
        v[0] += math.copysign(norm, x[0])
        v /= np.abs(v).max()
        return v, 2.0 / float(v @ v)

    for k in range(d):
        v, beta = reflector(r[k:, k])
        if beta:
            r[k:, k:] -= beta * np.outer(v, v @ r[k:, k:])
            r[k + 1:, k] = 0
        if k + 2 < d:
            v, beta = reflector(r[k, k + 1:])
            if beta:
                r[k:, k + 1:] -= beta * np.outer(r[k:, k + 1:] @ v, v)
                p[:, k + 1:] -= beta * np.outer(p[:, k + 1:] @ v, v)
                r[k, k + 2:] = 0
    return np.diag(r).copy(), np.diag(r, 1).copy(), p


def _qd_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float]:
    """One differential qd step with shift; the last number is the least d, below 0
    if the shift was too large."""
    out_q, out_e = [], []
    d = q[0] - shift
    least = d
    for i in range(len(e)):
        total = d + e[i]
        if d < 0 or total <= 0:
            return q, e, -1.0
        t = q[i + 1] / total
        out_q.append(total)
        out_e.append(e[i] * t)
        d = d * t - shift
        if d < least:
            least = d
    out_q.append(d)
    return out_q, out_e, least


def singular_values_squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squares of the singular values of the bidiagonal matrix, largest first, by dqds."""
    scale = float(max(np.abs(a).max(initial=0), np.abs(b).max(initial=0)))
    if scale == 0:
        return np.zeros(len(a))
    q = [max(float(x / scale) ** 2, _TINY) for x in a]
    e = [float(x / scale) ** 2 for x in b]
    found = []
    work = [(q, e, 0.0)]
    while work:
        q, e, sigma = work.pop()
        steps = 0
        while True:
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= _EPS ** 2 * (sigma + min(q[i], q[i + 1]))), None)
            if cut is not None:  # two parts that do not touch
                work.append((q[:cut + 1], e[:cut], sigma))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            if len(q) == 1:
                found.append(sigma + q[0])
                break
            if 1.5 * q[0] < q[-1] and steps % 8 == 0:  # the small values should be at the end
                q, e = q[::-1], e[::-1]
            steps += 1
            if steps > 60 * len(q) + 200:
                raise ArithmeticError("dqds does not converge")
            # a little below the smaller eigenvalue of the last two rows; halved while too large, then 0
            half, product = (q[-2] + e[-1] + q[-1]) / 2, q[-2] * q[-1]
            shift = product / (half + math.sqrt(max(half * half - product, 0.0))) * (1 - 4 * _EPS)
            if sigma == 0 and steps <= 2:
                shift = 0.0
            for tried in (shift, shift * 0.9, shift * 0.5, shift * 0.1, 0.0):
                new_q, new_e, least = _qd_step(q, e, tried)
                if least >= 0:
                    break
            q, e, sigma = [max(x, _TINY) for x in new_q], new_e, sigma + tried
    return np.sort(np.array(found))[::-1] * scale ** 2


def _twisted(q: np.ndarray, low: np.ndarray, lam: float) -> np.ndarray:
    """Unit eigenvector of L D L' (D = q, L unit lower bidiagonal with ``low``) for lam."""
    n = len(q)
    safe = lambda x: x if abs(x) > _TINY else _TINY
    s, p = np.empty(n), np.empty(n)
    down, up = np.empty(n - 1), np.empty(n - 1)
    s[0] = -lam
    for i in range(n - 1):
        down[i] = q[i] * low[i] / safe(s[i] + q[i])
        s[i + 1] = down[i] * low[i] * s[i] - lam
    p[-1] = q[-1] - lam
    for i in range(n - 2, -1, -1):
        t = q[i] / safe(q[i] * low[i] ** 2 + p[i + 1])
        up[i] = low[i] * t
        p[i] = p[i + 1] * t - lam
    twist = s + p + lam
    r = int(np.argmin(np.where(np.isfinite(twist), np.abs(twist), np.inf)))
    z = np.zeros(n)
    z[r] = 1.0
    for i in range(r - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(r, n - 1):
        z[i + 1] = -up[i] * z[i]
    return z / np.linalg.norm(z)


def _inverse_iteration(t: np.ndarray, lam: float, others: list[np.ndarray], seed: int) -> np.ndarray:
    """A unit eigenvector for lam, orthogonal to ``others``."""
    z = np.random.default_rng(seed).normal(size=len(t))
    shifted = t - lam * (1 + 4 * _EPS) * np.eye(len(t))
    for _ in range(4):
        z = np.linalg.lstsq(shifted, z, rcond=None)[0] if np.linalg.cond(shifted) > 1e300 else np.linalg.solve(shifted, z)
        for _ in range(2):
            for o in others:
                z = z - (o @ z) * o
        z /= np.linalg.norm(z)
    return z


def directions(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """All eigenvalues of r' r, largest first, and its first ``count`` unit eigenvectors as columns.

    Eigenvalues below the rounding error of r have no direction of their own;
    their columns are 0 and they count as 0.
    """
    d = r.shape[1]
    used = np.flatnonzero(np.abs(r).sum(axis=0) > 0)
    values, vectors = np.zeros(d), np.zeros((d, min(count, d)))
    if not len(used):
        return values, vectors
    square = np.linalg.qr(r[:, used], mode="r")
    square = np.vstack([square, np.zeros((len(used) - len(square), len(used)))]) if len(square) < len(used) else square
    a, b, p = bidiagonal(square)
    norm = float(max(np.abs(a).max(), np.abs(b).max(initial=0)))
    a = np.where(np.abs(a) < norm * 1e-140, norm * 1e-140, a)
    edges = np.flatnonzero(np.abs(b) <= _EPS * norm * 1e-3)
    parts = np.split(np.arange(len(a)), edges + 1)
    found = []
    for k, part in enumerate(parts):  # parts do not touch, so their vectors are orthogonal
        found += [(float(v), k, j) for j, v in enumerate(singular_values_squared(a[part], b[part[:-1]]))]
    found.sort(key=lambda f: (-f[0], f[1:]))
    floor = (len(used) * _EPS) ** 2 * found[0][0]
    values[:len(found)] = [f[0] if f[0] > floor else 0.0 for f in found]
    close: dict[int, list] = {}
    for c, (lam, k, _) in enumerate(found[:vectors.shape[1]]):
        if lam <= floor:
            break
        part = parts[k]
        q, low = a[part] ** 2, b[part[:-1]] / a[part[:-1]]
        z = _twisted(q, low, lam) if len(part) > 1 else np.ones(1)
        near = close.setdefault(k, [])
        near[:] = near if near and near[-1][0] - lam <= 1e-3 * lam else []
        for _ in range(2):
            for _, o in near:
                z = z - (o @ z) * o
        if near and not np.linalg.norm(z) > 0.1:
            low_d = low * q[:-1]
            t = np.diag(q + np.append(0.0, low * low_d)) + np.diag(low_d, 1) + np.diag(low_d, -1)
            z = _inverse_iteration(t, lam, [o for _, o in near], c)
        z = z / np.linalg.norm(z)
        near.append((lam, z))
        vectors[used, c] = p[:, part] @ z
    return values, vectors


def _sums(width):
    """(i, total): a task's sum for each dimension."""
    def rows(batches):
        totals = None
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(0), width)
                part = x.sum(axis=0) if float(np.abs(x).max()) * len(x) < 1 << 62 else x.astype(object).sum(axis=0)
                totals = part.astype(object) if totals is None else totals + part
        if totals is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array([str(int(t)) for t in totals])], names=["i", "total"])
    return rows


class Centre:
    """n and the exact sums of the fit list."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, np.array(sums, dtype=object)

    def apart(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exactly."""
        large = max([abs(int(s)) for s in self.sums] + [float(np.abs(x).max(initial=0)) * self.n])
        if large < 1 << 62:
            return x * self.n - self.sums.astype(np.int64)
        return x.astype(object) * self.n - self.sums


def _triangles(width, centre):
    """The triangle of a task's centred rows."""
    def rows(batches):
        held = np.zeros((0, width))
        for batch in batches:
            x = matrix(batch.column(0), width)
            for at in range(0, len(x), BLOCK):
                centred = (centre.apart(x[at:at + BLOCK]) / centre.n).astype(float)
                held = np.linalg.qr(np.vstack([held, centred]), mode="r")
        if len(held):
            yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(held).tobytes()], pa.binary())], names=["r"])
    return rows


def _joined(width):
    """The triangle of triangles."""
    def rows(batches):
        held = np.zeros((0, width))
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                held = np.linalg.qr(np.vstack([held, np.frombuffer(raw).reshape(-1, width)]), mode="r")
        if len(held):
            yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(held).tobytes()], pa.binary())], names=["r"])
    return rows


def triangle(fit: DataFrame, width: int, centre: Centre, fan: int = FAN) -> np.ndarray:
    """R of the centred rows of ``fit`` (column x): one triangle a task, joined ``fan`` at a time."""
    parts = fit.rdd.getNumPartitions()
    found = fit.select("x").mapInArrow(_triangles(width, centre), "r binary")
    while parts > 1:
        parts = math.ceil(parts / fan)
        found = found.repartition(parts).mapInArrow(_joined(width), "r binary")
    last = found.collect()  # one triangle of width x width
    return np.frombuffer(last[0].r).reshape(-1, width) if last else np.zeros((0, width))


def _products(width, centre, whitener):
    """(i, j, total): a task's sums of products of whitened components."""
    def rows(batches):
        total = np.zeros((whitener.shape[1],) * 2)
        for batch in batches:
            z = (centre.apart(matrix(batch.column(0), width)) / centre.n).astype(float) @ whitener
            total += z.T @ z
        i, j = np.indices(total.shape).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.reshape(-1))], names=["i", "j", "total"])
    return rows


class Whitening:
    """A fitted transform: centre, directions and their variances."""

    def __init__(self, centre: Centre, values: np.ndarray, vectors: np.ndarray):
        n, count = max(centre.n, 1), vectors.shape[1]
        variances = values[:count] / n
        total = float(values.sum()) / n
        self.centre, self.live = centre, variances > 0
        self.explained = np.divide(variances, total, out=np.zeros(count), where=total > 0)
        self.whitener = np.divide(vectors, np.sqrt(variances), out=np.zeros_like(vectors), where=self.live)
        self.identity_error = 0.0


def fit_whitening(rows: DataFrame, width: int, components: int = COMPONENTS) -> Whitening:
    """Fit on the distinct vectors of ``rows`` (column x of ``width`` whole numbers)."""
    ship(rows.sparkSession)
    fit = stored(rows.select("x").distinct(), "whitening-fit")
    n = fit.count()
    totals = fit.mapInArrow(_sums(width), "i int, total string").groupBy("i").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    sums = [0] * width
    for r in totals.collect():  # one row per dimension
        sums[r.i] = int(r.total)
    centre = Centre(n, sums)
    if not n:
        return Whitening(centre, np.zeros(width), np.zeros((width, min(components, width))))
    model = Whitening(centre, *directions(triangle(fit, width, centre), components))
    live = int(model.live.sum())
    products = fit.mapInArrow(_products(width, centre, model.whitener[:, :live]), "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total"))
    errors = [abs(r.total / n - (r.i == r.j)) for r in products.collect()]  # components squared
    model.identity_error = max(errors, default=0.0)
    return model


def _whiten(width, shared):
    def rows(batches):
        model = shared.value
        count, n = model.whitener.shape[1], model.centre.n
        for batch in batches:
            apart = model.centre.apart(matrix(batch.column(1), width))
            z = (apart / n).astype(float) @ model.whitener
            deviation = pa.array(as_long(squares(apart)), pa.int64())
            each = pa.array(np.repeat(np.arange(len(z)), count))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(each), pa.array(np.tile(np.arange(1, count + 1), len(z)), pa.int32()), pa.array(np.full(z.size, n), pa.int64()),
                 deviation.take(each), pa.array(z.reshape(-1)), pa.array(np.tile(model.explained, len(z))), pa.array(np.full(z.size, model.identity_error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return rows


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """One row per kept vector and component (vec_id, component, n, deviation, whitened, explained, identity_error).

    Vectors that are null, empty or hold null or non-finite entries are dropped, as
    are those of another length than most. Repeated vectors, with the same or
    another vec_id, count once in the fit, and each of their rows is returned; a
    vec_id may be null. A component without variance (fewer distinct vectors than
    dimensions, or vectors that are all alike) has ``whitened`` and ``explained`` 0
    and is left out of ``identity_error``. Vectors with fewer entries than
    ``components`` have a component per entry. ``deviation`` is null where a long
    cannot hold it. An empty table gives an empty result. Other columns are ignored.
    """
    spark = ship(vectors.sparkSession)
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    rows, width = whole_vectors(vectors.select("vec_id", "embedding"), scale, offset)
    model = fit_whitening(rows, width, components)
    return rows.select("vec_id", "x").mapInArrow(
        _whiten(width, spark.sparkContext.broadcast(model)),
        f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double")


def op11_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
