"""Embedding whitening by incremental eigendecomposition.

The vectors are taken in whole steps of 1/256 (``x = floor(256 c)``), so sums and
deviations are exact. The fit list has every distinct x once; its covariance
(divisor n) is never built from raw products:

1. *Partitions* start from an empty spectrum and take their vectors one by one.
   A new vector y adds ``m/(m+1) (y - mean)(y - mean)'`` to the scatter of the m
   before it: a centred rank-one update. With the scatter held as eigenvalues and
   eigenvectors, the new eigenvalues are the roots of a secular equation. Terms
   of no weight and equal eigenvalues are deflated; the others' roots are found
   all at once, each as a distance from its nearest pole; the eigenvectors come
   from weights recomputed from the roots, so they stay orthogonal.
2. *Spectra* are combined in a tree of Spark groups: the other spectrum's
   eigenpairs, and the difference of the means, are successive rank-one updates.
3. *Rayleigh-Ritz*: tasks project the centred fit list on the eigenvectors found
   and sum the products; the small matrix' eigenvectors rotate the basis. Repeated
   until the projected covariance is diagonal to rounding (``MAX_ROUNDS`` at most).

A rank-one update takes about half a millisecond for 64 dimensions, whatever n;
tasks hold one spectrum. To the driver go ``d * d`` numbers from ``ADDED`` tasks at most, a pass.

Defined results: vectors that are null, empty, or hold null or non-finite entries
give no row; vectors of different lengths are different spaces, each with its own
n, components and identity error; components whose eigenvalue is zero to rounding
are left out (a space of one distinct vector has none, so its rows have none); a
null vec_id keeps its rows, repeated rows repeat theirs; an entry beyond
``LARGEST`` steps, or a deviation beyond a long, is an error, not a wrong number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cxlake.llm.shared import keep_on_disk, small_batches

STEPS, COMPONENTS, FANOUT, ADDED, MAX_ROUNDS, MAX_STEPS = 256, 4, 8, 64, 4, 60
# whole numbers up to here are exact as doubles
LARGEST = 2.0**52
EPS = np.finfo(float).eps


# -- rank-one updates ------------------------------------------------------------


def secular_roots(d: np.ndarray, z2: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + rho * sum(z2 / (d - x))`` for ascending, distinct ``d`` and positive ``z2``.

    Returns (roots, gaps) with ``gaps[i, j] = d[j] - roots[i]`` free of cancellation: each root is sought
    as a distance from its nearest pole. Every step fits both sides of the root by one pole each
    (values and slopes) and solves the quadratic; a bracket catches steps that leave it."""
    k = len(d)
    upper = np.append(d[1:], d[-1] + rho * z2.sum())
    width = upper - d
    lower_side = np.tril(np.ones((k, k), dtype=bool))
    # nearest pole by the sign at the middle of the interval (the last root has one pole only)
    middle = 1 + rho * (z2 / (d - (d + width / 2)[:, None])).sum(axis=1)
    left = middle >= 0
    left[-1] = True
    pole = np.where(left, d, upper)
    at = d - pole[:, None]  # pole distances from each root's origin
    here, there = d - pole, upper - pole
    lo = np.where(left, 0.0, here / 2)
    hi = np.where(left, there / 2, 0.0)
    hi[-1] = there[-1]
    tau = (lo + hi) / 2
    weight = rho * z2
    last = np.arange(k) == k - 1
    for _ in range(MAX_STEPS):
        gap = at - tau[:, None]
        term = weight / gap
        slope = term / gap
        psi, phi = (term * lower_side).sum(axis=1), (term * ~lower_side).sum(axis=1)
        f = 1 + psi + phi
        done = np.abs(f) <= 8 * EPS * (1 + np.abs(psi) + np.abs(phi))
        hi = np.where(f > 0, np.minimum(hi, tau), hi)
        lo = np.where(f < 0, np.maximum(lo, tau), lo)
        if done.all():
            break
        d_psi, d_phi = (slope * lower_side).sum(axis=1), (slope * ~lower_side).sum(axis=1)
        one, two = here - tau, there - tau
        q, s = d_psi * one * one, d_phi * two * two
        c = 1 + psi - d_psi * one + phi - d_phi * two
        a, b = c * (one + two) + q + s, one * two * f
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            step = np.where(last, one + q / c, step)
        new = tau + step
        inside = np.isfinite(new) & (new > lo) & (new < hi)
        new = np.where(inside, new, (lo + hi) / 2)
        new = np.where(done, tau, new)
        if np.array_equal(new, tau):
            break
        tau = new
    return pole + tau, at - tau[:, None]


def rank_one(values: np.ndarray, vectors: np.ndarray, rho: float, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and eigenvectors (columns) of ``Q diag(values) Q' + rho v v'``, rho >= 0."""
    z = v @ vectors
    norm2 = float(z @ z)
    if rho * norm2 == 0.0:
        return values, vectors
    tol = 8 * EPS * max(abs(values[-1]), abs(values[0]), rho * norm2)
    # deflation 1: no weight in a direction, so its eigenpair stays
    active = np.flatnonzero(rho * np.abs(z) * np.sqrt(norm2) > tol)
    # deflation 2: of two (nearly) equal eigenvalues, a rotation leaves all weight to one
    if len(active) > 1:
        x, y = active[:-1], active[1:]
        r2 = z[x] * z[x] + z[y] * z[y]
        if ((values[y] - values[x]) * np.abs(z[x] * z[y]) <= tol * r2).any():
            vectors, values, z, kept, held = vectors.copy(), values.copy(), z.copy(), [], active[0]
            for j in active[1:]:
                r = np.hypot(z[held], z[j])
                c, s = z[j] / r, z[held] / r
                if (values[j] - values[held]) * abs(c * s) <= tol:
                    p, q = vectors[:, held].copy(), vectors[:, j].copy()
                    vectors[:, held], vectors[:, j] = c * p - s * q, s * p + c * q
                    low, high = values[held], values[j]
                    values[held], values[j] = c * c * low + s * s * high, s * s * low + c * c * high
                    z[held], z[j] = 0.0, r
                else:
                    kept.append(held)
                held = j
            active = np.array([*kept, held])
            active = active[np.argsort(values[active], kind="stable")]
    d, za = values[active], z[active]
    roots, gaps = secular_roots(d, za * za, rho)
    # weights for which these roots are exact: products of ratios near one
    between = d - d[:, None]
    upper = np.vstack([between[1:], np.ones((1, len(d)))])  # row i: d[j] - d[i + 1], last row without a partner
    own = np.tril(np.ones_like(between, dtype=bool))  # entry (i, j): i >= j
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.where(own, gaps / np.where(upper == 0, 1.0, upper), gaps / np.where(between == 0, 1.0, between))
    weight = np.sqrt(np.abs(ratio.prod(axis=0)) / rho) * np.sign(za)
    u = (weight / gaps).T
    u /= np.sqrt((u * u).sum(axis=0))
    if len(active) == len(values):
        values, vectors = roots, vectors @ u
    else:
        values, vectors = values.copy(), vectors.copy()
        values[active], vectors[:, active] = roots, vectors[:, active] @ u
    order = np.argsort(values, kind="stable")
    return values[order], np.ascontiguousarray(vectors[:, order])


class Spectrum:
    """Count, mean and the eigenpairs of the scatter of some vectors."""

    def __init__(self, width: int) -> None:
        self.n, self.mean = 0, np.zeros(width)
        self.values, self.vectors = np.zeros(width), np.eye(width)

    def add(self, y: np.ndarray) -> None:
        self.merge_mean(1, y)

    def merge_mean(self, n: int, mean: np.ndarray) -> None:
        """Take ``n`` vectors by their mean: one centred rank-one update."""
        away = mean - self.mean
        total = self.n + n
        if self.n:
            self.values, self.vectors = rank_one(self.values, self.vectors, self.n * (n / total), away)
        self.n, self.mean = total, self.mean + away * (n / total)

    def merge(self, other: Spectrum) -> None:
        if not self.n:
            self.__dict__.update(other.__dict__)
            return
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, float(value), vector)
        self.merge_mean(other.n, other.mean)

    def row(self, node: int) -> pa.RecordBatch:
        data = [np.ascontiguousarray(x).tobytes() for x in (self.mean, self.values, self.vectors)]
        return pa.RecordBatch.from_pydict({"node": [node], "n": [self.n], "mean": data[:1], "vals": data[1:2], "vecs": data[2:]}, schema=SPECTRA_ARROW)


SPECTRA = "node bigint, n bigint, mean binary, vals binary, vecs binary"
SPECTRA_ARROW = pa.schema([("node", pa.int64()), ("n", pa.int64()), ("mean", pa.binary()), ("vals", pa.binary()), ("vecs", pa.binary())])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def whole_spectrum(fit: DataFrame, width: int) -> Spectrum:
    """Spectra of the partitions of ``fit`` (column x), combined in a tree."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Spectrum(width)
        for batch in batches:
            for y in _matrix(batch.column(0), width).astype(float) if batch.num_rows else ():
                own.add(y)
        if own.n:
            yield own.row(TaskContext.get().partitionId())

    def combine(part: pa.Table) -> pa.Table:
        total = Spectrum(width)
        rows = sorted(part.to_pylist(), key=lambda r: r["node"])
        for r in rows:
            one = Spectrum(width)
            one.n, one.mean, one.values = r["n"], np.frombuffer(r["mean"]), np.frombuffer(r["vals"])
            one.vectors = np.frombuffer(r["vecs"]).reshape(width, width)
            total.merge(one)
        return pa.Table.from_batches([total.row(rows[0]["node"] // FANOUT)])

    spectra = keep_on_disk(fit.mapInArrow(local, SPECTRA))
    nodes = spectra.agg(F.max("node")).first()[0] + 1
    while nodes > 1:
        group = F.floor(F.col("node") / FANOUT)
        spectra = keep_on_disk(spectra.groupBy(group).applyInArrow(combine, SPECTRA))
        nodes = -(-nodes // FANOUT)
    r = spectra.first()  # one row: d * d numbers
    found = Spectrum(width)
    found.n, found.mean, found.values = r["n"], np.frombuffer(r["mean"]), np.frombuffer(r["vals"])
    found.vectors = np.frombuffer(r["vecs"]).reshape(width, width)
    return found


# -- passes over the fit list -------------------------------------------------------


def _summed(fit: DataFrame, of, exact: bool = False) -> list:
    """Sum over all tasks of the numbers that ``of`` gives for a matrix of vectors: a row a task, added up
    ``ADDED`` rows at a time until so many are left."""
    kind = pa.string() if exact else pa.float64()
    schema = f"node bigint, vals array<{'string' if exact else 'double'}>"

    def row(node: int, total: np.ndarray) -> dict:
        vals = [str(v) for v in total] if exact else total
        return {"node": pa.array([node], pa.int64()), "vals": pa.array([vals], pa.list_(kind))}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = of(batch.column(0))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_pydict(row(TaskContext.get().partitionId(), total))

    def numbers(vals: list) -> np.ndarray:
        return np.array([int(v) for v in vals], dtype=object) if exact else np.array(vals)

    def add(part: pa.Table) -> pa.Table:
        rows = sorted(part.to_pylist(), key=lambda r: r["node"])
        total = numbers(rows[0]["vals"])
        for r in rows[1:]:
            total = total + numbers(r["vals"])
        return pa.Table.from_pydict(row(rows[0]["node"] // ADDED, total))

    sums, tasks = fit.mapInArrow(task, schema), fit.rdd.getNumPartitions()
    while tasks > ADDED:
        sums = sums.groupBy(F.floor(F.col("node") / ADDED)).applyInArrow(add, schema)
        tasks = -(-tasks // ADDED)
    return list(sum(numbers(r["vals"]) for r in sorted(sums.collect(), key=lambda r: r["node"])))


def _moments(fit: DataFrame, width: int, mean: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Sum of products of the centred vectors on the columns of ``basis``."""
    k = basis.shape[1]

    def of(column: pa.Array) -> np.ndarray:
        y = (_matrix(column, width) - mean) @ basis
        return np.concatenate([y.sum(axis=0), (y.T @ y).ravel()])

    flat = np.array(_summed(fit, of))
    return flat[:k], flat[k:].reshape(k, k)


def refined(fit: DataFrame, width: int, n: int, mean: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rayleigh-Ritz: eigenvalues (falling) and eigenvectors of the covariance from a near basis."""
    values = np.zeros(width)
    for _ in range(MAX_ROUNDS):
        sums, square = _moments(fit, width, mean, basis)
        projected = square / n - np.outer(sums / n, sums / n)
        values, turn = np.linalg.eigh((projected + projected.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        basis = np.linalg.qr(basis @ turn)[0]
        off = np.abs(projected - np.diag(np.diag(projected))).max()
        if off <= 64 * EPS * max(values[0], 0.0):
            break
    return values, basis


def fit_space(fit: DataFrame, width: int) -> dict:
    """n, sums, mean, eigenvalues, components and identity error of the fit list's vectors (all ``width`` long)."""
    n = fit.count()

    def of(column: pa.Array) -> np.ndarray:
        x = _matrix(column, width)
        safe = float(np.abs(x).max()) * len(x) < 2.0**62
        return (x if safe else x.astype(object)).sum(axis=0).astype(object)

    sums = [int(v) for v in _summed(fit, of, exact=True)]
    mean = np.array([s / n for s in sums])
    spectrum = whole_spectrum(fit, width)
    values, basis = refined(fit, width, n, mean, np.ascontiguousarray(spectrum.vectors[:, ::-1]))
    trace = float(values.sum())
    rank = int((values > width * EPS * max(values[0], 0.0)).sum()) if trace > 0 else 0
    k = min(COMPONENTS, rank)
    scale = basis[:, :k] / np.sqrt(values[:k])
    error = 0.0
    if k:
        total, square = _moments(fit, width, mean, scale)
        error = float(np.abs(square / n - np.outer(total / n, total / n) - np.eye(k)).max())
    return {"n": n, "sums": sums, "mean": mean, "values": values[:k], "explained": values[:k] / trace if k else values[:0], "scale": scale, "error": error}


def quantized(v: Column) -> Column:
    """x of a vector column: null for vectors that take no part."""
    odd = F.exists(v, lambda c: c.isNull() | F.isnan(c.cast("double") - c.cast("double")))
    scaled = F.transform(v, lambda c: c.cast("double") * STEPS)
    fits = F.forall(scaled, lambda c: F.abs(c) <= LARGEST)
    x = F.when(fits, F.transform(scaled, lambda c: F.floor(c).cast("long"))).otherwise(F.raise_error(F.lit("whitening: an entry is too large")).cast("array<bigint>"))
    return F.when(F.coalesce(~odd, F.lit(False)) & (F.size(v) > 0), x)


WHITENED = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = vectors.sparkSession
    small_batches(spark)
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), quantized(vectors[vector_col]).alias("x")).where("x is not null")
    fit_all = keep_on_disk(rows.select("x").distinct())
    spaces = {}
    for r in fit_all.select(F.size("x").alias("width")).distinct().collect():
        spaces[r["width"]] = fit_space(fit_all.where(F.size("x") == r["width"]), r["width"])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x_all = batch.column(0), batch.column(1)
            widths = x_all.value_lengths().to_numpy(zero_copy_only=False) if batch.num_rows else np.zeros(0, int)
            for width in np.unique(widths):
                space, at = spaces[int(width)], np.flatnonzero(widths == width)
                k = len(space["values"])
                if not k:
                    continue
                x = _matrix(x_all.take(pa.array(at)), int(width))
                limit = (np.abs(x).astype(float).max(axis=0) * space["n"] + np.abs(np.array(space["sums"], dtype=float))) ** 2
                exact = limit.sum() >= 2.0**62
                moved = x.astype(object) * space["n"] - np.array(space["sums"], dtype=object) if exact else x * space["n"] - np.array(space["sums"], dtype=np.int64)
                deviation = pa.array([int(v) for v in (moved * moved).sum(axis=1)], pa.int64())  # an error beyond a long
                white = (x - space["mean"]) @ space["scale"]
                for c in range(k):
                    one = np.ones(len(at))
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(pa.array(at)),
                            pa.array((one * (c + 1)).astype(np.int32)),
                            pa.array(np.full(len(at), space["n"], dtype=np.int64)),
                            deviation,
                            pa.array(white[:, c]),
                            pa.array(one * space["explained"][c]),
                            pa.array(one * space["error"]),
                        ],
                        ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                    )

    return rows.mapInArrow(project, WHITENED)
