"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The covariance is never formed. A block of orthonormal directions Q, some more than the components asked for, goes
through rounds. In a round a Chebyshev polynomial of the covariance V is applied to Q by its three-term recurrence; each
step is one pass over the stored vectors that sums centred X'(XQ). The polynomial is small on the unwanted part of the
spectrum, from a lower bound (Lanczos) to the smallest value that the block has found, and grows fast above it. Then QR
makes the block orthonormal again and Rayleigh-Ritz turns it to the best eigenvectors within it.

Rounds end when every component is certified: its residual |Vq - eq| is at most ``TOLERANCE`` of the largest eigenvalue,
so an eigenvalue lies within that distance. The directions beyond the components are filtered probes orthogonal to them,
which would rise above the last component if a larger eigenvalue had been missed. A spectrum that does not part within
``ROUNDS`` rounds gets a block twice as large, at last of all dimensions, for which Rayleigh-Ritz is exact.

What the driver holds is a few matrices of dimensions x block.
"""

from __future__ import annotations

import decimal
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.llm.common import keep
from promolens.llm.passes import matrix, summed

COMPONENTS = 32
PROBES = 16
TOLERANCE = 1e-12
ROUNDS = 40
DEGREE = 16
#: How much more a round may raise the largest direction than the smallest: beyond it QR loses digits.
SPREAD = 1e6
LANCZOS = 8
GRID, SHIFT = 64, 1_000_000
#: Entries of this size and more, times GRID, are no longer exact in a double.
LARGEST = float(2**46)
SEED = 31

FIT = "vec_id long, x binary"
OUT = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


@dataclass(frozen=True)
class Fit:
    """Counts and exact sums of the fit list: the mean of dimension i is base[i] + rest[i] / n."""

    n: int
    base: np.ndarray
    rest: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base).astype(np.float64) - self.rest / self.n


def _stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
            yield pa.record_batch([batch.column(0), pa.array([r.tobytes() for r in np.ascontiguousarray(x)], pa.binary())], names=["vec_id", "x"])


def grid_vectors(vectors: DataFrame) -> tuple[DataFrame, int]:
    """The fit list (vec_id, x as 64-bit integers) and its number of dimensions."""
    e = F.transform("embedding", lambda c: c.cast("double"))
    usable = F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.forall("e", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", e.alias("e")).filter(F.coalesce(usable, F.lit(False)))
    sizes = rows.groupBy(F.size("e").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = sizes["d"] if sizes else 1
    x = F.transform("e", lambda c: F.floor(c * GRID) + SHIFT)
    stored = rows.filter(F.size("e") == d).select("vec_id", x.alias("x")).mapInArrow(_stored, FIT)
    return keep(stored, "grid"), d


def _sums(d: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(d, np.int64), 0
        for batch in batches:
            if batch.num_rows:
                total += matrix(batch.column(0), np.int64).sum(0)
                n += batch.num_rows
        yield pa.record_batch([pa.array(np.arange(d + 1, dtype=np.int32)), pa.array(np.r_[total, n])], names=["cell", "value"])

    return run


def fitted(stored: DataFrame, d: int) -> Fit:
    found = stored.select("x").mapInArrow(_sums(d), "cell int, value long").groupBy("cell").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    total = {r["cell"]: int(r["value"]) for r in found}
    n = total.get(d, 0)
    sums = [total.get(i, 0) for i in range(d)]
    return Fit(n, np.array([s // n for s in sums] if n else [0] * d, np.int64), np.array([s % n for s in sums] if n else [0] * d, np.float64))


def covariance(stored: DataFrame, fit: Fit) -> Callable[[np.ndarray], np.ndarray]:
    """Q -> VQ by one pass over the stored vectors."""
    rows = stored.select("x")

    def apply(q: np.ndarray) -> np.ndarray:
        def part(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            total = np.zeros(q.shape)
            for batch in batches:
                if batch.num_rows:
                    y = fit.centred(matrix(batch.column(0), np.int64))
                    total += y.T @ (y @ q)
            return total

        return summed(rows, q.size, part).reshape(q.shape) / fit.n

    return apply


def _squares(fit: Fit):
    def part(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        return np.array([sum(float((fit.centred(matrix(b.column(0), np.int64)) ** 2).sum()) for b in batches if b.num_rows)])

    return part


def spectrum_floor(apply, d: int, steps: int = LANCZOS) -> float:
    """A lower estimate of the smallest eigenvalue: the least Ritz value of a few Lanczos steps, less its residual."""
    v = np.random.Generator(np.random.PCG64(SEED + 1)).standard_normal((d, 1))
    basis, alpha, beta = [v / np.linalg.norm(v)], [], []
    for _ in range(min(steps, d)):
        w = apply(basis[-1])
        alpha.append((basis[-1].T @ w).item())
        held = np.hstack(basis)
        w -= held @ (held.T @ w)
        w -= held @ (held.T @ w)
        beta.append(float(np.linalg.norm(w)))
        if beta[-1] <= 1e-12 * max(alpha[0], 1e-300):
            break
        basis.append(w / beta[-1])
    m = len(alpha)
    values, vectors = np.linalg.eigh(np.diag(alpha) + np.diag(beta[: m - 1], 1) + np.diag(beta[: m - 1], -1))
    return max(0.0, float(values[0]) - beta[m - 1] * abs(float(vectors[-1, 0])))


def chebyshev(apply, q: np.ndarray, vq: np.ndarray, low: float, high: float, top: float, degree: int) -> np.ndarray:
    """A scaled Chebyshev polynomial of V on Q, small between ``low`` and ``high``; V's first product with Q is given."""
    half, mid = (high - low) / 2, (high + low) / 2
    first = sigma = half / (top - mid)
    before, now = q, (vq - mid * q) * (sigma / half)
    for _ in range(1, degree):
        after = 1 / (2 / first - sigma)
        before, now = now, (apply(now) - mid * now) * (2 * after / half) - (sigma * after) * before
        sigma = after
    return now


def ritz(q: np.ndarray, vq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rayleigh-Ritz: values falling, their vectors, and V times the vectors."""
    small = q.T @ vq
    values, turn = np.linalg.eigh((small + small.T) / 2)
    turn = turn[:, ::-1]
    return values[::-1], q @ turn, vq @ turn


def leading(apply, d: int, k: int, probes: int = PROBES, tolerance: float = TOLERANCE, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of V and their unit vectors, certified by their residuals."""
    rng = np.random.Generator(np.random.PCG64(SEED))
    k = min(k, d)
    block = min(d, k + probes)
    q = np.linalg.qr(rng.standard_normal((d, block)))[0]
    values, q, vq = ritz(q, apply(q))
    low = spectrum_floor(apply, d) if block < d else 0.0
    done = 0
    while True:
        top = max(float(values[0]), 0.0)
        wrong = np.linalg.norm(vq[:, :k] - q[:, :k] * values[:k], axis=0).max()
        if wrong <= tolerance * top or block == d:
            return values[:k], q[:, :k]
        done += 1
        if done % rounds == 0:
            block = min(d, 2 * block)
            q = np.linalg.qr(np.hstack([q, rng.standard_normal((d, block - q.shape[1]))]))[0]
            values, q, vq = ritz(q, apply(q))
            continue
        high = max(float(values[-1]), 1e-12 * top)
        floor = min(low, high * (1 - 1e-6))
        reach = lambda e: np.arccosh(max(1.0, (2 * e - high - floor) / (high - floor)))
        apart = reach(top) - reach(float(values[k - 1]))
        degree = int(np.clip(np.log(SPREAD) / max(apart, 1e-9), 2, DEGREE))
        q = chebyshev(apply, q, vq, floor, high, top * (1 + 1e-9), degree)
        q = np.linalg.qr(q / np.maximum(np.linalg.norm(q, axis=0), 1e-300))[0]
        values, q, vq = ritz(q, apply(q))


def _identity_error(stored: DataFrame, fit: Fit, maps: np.ndarray) -> float:
    """Largest entry of the whitened vectors' covariance less the identity, measured over all of them."""
    k = maps.shape[1]

    def part(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        square, line = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            if batch.num_rows:
                y = fit.centred(matrix(batch.column(0), np.int64)) @ maps
                square += y.T @ y
                line += y.sum(0)
        return np.r_[square.reshape(-1), line]

    found = summed(stored.select("x"), k * k + k, part) / fit.n
    mean = found[k * k :]
    return float(np.abs(found[: k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())


def _deviations(fit: Fit, x: np.ndarray) -> list[int]:
    """Sum over dimensions of (n * x - S) ** 2, exactly."""
    y = x - fit.base
    far = int(np.abs(y).max(initial=0)) * fit.n + fit.n
    if far * far * x.shape[1] < 2**63:
        return ((y * fit.n - fit.rest.astype(np.int64)) ** 2).sum(1).tolist()
    rest = [int(r) for r in fit.rest]
    return [sum((int(v) * fit.n - r) ** 2 for v, r in zip(row, rest)) for row in y.tolist()]


def _projected(fit: Fit, maps: np.ndarray, explained: np.ndarray, error: float):
    k, wide = maps.shape[1], pa.decimal128(38, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                x, m = matrix(batch.column(1), np.int64), batch.num_rows
                deviation = pa.array([decimal.Decimal(v) if v < 10**38 else None for v in _deviations(fit, x)], wide)
                rows = pa.array(np.repeat(np.arange(m), k))
                yield pa.record_batch(
                    [
                        batch.column(0).take(rows),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, fit.n)),
                        deviation.take(rows),
                        pa.array((fit.centred(x) @ maps).reshape(-1)),
                        pa.array(np.tile(explained, m)),
                        pa.array(np.full(m * k, error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return run


def whitened_components(vectors: DataFrame, components: int = COMPONENTS, probes: int = PROBES, tolerance: float = TOLERANCE) -> DataFrame:
    """Returns per usable row of ``vectors`` (vec_id, embedding) and component its whitened coordinate:
    vec_id, component (from 1), n, deviation, whitened, explained, identity_error.

    Each entry c counts as floor(64 c) + 1000000. A null or empty embedding, one with null, NaN or infinite entries, or
    with entries of 2**46 and more in size, is left out, of the fit as of the result; of embeddings of several lengths
    those of the most frequent one (of equally frequent ones the longest) are used. Repeated rows and rows without vec_id
    count and are returned like any other. Directions without variance (eigenvalue at most 1e-12 of the largest) have no
    whitened coordinate and make no component; so a table of no, one or only equal vectors gives no row. Vectors of equal
    eigenvalues span a space of which any basis may come. ``deviation`` is null from 10**38 on. Other columns are not read.
    """
    stored, d = grid_vectors(vectors)
    fit = fitted(stored, d)
    empty = vectors.sparkSession.createDataFrame([], OUT)
    if not fit.n:
        return empty
    trace = float(summed(stored.select("x"), 1, _squares(fit))[0]) / fit.n
    if trace <= 0:
        return empty
    values, maps = leading(covariance(stored, fit), d, components, probes, tolerance)
    real = values > 1e-12 * values[0]
    values, maps = values[real], maps[:, real]
    maps = maps / np.sqrt(values)
    error = _identity_error(stored, fit, maps)
    return stored.mapInArrow(_projected(fit, maps, values / trace, error), OUT)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitened_components(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))
