"""Embedding whitening by Chebyshev-filtered subspace iteration.

Vectors become exact integers x = floor(1024 c) + 100000. The leading eigenvectors of their covariance V are found without
forming V: each step is one distributed pass that sums centred XᵀXQ over the partitions, with Q a block of a few more columns than the
wanted components. A short Lanczos run bounds the spectrum from below; a Chebyshev polynomial that is small between that bound and
the block's least Ritz value, applied by its three-term recurrence, damps the unwanted part; QR and Rayleigh-Ritz give
the next block. This repeats until the residual norms of all wanted pairs certify them at the precision of doubles.
Only matrices of dimension x block come to the driver, summed by position on the executors first; the rows stay in the stored table.

Cases: rows whose vector is null, empty, or holds null or non-finite entries take no part, nor do vectors that are not of the most frequent
length (ties: the longer); null and repeated vec_ids are ordinary rows; a table without vectors gives no rows; entries beyond 2^40 / 1024
count as that; directions without variance (all vectors equal, or fewer vectors than components) have a null ``whitened`` and are
left out of ``identity_error``; a deviation that is no 64-bit number is null. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.llm.common import prepare, stored

COMPONENTS, GUARDS = 8, 16
SCALE, SHIFT, LARGEST = 1024, 100_000, float(1 << 40)
LANCZOS_STEPS, DEGREE, ROUNDS = 10, 8, 100
#: Residual over the largest eigenvalue: certified at once below the first, and below the second once it no longer falls.
SHARP, ENOUGH = 1e-14, 1e-11


def integer_rows(frame: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id`` and ``x`` of the rows that take part, stored once for all passes."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    scaled = lambda v: F.least(F.greatest(v.cast("double") * SCALE, F.lit(-LARGEST)), F.lit(LARGEST))
    x = F.transform(vector, lambda v: F.floor(scaled(v)) + F.lit(SHIFT).cast("bigint"))
    rows = stored(frame.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False))).select(F.col(vec_id).alias("vec_id"), x.alias("x")), "vectors")
    usual = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1)
    length = usual.first()
    return rows if length is None else rows.where(F.size("x") == length.d)


def matrices(batches: Iterator[pa.RecordBatch], dimension: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        if batch.num_rows:
            yield batch, batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


class Centre:
    """Exact counts and sums, and rows around the mean: n * x - S as integers, divided by n last."""

    def __init__(self, n: int, sums: list[int], largest: int):
        self.n, self.sums = n, sums
        self.fits = n * (largest + 1) * 2 < 1 << 62
        self.squares_fit = (n * (largest + 1) * 2) ** 2 * len(sums) < 1 << 62

    def exact(self, x: np.ndarray) -> np.ndarray:
        return x * self.n - np.array(self.sums, np.int64) if self.fits else x.astype(object) * self.n - np.array(self.sums, object)

    def rows(self, x: np.ndarray) -> np.ndarray:
        return (self.exact(x) / self.n).astype(np.float64)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        d = self.exact(x)
        if not self.squares_fit:
            far = np.abs(d).max(initial=0)
            d = d if int(far) ** 2 * max(1, d.shape[1]) < 1 << 62 else d.astype(object)
        return [v if v < 1 << 63 else None for v in (d * d).sum(axis=1).tolist()]


def summed(rows: DataFrame, part: Callable[[Iterator[pa.RecordBatch]], list | None], size: int, kind: str = "double") -> list:
    """Sums by position of one list of numbers per partition."""
    arrow = pa.list_(pa.float64() if kind == "double" else pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = part(batches)
        if values is not None:
            yield pa.RecordBatch.from_pydict({"values": pa.array([values], arrow)})

    lists = rows.select("x").mapInArrow(run, f"values array<{kind}>")
    total = F.sum("v") if kind == "double" else F.sum(F.col("v").cast("decimal(38,0)"))
    sums = lists.select(F.posexplode("values").alias("i", "v")).groupBy("i").agg(total.alias("s")).collect()
    out = [0] * size
    for row in sums:
        out[row.i] = row.s
    return out


def centre_of(rows: DataFrame) -> Centre | None:
    first = rows.select(F.size("x").alias("d")).limit(1).first()
    if first is None:
        return None
    d = first.d

    def part(batches: Iterator[pa.RecordBatch]) -> list | None:
        n, sums = 0, np.zeros(d, np.int64)
        for _, x in matrices(batches, d):
            n, sums = n + len(x), sums + x.sum(axis=0)
        return [n, *sums.tolist()] if n else None

    n, *sums = summed(rows, part, d + 1, "bigint")
    largest = rows.agg(F.max(F.array_max(F.transform("x", F.abs))).alias("m")).first().m
    return Centre(int(n), [int(s) for s in sums], int(largest))


class Covariance:
    """V as what it does to a block of vectors: one pass over the rows."""

    def __init__(self, rows: DataFrame, centre: Centre):
        self.rows, self.centre, self.size, self.passes = rows, centre, len(centre.sums), 0

    def __matmul__(self, q: np.ndarray) -> np.ndarray:
        centre, d = self.centre, self.size

        def part(batches: Iterator[pa.RecordBatch]) -> list | None:
            total = None
            for _, x in matrices(batches, d):
                own = centre.rows(x)
                product = own.T @ (own @ q)
                total = product if total is None else total + product
            return None if total is None else total.reshape(-1).tolist()

        self.passes += 1
        return np.array(summed(self.rows, part, q.size), np.float64).reshape(q.shape) / centre.n

    def trace(self) -> float:
        centre, d = self.centre, self.size

        def part(batches: Iterator[pa.RecordBatch]) -> list | None:
            found = [float((centre.rows(x) ** 2).sum()) for _, x in matrices(batches, d)]
            return [sum(found)] if found else None

        return summed(self.rows, part, 1)[0] / centre.n


def lower_bound(v: Covariance, start: np.ndarray, steps: int = LANCZOS_STEPS) -> float:
    """A value at or below the least eigenvalue, up to what a Lanczos run of a few steps can tell."""
    basis, alphas, betas = [start / np.linalg.norm(start)], [], []
    for _ in range(min(steps, v.size)):
        w = (v @ basis[-1][:, None])[:, 0]
        alphas.append(float(basis[-1] @ w))
        for _ in range(2):
            for b in basis:
                w = w - (b @ w) * b
        betas.append(float(np.linalg.norm(w)))
        if betas[-1] <= 1e-12 * max(abs(alphas[0]), 1e-300):
            break
        basis.append(w / betas[-1])
    m = len(alphas)
    values, vectors = np.linalg.eigh(np.diag(alphas) + np.diag(betas[:m - 1], 1) + np.diag(betas[:m - 1], -1))
    return max(0.0, float(values[0] - betas[m - 1] * abs(vectors[-1, 0])))


def filtered(v: Covariance, q: np.ndarray, vq: np.ndarray, low: float, high: float, degree: int) -> np.ndarray:
    """The Chebyshev polynomial of V on [low, high] applied to the block; ``vq`` is the block's first product."""
    middle, half = (high + low) / 2, (high - low) / 2
    before, now = q, (vq - middle * q) / half
    for _ in range(degree - 1):
        before, now = now, 2 / half * (v @ now - middle * now) - before
    return now


def leading(v: Covariance, wanted: int = COMPONENTS, guards: int = GUARDS, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of the ``wanted`` largest; certified by residuals or an error."""
    draw, k = np.random.default_rng(seed), min(v.size, wanted + guards)
    wanted = min(wanted, v.size)
    low = lower_bound(v, draw.standard_normal(v.size)) if k < v.size else 0.0
    block, last = draw.standard_normal((v.size, k)), np.inf
    for _ in range(ROUNDS):
        q, _ = np.linalg.qr(block / np.maximum(np.linalg.norm(block, axis=0), 1e-300))
        vq = v @ q
        values, turn = np.linalg.eigh((q.T @ vq + vq.T @ q) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        top = max(float(values[0]), 0.0)
        worst = float(np.linalg.norm(vq[:, :wanted] - q[:, :wanted] * values[:wanted], axis=0).max(initial=0.0))
        if worst <= SHARP * top or (worst <= ENOUGH * top and worst > last / 2):
            return values[:wanted], q[:, :wanted] / np.linalg.norm(q[:, :wanted], axis=0)
        last = worst
        high = max(float(values[-1]), low + 1e-9 * top)
        reach = np.arccosh(max((top - (high + low) / 2) / ((high - low) / 2), 1.0 + 1e-9))
        block = filtered(v, q, vq, low, high, int(np.clip(40 / reach, 2, DEGREE)))
    raise RuntimeError(f"no certified components after {ROUNDS} rounds: residual {worst:.3g} at a largest eigenvalue of {top:.3g}")



def whiten(frame: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per vector ``vec_id``, ``deviation`` and ``whitened``, a list with a value per component; and n, explained, identity_error as constants."""
    spark = prepare(frame.sparkSession)
    rows = integer_rows(frame, vec_id, vector)
    centre = centre_of(rows)
    if centre is None:
        kind = rows.schema["vec_id"].dataType.simpleString()
        return spark.createDataFrame([], f"vec_id {kind}, deviation bigint, whitened array<double>, n bigint, explained array<double>, identity_error double")
    v = Covariance(rows, centre)
    values, vectors = leading(v, components)
    trace, d = v.trace(), v.size
    real = values > d * np.finfo(float).eps * max(float(values[0]), 0.0)
    scaled = vectors / np.sqrt(np.where(real, values, 1.0))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in matrices(batches, d):
            found = centre.rows(x) @ scaled
            lists = [[w if ok else None for w, ok in zip(row, real.tolist())] for row in found.tolist()]
            yield pa.RecordBatch.from_pydict({"vec_id": batch.column("vec_id"), "deviation": pa.array(centre.deviations(x), pa.int64()), "whitened": pa.array(lists, pa.list_(pa.float64()))})

    kind = rows.schema["vec_id"].dataType.simpleString()
    done = stored(rows.mapInArrow(project, f"vec_id {kind}, deviation bigint, whitened array<double>"), "whitened")
    explained = F.array(*[F.lit(float(value / trace) if trace > 0 else 0.0) for value in np.maximum(values, 0.0)])
    return done.select("*", F.lit(centre.n).cast("bigint").alias("n"), explained.alias("explained"),
                       F.lit(identity_error(done, np.flatnonzero(real).tolist())).alias("identity_error"))


def identity_error(done: DataFrame, parts: list[int]) -> float:
    """The largest entry of the whitened values' covariance minus the identity, from centred products."""
    if not parts:
        return 0.0
    w: Callable[[int], Column] = lambda i: F.col("whitened")[i]
    means = done.agg(*[F.avg(w(i)).alias(f"m{i}") for i in parts]).first()
    pairs = [(i, j) for i in parts for j in parts if i <= j]
    products = done.agg(*[F.avg((w(i) - means[f"m{i}"]) * (w(j) - means[f"m{j}"])).alias(f"p{i}_{j}") for i, j in pairs]).first()
    return max(abs(products[f"p{i}_{j}"] - (i == j)) for i, j in pairs)


def report(frame: DataFrame) -> DataFrame:
    """One row per vector and component, numbered from 1."""
    done = whiten(frame)
    long = done.select("vec_id", "n", "deviation", "explained", "identity_error", F.posexplode("whitened").alias("i", "whitened"))
    return long.select("vec_id", (F.col("i") + 1).alias("component"), "n", "deviation", "whitened", F.col("explained")[F.col("i")].alias("explained"), "identity_error")
