"""Embedding whitening by Chebyshev-filtered subspace iteration.

The covariance V of the vectors is never formed: executors multiply a block of
columns, ``V Q = (1/n) X' (X Q)`` with X centred, one pass over the table for each
product, and the driver holds blocks of one vector's length. A filter of degree
p, p passes by the three-term recurrence, keeps the columns' parts beyond the
unwanted interval [0, cut] and damps those within. QR and a Rayleigh-Ritz step
follow, until the residuals of the wanted eigenvectors certify them.

Entries are whole numbers; their sums, the means and the deviations are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import record
from stationflow.session import stored

SCALE, SHIFT = 64, 1_000_000
# Entries beyond this after scaling count as this, so that doubles hold them exactly.
LARGEST = 1 << 46
COMPONENTS = 32
# Columns beyond the wanted ones: the filter's gap is the one behind them.
GUARD = 16
DEGREE = 10
# Residuals as a share of the largest eigenvalue that certify; and rounds without one half of the residual that end it too.
TOLERANCE = 4e-15
ROUNDS = 40
# Eigenvalues below this share of the largest are no components: the vectors have no extent there.
FLAT = 1e-12
# Groups in which partial sums meet before they go to the driver.
MEETING = 16
ROWS = 4096


def vectors(column) -> np.ndarray:
    """A list column of equal lengths without nulls, as rows."""
    flat = column.flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), -1)


def whole(embeddings: DataFrame) -> DataFrame:
    """vec_id and x, the scaled entries, of the rows that remain, of any length."""

    def work(batches):
        for batch in batches:
            found, ids = batch.column("embedding"), batch.column("vec_id")
            lengths = np.diff(found.offsets.to_numpy()) if len(found) else np.zeros(0, np.int64)
            flat = found.flatten()
            values = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
            begin = np.concatenate([[0], np.cumsum(lengths)])
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
            good = (bad[begin[1:]] == bad[begin[:-1]]) & (lengths > 0)
            with np.errstate(invalid="ignore"):
                scaled = np.clip(np.floor(SCALE * np.nan_to_num(values)), -LARGEST, LARGEST).astype(np.int64) + SHIFT
            lists = pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(scaled))
            yield record(vec_id=ids, x=lists).filter(pa.array(good))

    kept = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return kept.filter("embedding IS NOT NULL").mapInArrow(work, "vec_id long, x array<long>")


def fitted_length(rows: DataFrame) -> int | None:
    """The commonest length, the greatest of equally common ones."""
    found = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return found["d"] if found else None


def block_sum(rows: DataFrame, work, shape: tuple[int, int], shared) -> np.ndarray:
    """The sum over all rows of ``work(x, shared)``, a matrix of ``shape`` for each batch of vectors.

    Tasks add up their own rows, executors the tasks' sums in ``MEETING`` groups,
    so the driver gets ``MEETING`` matrices whatever the input.
    """
    sent = rows.sparkSession.sparkContext.broadcast(shared)

    def partial(batches):
        total, seen = np.zeros(shape), False
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                total += work(vectors(batch.column("x").slice(first, ROWS)), sent.value)
                seen = True
        if seen:
            yield record(k=pa.array([TaskContext.get().partitionId() % MEETING], pa.int32()), m=pa.array([total.tobytes()], pa.binary()))

    def meet(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            for raw in batch.column("m"):
                total += np.frombuffer(raw.as_py()).reshape(shape)
        yield record(m=pa.array([total.tobytes()], pa.binary()))

    met = rows.select("x").mapInArrow(partial, "k int, m binary").groupBy("k").applyInArrow(meet, "m binary").collect()
    sent.destroy()
    return np.sum([np.frombuffer(r["m"]).reshape(shape) for r in met], axis=0) if met else np.zeros(shape)


def moments(rows: DataFrame, d: int) -> tuple[int, np.ndarray]:
    """Number of vectors and exact sums per dimension."""

    def partial(batches):
        n, total = 0, np.zeros(d, object)
        for batch in batches:
            x = vectors(batch.column("x"))
            n += len(x)
            # Two halves of 32 bits, so that no partial sum leaves 64 bits.
            total += (x >> 32).sum(axis=0).astype(object) * (1 << 32) + (x & 0xFFFFFFFF).sum(axis=0).astype(object)
        if n:
            yield record(i=np.arange(d, dtype=np.int32), n=np.full(d, n, np.int64), s=[str(s) for s in total])

    sums = rows.select("x").mapInArrow(partial, "i int, n long, s string")
    found = sums.groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    out = np.zeros(d, object)
    for r in found:
        out[r["i"]] = int(r["s"])
    return (found[0]["n"] if found else 0), out


def centre(n: int, sums: np.ndarray):
    """Whole and broken part of each mean, so that differences to it keep all their digits."""
    return np.array([int(s // n) for s in sums], np.int64), np.array([int(s % n) / n for s in sums])


def centred(x: np.ndarray, middle) -> np.ndarray:
    return (x - middle[0]).astype(float) - middle[1]


class Covariance:
    """Products of the covariance with blocks of columns, one pass each."""

    def __init__(self, rows: DataFrame, n: int, sums: np.ndarray):
        self.rows, self.n, self.d, self.middle, self.passes = rows, n, len(sums), centre(n, sums), 0

    def times(self, block: np.ndarray) -> np.ndarray:
        def work(x, shared):
            middle, q = shared
            y = centred(x, middle)
            return y.T @ (y @ q)

        self.passes += 1
        return block_sum(self.rows, work, block.shape, (self.middle, block)) / self.n

    def trace(self) -> float:
        def work(x, middle):
            return np.array([[np.sum(centred(x, middle) ** 2)]])

        return block_sum(self.rows, work, (1, 1), self.middle)[0, 0] / self.n


def rayleigh_ritz(v: Covariance, q: np.ndarray):
    """(values, vectors, residuals) in the space of ``q``'s orthonormal columns, values falling."""
    image = v.times(q)
    small = q.T @ image
    values, turn = np.linalg.eigh((small + small.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    return values, q @ turn, np.linalg.norm(image @ turn - (q @ turn) * values, axis=0)


def filtered(v: Covariance, q: np.ndarray, cut: float, top: float) -> np.ndarray:
    """The Chebyshev polynomial of V, of ``DEGREE``, that is small on [0, cut], times ``q``.

    It is scaled to about 1 at ``top``, so that no column overflows.
    """
    half = cut / 2
    scale = first = half / (top - half)
    now, before = (v.times(q) - half * q) * (scale / half), q
    for _ in range(DEGREE - 1):
        following = 1 / (2 / first - scale)
        now, before = (v.times(now) - half * now) * (2 * following / half) - before * (scale * following), now
        scale = following
    return now


def components(v: Covariance, wanted: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) of the covariance, largest first.

    Ends when all residuals are at most ``TOLERANCE`` of the largest eigenvalue,
    or when rounding keeps them from shrinking any more.
    """
    width = min(v.d, wanted + GUARD)
    start = np.random.default_rng(seed).standard_normal((v.d, width))
    values, q, left = rayleigh_ritz(v, np.linalg.qr(start)[0])
    wanted, lowest, stalled = min(wanted, width), np.inf, 0
    for _ in range(ROUNDS):
        worst = left[:wanted].max()
        stalled = stalled + 1 if worst > lowest / 2 else 0
        lowest = min(lowest, worst)
        # A block of all columns is exact after one step; a flat one has nothing to filter.
        if worst <= TOLERANCE * values[0] or width == v.d or stalled >= 2 or values[0] <= 0:
            break
        cut = max(values[-1], FLAT * values[0])
        values, q, left = rayleigh_ritz(v, np.linalg.qr(filtered(v, q, cut, values[0]))[0])
    return values[:wanted], q[:, :wanted]


def identity_error(rows: DataFrame, n: int, middle, weights: np.ndarray) -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity."""
    k = weights.shape[1]

    def work(x, shared):
        w = centred(x, shared[0]) @ shared[1]
        return np.vstack([w.T @ w, w.sum(axis=0)])

    total = block_sum(rows, work, (k + 1, k), (middle, weights)) / n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """The exact sum over dimensions of (n x - S)^2; null beyond 64 bits."""
    low, high = np.array([int(s // n) for s in sums], np.int64), np.array([int(s % n) for s in sums], np.int64)
    far = x - low
    most = int(np.abs(far).max(initial=0)) + 1
    if most * n < 1 << 62 and (most * n) ** 2 * x.shape[1] < 1 << 63:
        y = n * far - high
        return (y * y).sum(axis=1).tolist()
    y = far.astype(object) * n - high.astype(object)
    return [s if s < 1 << 63 else None for s in (y * y).sum(axis=1)]


OUTPUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(embeddings: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """A row per vector and component: the vector's whitened coordinate.

    Vectors that are null or hold null or non-finite entries are dropped, and so
    are empty ones and those not of the commonest length (of the greatest, if
    several are equally common). All others are fitted. Components whose
    eigenvalue is nought, within rounding, are left out, so equal vectors give
    no rows, and neither does an empty table. Null ids and repeated rows stay.
    ``deviation`` is null where it exceeds 64 bits.
    """
    spark = embeddings.sparkSession
    rows = stored(whole(embeddings), "whole-vectors")
    d = fitted_length(rows)
    if d is None:
        return spark.createDataFrame([], OUTPUT)
    rows = rows.filter(F.size("x") == d)
    n, sums = moments(rows, d)
    v = Covariance(rows, n, sums)
    trace = v.trace()
    if trace <= 0:
        return spark.createDataFrame([], OUTPUT)
    values, q = components(v, most)
    keep = values > FLAT * values[0]
    values, q = values[keep], q[:, keep]
    weights = q / np.sqrt(values)
    error = identity_error(rows, n, v.middle, weights)
    k = len(values)
    shared = spark.sparkContext.broadcast((n, sums, v.middle, weights, values / trace))

    def work(batches):
        n, sums, middle, weights, share = shared.value
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                x = vectors(part.column("x"))
                m = len(x)
                yield record(
                    vec_id=part.column("vec_id").take(pa.array(np.repeat(np.arange(m), k))),
                    component=np.tile(np.arange(1, k + 1, dtype=np.int32), m),
                    n=np.full(m * k, n, np.int64),
                    deviation=pa.array(deviations(x, n, sums), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                    whitened=(centred(x, middle) @ weights).ravel(),
                    explained=np.tile(share, m),
                    identity_error=np.full(m * k, error),
                )

    return rows.select("vec_id", "x").mapInArrow(work, OUTPUT)


def op11_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    return whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
