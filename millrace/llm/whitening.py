"""Whitening of embeddings by shifted CholeskyQR.

Entries become whole numbers, so column sums and squared deviations are exact.
The fit list holds each distinct vector once; its centred rows ``A`` are taken
apart as ``A = QR`` in passes over the list:

1. Each pass gathers the Gram matrix ``Q'Q`` of the rows as far as they are
   orthogonal by now: tasks put their rows through triangular solves with the
   factors found so far and add up products; the sums meet in one shuffle of
   ``d * (d + 1) / 2`` entries a task.
2. The driver factors that matrix (Cholesky, in the first pass with a shift that
   lets any rank through) and composes the factors into one triangle ``R``. Passes
   end when the rows are orthogonal to rounding.
3. The singular values and right vectors of ``R`` are those of ``A``: components,
   and their variances ``s * s / n``. ``A'A`` itself is never taken apart, so small
   components keep their digits.

What reaches the driver and the tasks are matrices of the dimension, however
many rows there are. If the rows have no full rank, the last Gram matrix keeps
a null space; its symmetric root, which ends every decomposition, holds there too.

Defined cases: vectors that are null, or hold null or non-finite entries, or an
entry beyond 2**56 (whose whole number would not fit), take no part; empty
vectors have no component and give no row; vectors of each length are whitened
by themselves; rows that repeat a vec_id (or have none) are all returned;
components without variance (below the rounding of the largest) are not
returned, so a single distinct vector gives no row; a deviation beyond a long is
null; an empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
LARGEST = 2.0 ** 56
PASSES = 8
ORTHOGONAL = 1e-13
SLICE_VALUES = 1 << 19  # entries a task works on at once
SCHEMA = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "eigenvalue double, identity_error double")


def quantised(vectors: DataFrame) -> DataFrame:
    """``vec_id, x``: the whole numbers ``floor(64 * c) + 1000000`` of the vectors that take part."""
    c = F.transform(F.col("embedding"), lambda v: v.cast("double"))
    rows = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), vectors["embedding"].alias("embedding"))
    fit = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) <= LARGEST))
    rows = rows.where("embedding is not null and size(embedding) > 0").where(F.coalesce(fit, F.lit(False)))
    return rows.select("vec_id", F.transform(c, lambda v: F.floor(v * SCALE) + OFFSET).alias("x"))


def solved(rows: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """``rows @ inverse(upper)`` by forward substitution, column by column."""
    out = np.empty_like(rows)
    for j in range(rows.shape[1]):
        out[:, j] = (rows[:, j] - out[:, :j] @ upper[:j, j]) / upper[j, j]
    return out


@dataclass
class Centre:
    """Count and exact column sums of the fit list, and the rows centred by them."""

    n: int
    sums: np.ndarray

    def moved(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sums``, exact: longs, or Python's whole numbers where longs would not do."""
        largest = max(int(np.abs(x).max(initial=0)), 1) * self.n + int(np.abs(self.sums).max(initial=0))
        if largest < 1 << 62:
            return x * np.int64(self.n) - self.sums.astype(np.int64)
        return x.astype(object) * self.n - self.sums

    def rows(self, x: np.ndarray) -> np.ndarray:
        return self.moved(x).astype(np.float64) / self.n

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """The sum of the squared entries of each moved row."""
        moved = self.moved(x)
        top = int(np.abs(moved).max(initial=0))
        if top * top * max(1, x.shape[1]) < 1 << 62:
            return (moved * moved).sum(axis=1).tolist()
        totals = (sum(int(v) ** 2 for v in row) for row in moved.tolist())
        return [t if t < 1 << 63 else None for t in totals]


@dataclass
class Whitening:
    """A fitted whitening of vectors of one length."""

    centre: Centre
    variances: np.ndarray
    components: np.ndarray  # one per column
    explained: np.ndarray
    identity_error: float = 0.0
    orthogonality: list[float] = field(default_factory=list)  # distance from orthogonal rows, pass by pass

    def white(self, x: np.ndarray) -> np.ndarray:
        return self.centre.rows(x) @ self.components / np.sqrt(self.variances)


def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Arrow batches in bounded slices, each with its vectors as a matrix."""
    for batch in batches:
        if not batch.num_rows:
            continue
        step = max(1, SLICE_VALUES * batch.num_rows // max(1, len(batch.column("x").flatten())))
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            yield part, part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)


def summed(fit: DataFrame, of, size: int) -> np.ndarray:
    """The sum over all rows of ``of(matrix) -> vector`` of ``size`` entries: one partial
    vector a task, added entry by entry in a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in matrices(batches):
            part = of(x)
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], names=["at", "value"])

    found = fit.mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(size)
    out[found.column("at").to_numpy()] = found.column("value").to_numpy()
    return out


def gram(fit: DataFrame, rows, d: int) -> np.ndarray:
    """``Q'Q`` of all rows, where ``rows(x)`` gives a slice of ``Q``."""
    upper = np.triu_indices(d)

    def of(x: np.ndarray) -> np.ndarray:
        q = rows(x)
        return (q.T @ q)[upper]

    flat = summed(fit, of, len(upper[0]))
    out = np.zeros((d, d))
    out[upper] = flat
    return out + np.triu(out, 1).T


def centre(fit: DataFrame) -> Centre:
    """Count and column sums, exact at any size: whole numbers in the tasks, decimals between."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(0, object)
        for _, x in matrices(batches):
            safe = int(np.abs(x).max(initial=0)) * len(x) < 1 << 62
            n, total = n + len(x), (total if n else 0) + (x if safe else x.astype(object)).sum(axis=0).astype(object)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(total), dtype=np.int32)),
                                              pa.array([Decimal(int(v)) for v in (n, *total)], pa.decimal128(38, 0))], names=["at", "value"])

    found = fit.mapInArrow(run, "at int, value decimal(38,0)").groupBy("at").agg(F.sum("value").alias("value")).orderBy("at").toArrow()
    n, *sums = (int(v) for v in found.column("value").to_pylist())
    return Centre(n, np.array(sums, dtype=object))


def root(g: np.ndarray) -> np.ndarray:
    """The symmetric root of a Gram matrix, whatever its rank."""
    value, vector = np.linalg.eigh(g)
    return (vector * np.sqrt(np.maximum(value, 0))) @ vector.T


def triangle(fit: DataFrame, mid: Centre, d: int) -> tuple[np.ndarray, list[float]]:
    """A square ``R`` with ``R'R = A'A`` of the centred rows, by repeated Gram passes,
    and how far from orthogonal the rows were in each."""
    factors: list[np.ndarray] = []
    r, far, eps = np.eye(d), [], np.finfo(float).eps
    while True:

        def rows(x: np.ndarray, done=tuple(factors)) -> np.ndarray:
            q = mid.rows(x)
            for f in done:
                q = solved(q, f)
            return q

        g = gram(fit, rows, d)
        far.append(float(np.abs(g - np.eye(d)).max()))
        norm, turn = float(np.linalg.norm(g, 2)), len(factors)
        stalled = turn >= 2 and far[-1] > far[-2] / 2  # at rounding, or directions without any variance
        if not norm or far[-1] < ORTHOGONAL or stalled or turn == PASSES:
            return root(g) @ r, far
        # the shift lets every rank through; where the rows are well apart it is not needed
        well = turn and np.linalg.eigvalsh(g)[0] > d * eps * norm
        factor = np.linalg.cholesky(g + (0.0 if well else 11 * d * (2 * d + 1) * eps * norm) * np.eye(d)).T
        factors.append(factor)
        r = factor @ r


def fitted(fit: DataFrame, d: int, *, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the vectors ``x`` of length ``d`` in ``fit`` (each once); None
    where they do not vary."""
    mid = centre(fit)
    r, far = triangle(fit, mid, d)
    _, s, vt = np.linalg.svd(r)
    varying = s > s[0] * d * np.finfo(float).eps * 4 if s[0] else np.zeros(d, bool)
    k = min(components, int(varying.sum()))
    if not k:
        return None
    variances = s * s / mid.n
    out = Whitening(mid, variances[:k], vt[:k].T, variances[:k] / variances.sum(), orthogonality=far)
    mean = summed(fit, lambda x: out.white(x).sum(axis=0), k) / mid.n
    error = gram(fit, lambda x: out.white(x) - mean, k) / mid.n - np.eye(k)
    out.identity_error = float(np.abs(error).max())
    return out


def applied(rows: DataFrame, w: Whitening) -> DataFrame:
    """Per row and component its whitened value, with the shared figures of the fit."""
    k = len(w.variances)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in matrices(batches):
            m = len(x)
            each = np.repeat(np.arange(m), k)
            deviation = pa.array(w.centre.deviation(x), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, w.centre.n, np.int64)), deviation.take(pa.array(each)), pa.array(w.white(x).ravel()),
                 pa.array(np.tile(w.explained, m)), pa.array(np.tile(w.variances, m)), pa.array(np.full(m * k, w.identity_error))],
                names=[f.split()[0] for f in SCHEMA.split(", ")])

    return rows.select("vec_id", "x").mapInArrow(run, SCHEMA)


def whiten(vectors: DataFrame, *, components: int = COMPONENTS) -> DataFrame:
    """Per row that takes part and component (by falling variance): ``vec_id, component, n,
    deviation, whitened, explained, eigenvalue, identity_error``."""
    spark = vectors.sparkSession
    rows = written(quantised(vectors).withColumn("d", F.size("x")), spark, "whole-numbers")
    # aggregation by the vector runs before the shuffle: a vector of a third of all rows is one row a task
    fit = written(rows.select("d", "x").distinct(), spark, "fit-list")
    lengths = [r["d"] for r in fit.select("d").distinct().orderBy("d").collect()]  # one row per length of vector
    out = spark.createDataFrame([], SCHEMA)
    for d in lengths:
        w = fitted(fit.where(F.col("d") == d).select("x"), d, components=components)
        if w is not None:
            out = out.unionByName(applied(rows.where(F.col("d") == d), w))
    return out
