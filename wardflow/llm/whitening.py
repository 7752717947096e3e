"""Whitened embeddings by FEAST contour integration.

An entry c becomes the integer ``floor(1024 * c) + 100000``, so that sums over
any number of rows are exact and do not depend on their order.  Spark makes the
sums of the integer vectors, then the covariance from centred values (one
matrix of partial sums per task, added up row by row), then the projections.
Only the covariance, whose size is the dimension squared whatever the number of
rows, comes to the driver.

There its leading eigenpairs are found by contour integration.  Inertia counts
(signs of the pivots of a shifted covariance) bisect for a bound under the
wanted eigenvalues, a circle is drawn around the interval above it, and a
quadrature of complex shifted solves on the circle filters a random block down
to the eigenvectors inside.  Rayleigh-Ritz extracts them and gives the block of
the next round, until the residuals are at rounding level.  The count at the
bound says how many there must be: fewer found pairs are an error.

Cases: rows whose vector is null, empty, or holds a null or non-finite entry are
left out, and so are rows whose length is not the most common one (of equally
common ones the greatest) and rows with an entry beyond ``LARGEST``, whose integers
would not be exact; components without variance are not returned, so a table of
equal vectors, or of one, gives no row; a row's deviation is null where it
does not fit a long; null and repeated ids each keep their rows; extra columns are
not read; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SCALE, SHIFT = 1024, 100000
COMPONENTS = 8
LARGEST = 2.0**30
#: Points of the quadrature on one half of the circle.
NODES = 16
#: Variance under this share of the trace counts as none.
LEAST_SHARE = 1e-12
BATCH_ROWS = 4096


def usable(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, v): the rows with whole, finite vectors of the common length."""
    v = F.col(embedding).cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= LARGEST))
    whole = rows.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).where(F.col("v").isNotNull() & (F.size("v") > 0) & fine)
    sizes = whole.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    top = sizes.agg(F.max(F.struct("n", "size")).alias("top")).first().top
    return whole.where(F.size("v") == (top.size if top else 0))


def integers(batch: pa.RecordBatch) -> np.ndarray:
    """(rows, dimensions) of a batch's integer vectors."""
    flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
    return (np.floor(SCALE * flat) + SHIFT).astype(np.int64).reshape(batch.num_rows, -1)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, BATCH_ROWS):
            yield b.slice(i, BATCH_ROWS)


def sums(rows: DataFrame) -> tuple[int, np.ndarray]:
    """Number of vectors and the exact sum of every dimension."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, 0
        for b in _blocks(batches):
            n, total = n + b.num_rows, total + integers(b).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total), pa.array([n] * len(total), pa.int64())], ["i", "s", "n"])

    got = rows.select("v").mapInArrow(scan, "i int, s long, n long").groupBy("i").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()
    total = np.zeros(len(got), np.int64)
    for r in got:
        total[r.i] = r.s
    return (got[0].n if got else 0), total


def _added(parts: DataFrame, d: int) -> np.ndarray:
    """Element-wise sum of the rows (i, part) of many partial matrices."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for i, part in zip(b.column("i").to_pylist(), b.column("part")):
                held[i] = held.get(i, 0.0) + np.asarray(part.values)
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([x.tolist() for x in held.values()], pa.list_(pa.float64()))], ["i", "part"])

    out = np.zeros((d, d))
    for r in parts.repartition("i").mapInArrow(add, "i int, part array<double>").collect():
        out[r.i] = r.part
    return out


def _rows(m: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(range(len(m)), pa.int32()), pa.array(m.tolist(), pa.list_(pa.float64()))], ["i", "part"])


def covariance(rows: DataFrame, n: int, total: np.ndarray) -> np.ndarray:
    """Covariance of the integer vectors, divisor n; every value is centred before it is multiplied."""
    mid = total // n
    rest = (total - n * mid) / n  # the mean less its whole part, so that no digits are lost

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = None
        for b in _blocks(batches):
            x = (integers(b) - mid) - rest
            part = x.T @ x if part is None else part + x.T @ x
        if part is not None:
            yield _rows(part)

    v = _added(rows.select("v").mapInArrow(scan, "i int, part array<double>"), len(total)) / n
    return (v + v.T) / 2


def above(v: np.ndarray, bound: float) -> int:
    """Number of eigenvalues over ``bound``: the positive pivots of the shifted matrix (Sylvester's law of inertia).

    A pivot at rounding level means that the bound meets an eigenvalue of a
    leading block; the bound is then moved by that much.
    """
    size = max(float(np.abs(v).max()), 1e-300)
    step = 1
    while True:
        a = v - bound * np.eye(len(v))
        positive = 0
        for k in range(len(a)):
            pivot = a[k, k]
            if abs(pivot) <= 1e-14 * size:
                break
            positive += pivot > 0
            a[k + 1:, k + 1:] -= np.outer(a[k + 1:, k] / pivot, a[k, k + 1:])
        else:
            return int(positive)
        bound -= step * 4e-14 * size
        step *= 2


def filtered(v: np.ndarray, block: np.ndarray, low: float, high: float, nodes: int) -> np.ndarray:
    """The block with all parts outside the eigenvalue interval damped: Gauss quadrature of the resolvent on a circle.

    The lower half of the circle gives the conjugate of the upper, so twice the
    real part of the upper half is taken.
    """
    place, weight = np.polynomial.legendre.leggauss(nodes)
    radius, middle = (high - low) / 2, (high + low) / 2
    out = np.zeros_like(block)
    eye = np.eye(len(v))
    for t, w in zip(place, weight):
        turn = np.exp(1j * np.pi / 2 * (1 + t))
        solved = np.linalg.solve((middle + radius * turn) * eye - v, block.astype(complex))
        out += w / 2 * (radius * turn * solved).real
    return out


class Spectrum(NamedTuple):
    """Eigenvalues in falling order, unit eigenvectors in columns, and the number the inertia counts ask for."""

    values: np.ndarray
    vectors: np.ndarray
    counted: int


def leading(v: np.ndarray, k: int = COMPONENTS) -> Spectrum:
    """The k greatest eigenpairs with variance of a covariance, fewer if there are no more."""
    d, trace = len(v), float(np.trace(v))
    none = Spectrum(np.zeros(0), np.zeros((d, 0)), 0)
    floor = LEAST_SHARE * trace
    if not trace > 0 or not (most := above(v, floor)):
        return none
    k = min(k, most)
    low, high = floor, trace * (1 + 1e-9)
    if most > k:
        # The widest bound found that leaves at least k eigenvalues above; equal ones stay together.
        a, b = low, high
        while b - a > 1e-12 * trace:
            mid = (a + b) / 2
            count = above(v, mid)
            a, b = (mid, b) if count >= k else (a, mid)
            if count == k:
                break
        low = a
    # A bound over all eigenvalues keeps the circle small.
    a, b = low, high
    while b - a > 0.01 * (b - low):
        mid = (a + b) / 2
        a, b = (mid, b) if above(v, mid) else (a, mid)
    high = b + 0.01 * (b - low)
    counted = above(v, low)
    size = min(d, max(2 * counted, counted + 16))
    block, nodes, last = np.random.default_rng(7).standard_normal((d, size)), NODES, np.inf
    while True:
        q = np.linalg.qr(filtered(v, block, low, high, nodes))[0]
        values, turn = np.linalg.eigh(q.T @ v @ q)
        vectors = q @ turn
        order = np.argsort(-values)[:counted]
        found, x = values[order], vectors[:, order]
        worst = float(np.linalg.norm(v @ x - x * found, axis=0).max()) / max(float(found[0]), 1e-300)
        # At rounding level a further round does not help.
        if worst <= 1e-14 or (worst <= 1e-11 and worst > last / 4):
            break
        if worst > last / 4:
            nodes *= 2
        block, last = vectors, worst
    if (found < low - 1e-9 * trace).any():
        raise ArithmeticError(f"fewer than the {counted} eigenvalues counted over {low} were found")
    return Spectrum(found[:k], x[:, :k], counted)


class Whitener(NamedTuple):
    """Number of vectors, their integer sums, the spectrum and the trace of their covariance."""

    n: int
    total: np.ndarray
    spectrum: Spectrum
    trace: float

    def project(self, x: np.ndarray) -> np.ndarray:
        """(rows, components): centred integer vectors on the components, each to variance 1."""
        mid = self.total // self.n
        rest = (self.total - self.n * mid) / self.n
        return ((x - mid) - rest) @ (self.spectrum.vectors / np.sqrt(self.spectrum.values))


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitener:
    """Learn from all rows (vec_id, v) of ``usable``."""
    n, total = sums(rows)
    if not n:
        return Whitener(0, total, Spectrum(np.zeros(0), np.zeros((0, 0)), 0), 0.0)
    v = covariance(rows, n, total)
    return Whitener(n, total, leading(v, components), float(np.trace(v)))


def identity_error(rows: DataFrame, model: Whitener) -> float:
    """Largest absolute entry of the covariance of all whitened rows less the identity."""
    k = len(model.spectrum.values)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = np.zeros((k + 1, k + 1))
        for b in _blocks(batches):
            y = np.hstack([model.project(integers(b)), np.ones((b.num_rows, 1))])
            part += y.T @ y
        yield _rows(part)

    m = _added(rows.select("v").mapInArrow(scan, "i int, part array<double>"), k + 1) / model.n
    mean = m[k, :k]
    return float(np.abs(m[:k, :k] - np.outer(mean, mean) - np.eye(k)).max()) if k else 0.0


def deviations(x: np.ndarray, n: int, total: np.ndarray) -> pa.Array:
    """Exact sums over the dimensions of (n * x - total) squared; null beyond a long."""
    rough = (((x - total / n) * n) ** 2).sum(axis=1)
    fits = rough < 9.2e18
    away = np.where(fits[:, None], n * x - total, 0)
    return pa.array((away * away).sum(axis=1), pa.int64(), mask=~fits)


def apply(rows: DataFrame, model: Whitener) -> DataFrame:
    """(vec_id, deviation, whitened array): every row of ``usable`` on the components."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _blocks(batches):
            x = integers(b)
            y = model.project(x)
            arrays = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1, dtype=np.int32) * y.shape[1]), pa.array(y.reshape(-1)))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), deviations(x, model.n, model.total), arrays], ["vec_id", "deviation", "whitened"])

    return rows.mapInArrow(scan, "vec_id long, deviation long, whitened array<double>")


def whiten(table: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): one row per usable row and component."""
    rows = usable(table, vec_id, embedding)
    model = fit(rows, components)
    found = len(model.spectrum.values)
    if not found:
        schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return table.sparkSession.createDataFrame([], schema)
    shares = F.array(*[F.lit(float(e / model.trace)) for e in model.spectrum.values])
    error = F.lit(identity_error(rows, model))
    wide = apply(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return wide.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), error.alias("identity_error"),
    )
