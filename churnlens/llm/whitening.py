"""Embedding whitening by an incremental eigendecomposition.

Each entry c becomes x = floor(64 c) + 1000000; every distinct x vector is in
the fit list once.  The eigenvectors of its covariance are found without ever
gathering vectors:

1. A task runs over its part of the fit list.  Every vector is a rank-one
   update of the running scatter, centred at the running mean; its spectrum is
   updated by the secular equation with deflation (``secular``).
2. Spectra are combined ``FAN`` at a time: one takes the other's eigenpairs as
   successive rank-one updates and one more for the distance of the means.
   A spectrum is d^2 + 2 d numbers whatever it stands for.
3. A last pass over the fit list refines the basis (Rayleigh-Ritz): tasks add
   up the products of exactly centred vectors in that basis, and the
   eigenvectors of the small summed matrix rotate it.

Sums per dimension are exact integers.  A pass over the fit list measures how
far the whitened covariance is from the identity; a pass over the table
whitens its rows.

Defined cases: a vector that is null, empty, or holds a null or non-finite entry
takes no part, nor does one with an entry beyond 2^56, for which x is no long; if
vectors differ in length, the length most rows have is taken (the larger of
two) and the others take no part.  Null or repeated ids and repeated rows keep
their rows; extra columns are ignored.  A component whose eigenvalue is not
above 1e-12 of the largest can't be scaled to one and is left out, so one
distinct vector, or none, gives no rows.  A deviation beyond a long is null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from churnlens.llm import secular
from churnlens.llm.common import batch_rows, stored

SCALE, SHIFT = 64, 1_000_000
COMPONENTS, FAN, LEAST = 16, 8, 1e-12
ROWS = 4096  # of an Arrow batch

_SPECTRUM = "task long, n long, mean array<double>, d array<double>, q array<double>"


# ------------------------------------------------------------- entries
def _usable(v: Column) -> Column:
    fits = lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float(1 << 56)), F.lit(False))  # noqa: E731  (null, NaN, infinity: false)
    return v.isNotNull() & (F.size(v) > 0) & F.forall(v, fits)


def entries(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, x array<long>) of the rows that take part."""
    v = F.col(vector)
    x = F.transform(v, lambda c: F.floor(c.cast("double") * SCALE) + F.lit(SHIFT).cast("long"))
    rows = df.where(_usable(v)).select(F.col(key).alias("vec_id"), x.alias("x"))
    size = F.size("x").alias("size")
    most = rows.groupBy(size).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    return rows.where(F.size("x") == (most[0]["size"] if most else 0))


def _matrix(batch: pa.RecordBatch, column: int) -> np.ndarray:
    """The int64 rows of a list column of one length."""
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _added(rows: DataFrame, kind: str) -> list:
    """Sum per position of (pos, value) rows; the number of positions is that of a small matrix."""
    got = rows.groupBy("pos").agg(F.sum(F.col("value").cast(kind)).alias("value")).collect()
    return [r["value"] for r in sorted(got, key=lambda r: r["pos"])]


def sums(fit: DataFrame) -> list[int]:
    """Exact sums per dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                x = _matrix(b, 0)
                small = int(np.abs(x).max()) < 1 << 48
                part = [int(s) for s in (x if small else x.astype(object)).sum(0)]
                total = part if total is None else [s + p for s, p in zip(total, part)]
        if total is not None:
            at = pa.array(range(len(total)), pa.int32())
            yield pa.RecordBatch.from_arrays([at, pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))], ["pos", "value"])

    return [int(s) for s in _added(fit.select("x").mapInArrow(run, "pos int, value decimal(38,0)"), "decimal(38,0)")]


# ------------------------------------------------------------- spectra
@dataclass
class Spectrum:
    """Rows, mean, and the eigenpairs (ascending) of the scatter around that mean."""

    n: int
    mean: np.ndarray
    d: np.ndarray
    q: np.ndarray

    def add(self, x: np.ndarray) -> None:
        gap = x - self.mean
        self.n += 1
        self.mean = self.mean + gap / self.n
        self.d, self.q = secular.update(self.d, self.q, np.sqrt((self.n - 1) / self.n) * gap)

    def take(self, other: Spectrum) -> None:
        """Combine with a spectrum of other rows."""
        gap, n = other.mean - self.mean, self.n + other.n
        steps = [np.sqrt(max(e, 0.0)) * v for e, v in zip(other.d, other.q.T)]
        for u in [*steps, np.sqrt(self.n * other.n / n) * gap]:
            self.d, self.q = secular.update(self.d, self.q, u)
        self.mean, self.n = self.mean + gap * (other.n / n), n

    def batch(self, task: int) -> pa.RecordBatch:
        doubles = lambda v: pa.array([v], pa.list_(pa.float64()))
        values = [pa.array([task], pa.int64()), pa.array([self.n], pa.int64()), doubles(self.mean), doubles(self.d), doubles(self.q.ravel())]
        return pa.RecordBatch.from_arrays(values, ["task", "n", "mean", "d", "q"])


def _spectrum(row) -> Spectrum:
    mean, d = np.array(row["mean"], float), np.array(row["d"], float)
    return Spectrum(int(row["n"]), mean, d, np.array(row["q"], float).reshape(len(mean), len(d)))


def _incremental(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The spectrum of a task's vectors, one rank-one update each."""
    s = None
    for b in batches:
        for x in _matrix(b, 0) - SHIFT if b.num_rows else ():
            if s is None:
                s = Spectrum(0, np.zeros(len(x)), np.zeros(len(x)), np.eye(len(x)))
            s.add(x.astype(float))
    if s is not None:
        yield s.batch(TaskContext.get().partitionId())


def _combine(group: pa.Table) -> pa.Table:
    first, *others = sorted(group.to_pylist(), key=lambda r: r["task"])
    s = _spectrum(first)
    for r in others:
        s.take(_spectrum(r))
    return pa.Table.from_batches([s.batch(first["task"] // FAN)])


def decompose(fit: DataFrame) -> Spectrum | None:
    """The combined spectrum of the whole fit list (None for an empty one)."""
    spectra = stored(fit.select("x").mapInArrow(_incremental, _SPECTRUM), "whiten-spectra")
    left = spectra.agg(F.max("task").alias("top"), F.count(F.lit(1)).alias("n")).first()
    n, top = left["n"], left["top"]
    while n > 1:
        group = F.floor(F.col("task") / FAN).cast("long").alias("group")
        spectra = stored(spectra.groupBy(group).applyInArrow(_combine, _SPECTRUM), "whiten-spectra")
        n, top = spectra.count(), top // FAN
    row = spectra.first() if n else None
    return _spectrum(row) if row is not None else None


# ------------------------------------------------------------- passes
def _centred(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """n x - S as exact integers (int64 where they fit)."""
    s_top, x_top = max(map(abs, total)), int(np.abs(x).max()) if x.size else 0
    if n * x_top < 1 << 62 and s_top < 1 << 62:
        return n * x - np.array(total, np.int64)
    return n * x.astype(object) - np.array(total, object)


def _gram(fit: DataFrame, project: Callable[[np.ndarray], np.ndarray], size: int, n: int, total: list[int]) -> np.ndarray:
    """Mean product matrix of the projected, exactly centred fit list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = np.zeros((size, size))
        for b in batches:
            if b.num_rows:
                y = project(_centred(_matrix(b, 0), n, total).astype(float) / n)
                g += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size * size), pa.int32()), pa.array(g.ravel())], ["pos", "value"])

    g = np.array(_added(fit.select("x").mapInArrow(run, "pos int, value double"), "double")).reshape(size, size)
    return (g + g.T) / 2 / n


@dataclass
class Whitening:
    """Fitted components (columns of ``basis``, falling eigenvalue) of one fit list."""

    n: int
    total: list[int]
    values: np.ndarray
    basis: np.ndarray
    trace: float
    identity_error: float = 0.0

    def project(self) -> np.ndarray:
        return self.basis / np.sqrt(self.values)


def fit_components(fit: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit a written list of distinct x vectors; None if it has no component."""
    s = decompose(fit)
    if s is None:
        return None
    total = sums(fit)
    basis, _ = np.linalg.qr(s.q)
    h = _gram(fit, lambda y: y @ basis, len(total), s.n, total)
    values, turn = np.linalg.eigh(h)
    order = np.argsort(-values, kind="stable")
    values, basis = values[order], (basis @ turn)[:, order]
    k = int((values[:components] > LEAST * values[0]).sum()) if values[0] > 0 else 0
    if not k:
        return None
    w = Whitening(s.n, total, values[:k], basis[:, :k], float(values.sum()))
    p = w.project()
    w.identity_error = float(np.abs(_gram(fit, lambda y: y @ p, k, s.n, total) - np.eye(k)).max())
    return w


def _deviation(gap: np.ndarray) -> pa.Array:
    """Exact row sums of squares; null where a long can't hold one."""
    top = float(np.abs(gap).max()) if gap.size else 0.0
    if top * top * gap.shape[1] < 2.0**62:
        return pa.array((gap * gap).sum(1).astype(np.int64))
    exact = (gap.astype(object) ** 2).sum(1)
    return pa.array([int(v) if v < 1 << 63 else None for v in exact], pa.int64())


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per remaining row and component."""
    rows = entries(df, key, vector)
    schema = rows.select("vec_id").schema.add("component", "integer").add("n", "long").add("deviation", "long")
    for c in ("whitened", "explained", "identity_error"):
        schema = schema.add(c, "double")
    with batch_rows(df.sparkSession, ROWS):
        fit = stored(rows.select("x").distinct(), "whiten-fit")
        w = fit_components(fit, components)
    if w is None:
        return df.sparkSession.createDataFrame([], schema)
    k, p, n, total = len(w.values), w.project(), w.n, w.total
    explained, error = w.values / w.trace, w.identity_error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, ROWS):
                part = b.slice(i, ROWS)
                gap, m = _centred(_matrix(part, 1), n, total), part.num_rows
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(each),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, n, np.int64)),
                        _deviation(gap).take(each),
                        pa.array((gap.astype(float) / n @ p).ravel()),
                        pa.array(np.tile(explained, m)),
                        pa.array(np.full(m * k, error)),
                    ],
                    schema.names,
                )

    return rows.mapInArrow(run, schema)
