"""Whitening of vectors by shifted CholeskyQR (operator 11).

Entries are taken as x = floor(256 c) in whole numbers; the model is fitted on
each distinct x vector once.  The n centred vectors form a matrix X.  Each pass
over them adds up a Gram matrix task by task, takes its Cholesky factor (the
first pass with the shift 11 (n d + d (d + 1)) u |X|^2, which keeps it definite)
and the next pass solves the rows against all factors so far, so that they get
orthonormal.  The factors multiply to R with X = Q R; its singular value
decomposition gives the components without ever squaring X's condition number:
e = s^2 / n.

Centring is exact: n x - S in whole numbers, S being the sums, divided once.
Only Gram matrices (d x d) and sums (d) reach the driver, added up on Spark.
A vector with fewer independent directions gives fewer components: one whose
eigenvalue is no larger than d u times the first has no rows.

Null vectors and those with null or non-finite entries take no part and give no
rows.  Vectors of different lengths are different tables, each fitted on its own;
empty ones have no components.  Equal vectors count once in the fit and each get
their rows; rows with null or repeated ids too.  floor(256 c) beyond 64 bits is
the nearest long; a deviation beyond 64 bits is null.  An empty table gives no
rows.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import ready, stored

SCALE = 256
COMPONENTS = 4
PASSES = 6             # at most; two after the shifted one are enough unless X lacks directions
ORTHONORMAL = 1e-12    # largest entry of Gram minus identity at which passes end
_U = np.finfo(np.float64).eps / 2
_LONG = 1 << 63


@dataclass
class Whitening:
    """A fitted model: whitened = (x - sums / n) projected on a component, over sqrt(eigenvalue)."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray   # of the kept components, falling
    components: np.ndarray    # a column each
    trace: float
    identity_error: float = 0.0

    def project(self, x: np.ndarray) -> np.ndarray:
        return _centred(x, self.n, self.sums) @ self.components / np.sqrt(self.eigenvalues)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)^2, in whole numbers."""
        d = _numerators(x, self.n, self.sums)
        if d.dtype == np.int64 and len(d) and np.abs(d).max() < int((_LONG / max(1, d.shape[1])) ** 0.5):
            return (d * d).sum(axis=1).tolist()
        whole = [sum(v * v for v in map(int, row)) for row in d]
        return [v if v < _LONG else None for v in whole]


def _numerators(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, as 64-bit numbers where these suffice."""
    top = max(int(x.max()), -int(x.min())) if x.size else 0
    if n * top + max(map(abs, sums), default=0) < _LONG:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    d = _numerators(x, n, sums)
    if d.dtype == np.int64 and (not d.size or np.abs(d).max() < 1 << 53):
        return d / n
    return np.array([[int(v) / n for v in row] for row in d], dtype=np.float64).reshape(d.shape)   # rounded once


def integers(vectors: DataFrame) -> DataFrame:
    """(vec_id, d, x): usable vectors as whole numbers, packed in 64 bits each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column(1)
            flat = v.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            with np.errstate(over="ignore", invalid="ignore"):
                y = np.floor(flat * SCALE)
            x = np.where(y >= 2.0 ** 63, _LONG - 1, np.where(y < -(2.0 ** 63), -_LONG, np.where(np.abs(y) < 2.0 ** 63, y, 0).astype(np.int64))).astype("<i8")
            at = np.concatenate(([0], np.cumsum(np.asarray(v.value_lengths())))).tolist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(at), pa.int64()), pa.array([x[a:z].tobytes() for a, z in zip(at, at[1:], strict=False)], pa.binary())],
                                             names=["vec_id", "d", "x"])

    c = F.col("embedding").cast("array<double>")
    usable = c.isNotNull() & F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    rows = vectors.where(F.coalesce(usable, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), c.alias("embedding"))
    return rows.mapInArrow(run, "vec_id long, d long, x binary")


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<i8").reshape(-1, d)


def _added(rows: DataFrame, d: int, width: int, gather: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all vectors of the numbers that ``gather`` makes of a batch: one
    partial sum a task, added cell by cell on Spark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                total += gather(_matrix(batch.column(0), d)).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(total)], names=["cell", "value"])

    cells = rows.select("x").mapInArrow(run, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    out = np.zeros(width)
    for r in cells.collect():   # width is a function of d alone
        out[r["cell"]] = r["value"]
    return out


def _sums(rows: DataFrame, d: int) -> list[int]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * d
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0), d)
                small = not x.size or max(int(x.max()), -int(x.min())) < _LONG // len(x)
                total = [t + int(s) for t, s in zip(total, (x if small else x.astype(object)).sum(axis=0), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int64()), pa.array(list(map(str, total)))], names=["cell", "value"])

    cells = rows.select("x").mapInArrow(run, "cell long, value string").groupBy("cell").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    out = [0] * d
    for r in cells.collect():
        out[r["cell"]] = int(r["value"])
    return out


def _cholesky(gram: np.ndarray, shift: float) -> np.ndarray:
    """Upper factor of the Gram matrix plus ``shift`` (more, if it is not definite yet)."""
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, _U * max(float(np.trace(gram)), np.finfo(np.float64).tiny))


def _solve(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """rows times the inverse of an upper triangular factor, column by column."""
    out = np.empty_like(rows)
    for k in range(rows.shape[1]):
        out[:, k] = (rows[:, k] - out[:, :k] @ factor[:k, k]) / factor[k, k]
    return out


def fit(rows: DataFrame, d: int, keep: int = COMPONENTS) -> Whitening | None:
    """The model of distinct vectors ``rows`` (x) with ``d`` entries each; null if
    they have no direction at all."""
    n = rows.count()
    sums = _sums(rows, d)
    factors: list[np.ndarray] = []

    def gram(x: np.ndarray) -> np.ndarray:
        q = _centred(x, n, sums)
        for f in factors:
            q = _solve(q, f)
        return q.T @ q

    first = _added(rows, d, d * d, gram).reshape(d, d)
    size = float(np.trace(first))
    if not size > 0:
        return None
    g, worst = first, np.inf
    for k in range(PASSES):
        factors.append(_cholesky(g, 11 * (n * d + d * (d + 1)) * _U * size if k == 0 else 0.0))
        g = _added(rows, d, d * d, gram).reshape(d, d)
        error = float(np.abs(g - np.eye(d)).max())
        if error <= ORTHONORMAL or (k > 1 and error > worst / 2):   # done, or X lacks a direction
            break
        worst = error
    r = np.eye(d)
    for f in factors:
        r = f @ r
    _, s, vt = np.linalg.svd(_cholesky(g, 0.0) @ r if error > ORTHONORMAL else r)
    e = s * s / n
    k = min(keep, int((e > d * 2 * _U * e[0]).sum()))
    model = Whitening(n, sums, e[:k], np.ascontiguousarray(vt[:k].T), size / n)
    mean = _added(rows, d, k, lambda x: model.project(x).sum(axis=0)) / n

    def spread(x: np.ndarray) -> np.ndarray:
        w = model.project(x) - mean
        return w.T @ w

    model.identity_error = float(np.abs(_added(rows, d, k * k, spread).reshape(k, k) / n - np.eye(k)).max())
    return model


def transform(rows: DataFrame, model: Whitening) -> DataFrame:
    """The output rows of all vectors (vec_id, x) of the model's length."""
    k, d = len(model.eigenvalues), len(model.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            x = _matrix(batch.column(1), d)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(m), k)).cast(pa.int64()), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                 pa.array(np.full(m * k, model.n), pa.int64()), pa.array([v for v in model.deviation(x) for _ in range(k)], pa.int64()),
                 pa.array(model.project(x).ravel()), pa.array(np.tile(model.eigenvalues / model.trace, m)), pa.array(np.full(m * k, model.identity_error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]).set_column(
                    0, "vec_id", batch.column(0).take(pa.array(np.repeat(np.arange(m), k))))

    return rows.select("vec_id", "x").mapInArrow(
        run, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")


def whiten(vectors: DataFrame, keep: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for
    each usable vector (vec_id, embedding) and its first ``keep`` components."""
    ready(vectors.sparkSession)
    rows = stored(integers(vectors), "integers")
    distinct = stored(rows.where("d > 0").select("d", "x").distinct(), "distinct")
    out = transform(rows.limit(0), Whitening(0, [], np.empty(0), np.empty((0, 0)), 1.0))
    for r in distinct.select("d").distinct().orderBy("d").toLocalIterator():   # nearly always one length
        d = r["d"]
        model = fit(distinct.where(F.col("d") == d), d, keep)
        if model is not None:
            out = out.unionByName(transform(rows.where(F.col("d") == d), model))
    return out
