"""Whitening of embeddings by shifted CholeskyQR.

Entries are put on a fixed grid: an entry c becomes the whole number
floor(256 c).  Every distinct grid vector counts once in the fit, and its row
is centred before anything is multiplied.  A pass over the fit rows multiplies
them by the inverse of the triangular factor found so far (a triangular solve)
and adds up their Gram matrix; its Cholesky factor is composed with the one so
far.  The first pass shifts the diagonal, so that the factorisation succeeds
whatever the condition; the later ones take out what the shift and rounding
left, and shift only if they must.  The singular values and right singular
vectors of the composed factor are those of the centred rows: they give the
variances and the components.

Scale.  The distinct grid vectors are written once; a pass is one scan of them
in which every task sends the upper half of one Gram matrix, added up by Spark
cell by cell.  The driver holds matrices of dimension x dimension only,
whatever the number of rows.  Equal vectors are combined before the shuffle, so
that a vector that a third of all rows share is one row of each task.

Defined results.  Rows whose vector is null, empty, or holds a null or
non-finite entry are dropped, and of the others those that have not the
commonest length (the longer one, if two are equally common).  Grid values
beyond the range of a long stop at its bounds.  A component without variance cannot be whitened:
those with less than ``LEAST_SHARE`` of the largest variance are left out, so
that a single distinct vector, like an empty table, gives an empty result.
Components of equal variance come in any order.  Repeated rows give repeated
results, a null id is kept, other columns are ignored.  ``deviation`` is exact,
and null where it does not fit a long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import field, materialize

GRID = 256
PASSES = 3
COMPONENTS = 4
LEAST_SHARE = 1e-20
_ENTRIES = 1 << 21  # entries that a task works on at a time
_HALF = 32  # exact sums go as high and low halves, so that none of them wraps


@dataclass(frozen=True)
class Whitening:
    """A fit: rows, sums by dimension, and what projects and scales a centred row."""

    n: int
    sums: tuple[int, ...]
    directions: np.ndarray  # (dimension, components), unit columns
    variances: np.ndarray  # of the components, falling
    trace: float
    identity_error: float = 0.0


def grid_vectors(rows: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(``id``, ``x``): the usable rows, their vectors as whole numbers."""

    def finite(c: Column) -> Column:  # NaN is above all numbers
        return c.isNotNull() & (F.abs(c) < float("inf"))

    given = rows.select(F.col(id_column).alias("id"), F.col(vector_column).cast("array<double>").alias("v"))
    usable = given.filter((F.size("v") > 0) & F.forall("v", finite))
    lengths = usable.groupBy(F.size("v").alias("length")).count()
    commonest = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    usable = usable.filter(F.size("v") == (commonest["length"] if commonest else 0))
    return usable.select("id", F.transform("v", lambda c: F.floor(c * GRID).cast("bigint")).alias("x"))


def _blocks(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of the batches with their vectors as the rows of a matrix."""
    for batch in batches:
        if not batch.num_rows:
            continue
        width = len(batch.column(column)[0])
        step = max(1, _ENTRIES // width)
        for first in range(0, batch.num_rows, step):
            part = batch.slice(first, step)
            values = part.column(column).flatten().to_numpy(zero_copy_only=False)
            yield part, values.reshape(part.num_rows, width)


def _scaled(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """n x - S, exactly: as longs where they suffice, else as Python's whole numbers."""
    most = max(abs(int(x.max())), abs(int(x.min())))
    if n * most + max(map(abs, sums)) < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    return _scaled(x, n, sums).astype(np.float64) / n


def column_sums(fit: DataFrame) -> tuple[int, tuple[int, ...]]:
    """Number of rows and exact sums by dimension."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, x in _blocks(batches, 0):
            high, low = x >> _HALF, x & ((1 << _HALF) - 1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(x.shape[1], dtype=np.int32)),
                    pa.array(np.full(x.shape[1], len(x), np.int64)),
                    pa.array(high.sum(0)),
                    pa.array(low.sum(0)),
                ],
                names=["at", "n", "high", "low"],
            )

    parts = fit.select("x").mapInArrow(add_up, "at int, n bigint, high bigint, low bigint")
    wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "high", "low")]
    rows = sorted(parts.groupBy("at").agg(*wide).collect(), key=lambda r: r["at"])  # one row per dimension
    if not rows:
        return 0, ()
    return int(rows[0]["n"]), tuple((int(r["high"]) << _HALF) + int(r["low"]) for r in rows)


def gram(fit: DataFrame, n: int, sums: tuple[int, ...], inverse: np.ndarray) -> np.ndarray:
    """Gram matrix of the centred fit rows times ``inverse``; tasks send one upper half each."""
    width = inverse.shape[1]
    upper = np.triu_indices(width)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in _blocks(batches, 0):
            q = _centred(x, n, sums) @ inverse
            total = q.T @ q if total is None else total + q.T @ q
        if total is not None:
            cells = pa.array(np.arange(len(upper[0]), dtype=np.int32)), pa.array(total[upper])
            yield pa.RecordBatch.from_arrays(list(cells), names=["cell", "value"])

    parts = fit.select("x").mapInArrow(multiply, "cell int, value double")
    cells = parts.groupBy("cell").agg(F.sum("value").alias("value")).toArrow()  # width (width + 1) / 2 rows
    half = np.zeros((width, width))
    at = cells.column("cell").to_numpy()
    half[upper[0][at], upper[1][at]] = cells.column("value").to_numpy()
    return half + np.triu(half, 1).T


def shifted_cholesky(g: np.ndarray, shift_first: bool) -> np.ndarray:
    """The upper factor of ``g``, its diagonal shifted from the start or as far as it must be."""
    d = len(g)
    step = 11 * d * (d + 1) * np.finfo(float).eps * np.trace(g)
    shift = step if shift_first else 0.0
    while True:
        try:
            return np.linalg.cholesky(g + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, step)


def fit_whitening(vectors: DataFrame, components: int = COMPONENTS, passes: int = PASSES) -> Whitening | None:
    """Fit on each distinct vector ``x`` once; None if nothing varies."""
    fit = materialize(vectors.select("x").distinct(), "vectors")
    n, sums = column_sums(fit)
    if n < 2:
        return None
    r = np.eye(len(sums))
    inverse = np.eye(len(sums))
    for turn in range(passes):
        factor = shifted_cholesky(gram(fit, n, sums, inverse), shift_first=turn == 0)
        r = factor @ r
        inverse = np.linalg.solve(r, np.eye(len(r)))
    _, sizes, rows = np.linalg.svd(r)
    variances = sizes**2 / n
    kept = min(components, int((variances > LEAST_SHARE * variances[0]).sum()))
    directions = rows[:kept].T
    signs = np.sign(directions[np.abs(directions).argmax(0), np.arange(kept)])
    directions = directions * signs
    whitened = gram(fit, n, sums, directions / np.sqrt(variances[:kept])) / n
    error = float(np.abs(whitened - np.eye(kept)).max())
    return Whitening(n, sums, directions, variances[:kept], float(variances.sum()), error)


def whiten(
    rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """Per usable row and component: id, ``component`` (from 1), ``n``, ``deviation``, ``whitened``,
    ``explained``, ``identity_error``."""
    vectors = grid_vectors(rows, id_column, vector_column)
    found = fit_whitening(vectors, components)
    schema = T.StructType([field(vectors, "id", id_column)])
    for name, kind in (
        ("component", T.IntegerType()), ("n", T.LongType()), ("deviation", T.LongType()),
        ("whitened", T.DoubleType()), ("explained", T.DoubleType()), ("identity_error", T.DoubleType()),
    ):
        schema = schema.add(name, kind)
    if found is None:
        return rows.sparkSession.createDataFrame([], schema)
    scales = found.directions / np.sqrt(found.variances)
    shares = found.variances / found.trace

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(shares)
        for part, x in _blocks(batches, 1):
            scaled = _scaled(x, found.n, found.sums)
            most = 0 if scaled.dtype == object else max(abs(int(scaled.max())), abs(int(scaled.min())))
            if scaled.dtype == object or most * most * x.shape[1] >= 1 << 62:
                exact = [int(v) for v in (scaled.astype(object) ** 2).sum(1)]
                deviation = pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())
            else:
                deviation = pa.array((scaled**2).sum(1))
            each = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(x) * k, found.n, np.int64)),
                    deviation.take(each),
                    pa.array(((scaled.astype(np.float64) / found.n) @ scales).ravel()),
                    pa.array(np.tile(shares, len(x))),
                    pa.array(np.full(len(x) * k, found.identity_error)),
                ],
                names=schema.fieldNames(),
            )

    return vectors.mapInArrow(project, schema)
