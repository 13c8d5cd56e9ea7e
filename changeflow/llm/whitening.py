"""Embedding whitening by shifted CholeskyQR.

1. Entries c become integers x = floor(64 c) + 1000000. The fit list holds each distinct x vector once; its size n and its
   sums per dimension are exact.
2. A Gram pass multiplies the centred rows of the fit list with themselves in every task and adds the products up. The
   driver takes the Cholesky factor R1 of the sum, shifted so far that it exists. The next pass solves each row by R1
   before multiplying, which makes the rows nearly orthogonal, and so on until the product is the identity (or zero,
   in directions the vectors do not have). No orthogonal rows are stored: each pass reads x and solves by all factors.
3. The composed factor R = Rk ... R1 has the singular values and right vectors of the centred rows, so an SVD of R gives
   the components. Small eigenvalues keep the digits that an eigenvalue problem of one Gram matrix would lose.

What moves or meets on the driver is (dimensions)^2 numbers per task and pass, whatever the number of rows.

Rows whose vector is null, empty, or holds null or non-finite entries are dropped, as are entries beyond +-2^55, whose
integers would not fit. Vectors of another length than the most common one (the longer one at a tie) are dropped too.
Components without variance (fewer distinct vectors than dimensions, constant or dependent entries) are left out, so a
table of one distinct vector, or none, gives no rows. A null id stays null, repeated ids are rows of their own,
``deviation`` is null where it passes 63 bits. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.llm.common import column, ship, stage, sub_batches

SCALE, OFFSET = 64, 1_000_000
LARGEST = 2.0**55
MOST_PASSES = 10
BATCH_BYTES = 4 << 20


@dataclass
class Fit:
    """Components (rows of ``vectors``), their variances, and what they were fitted to."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    variances: np.ndarray
    trace: float
    passes: int
    identity_error: float = 0.0


def integer_rows(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, width, x) of the usable vectors."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, BATCH_BYTES):
            lists = column(batch, "_v")
            width = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            values = pc.cast(lists.flatten(), pa.float64()).to_numpy(zero_copy_only=False)
            fine = np.isfinite(values) & (np.abs(values) <= LARGEST)
            faults = np.bincount(np.repeat(np.arange(len(width)), width), weights=~fine, minlength=len(width))
            good = (width > 0) & (faults == 0)
            x = np.floor(SCALE * values[np.repeat(good, width)]).astype(np.int64) + OFFSET
            ends = np.concatenate(([0], np.cumsum(width[good]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    column(batch, "id").filter(pa.array(good)),
                    pa.array(width[good].astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(x)),
                ],
                ["id", "width", "x"],
            )

    schema = T.StructType(
        [
            T.StructField("id", vectors.schema[id_col].dataType),
            T.StructField("width", T.IntegerType()),
            T.StructField("x", T.ArrayType(T.LongType())),
        ]
    )
    return vectors.select(vectors[id_col].alias("id"), vectors[vector_col].alias("_v")).mapInArrow(convert, schema)


def matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return column(batch, "x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def exact_sums(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of rows and exact sums per dimension; integers are added in two halves, so none overflows."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, low, high = 0, np.zeros(width, np.int64), np.zeros(width, np.int64)
        for batch in sub_batches(batches, BATCH_BYTES):
            x = matrix(batch, width)
            n += len(x)
            low += (x & 0xFFFFFFFF).sum(axis=0)
            high += (x >> 32).sum(axis=0)
        counts = np.full(width, n, np.int64)
        arrays = [pa.array(a) for a in (np.arange(width), counts, low, high)]
        yield pa.RecordBatch.from_arrays(arrays, ["dim", "n", "low", "high"])

    wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "low", "high")]
    parts = fit.mapInArrow(add, "dim long, n long, low long, high long").groupBy("dim").agg(*wide).collect()
    by_dim = sorted((r.dim, int(r.n), (int(r.high) << 32) + int(r.low)) for r in parts)
    return (by_dim[0][1] if by_dim else 0), [s for _, _, s in by_dim]


class Centre:
    """x - S/n in double precision: the whole part of the mean is subtracted while all is integer."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.whole = np.array([s // n for s in sums], np.int64)
        self.left = np.array([s % n for s in sums], object)
        self.part = np.array([(s % n) / n for s in sums])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.part

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, exact; None where it needs more than 63 bits."""
        n = self.n
        about = ((self(x) * n) ** 2).sum(axis=1)
        small = about < 2.0**61
        out: list[int | None] = [None] * len(x)
        exact = (n * (x[small] - self.whole) - self.left.astype(np.int64)) ** 2 if small.any() else x[:0]
        for row, value in zip(np.flatnonzero(small).tolist(), exact.sum(axis=1).tolist(), strict=True):
            out[row] = value
        for row in np.flatnonzero(~small & (about < 2.0**64)).tolist():
            value = sum((n * (int(v) - int(w)) - r) ** 2 for v, w, r in zip(x[row], self.whole, self.left, strict=True))
            out[row] = value if value < 1 << 63 else None
        return out


def solve(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """Rows times the inverse of an upper triangular ``factor``, by forward substitution."""
    out = np.empty_like(rows)
    for j in range(factor.shape[1]):
        out[:, j] = (rows[:, j] - out[:, :j] @ factor[:j, j]) / factor[j, j]
    return out


def gram(fit: DataFrame, centre: Centre, factors: list[np.ndarray], project: np.ndarray | None = None) -> np.ndarray:
    """Z^T Z over the fit list: Z are the centred rows, solved by ``factors``, times ``project`` if given."""
    width = len(centre.sums)
    size = width if project is None else project.shape[1]

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in sub_batches(batches, BATCH_BYTES):
            z = centre(matrix(batch, width))
            for factor in factors:
                z = solve(z, factor)
            if project is not None:
                z = z @ project
            total += z.T @ z
        i, j = np.triu_indices(size)
        arrays = [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])]
        yield pa.RecordBatch.from_arrays(arrays, ["i", "j", "v"])

    cells = fit.mapInArrow(multiply, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((size, size))
    for r in cells.collect():
        out[r.i, r.j] = out[r.j, r.i] = r.v
    return out


def shifted_cholesky(product: np.ndarray, shift: float) -> np.ndarray:
    """Upper factor of product + shift; the shift grows until the factor exists."""
    while True:
        try:
            return np.linalg.cholesky(product + shift * np.eye(len(product))).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, np.finfo(float).eps * np.trace(product))


def fit_components(fit: DataFrame, width: int, most: int) -> Fit | None:
    """Components of the fit list, by falling variance; None without any variance."""
    n, sums = exact_sums(fit, width)
    if n < 2:
        return None
    centre, eps = Centre(n, sums), np.finfo(float).eps
    factors, composed = [], np.eye(width)
    while True:
        product = gram(fit, centre, factors)
        values, axes = np.linalg.eigh(product)
        if values[-1] <= 0:
            return None
        near = np.abs(values - 1) <= 16 * width * eps
        if factors and (near | (values <= eps)).all() or len(factors) == MOST_PASSES:
            break
        # Rows that are nearly orthogonal already need no shift.
        shift = 0.0 if factors and values[0] > 0.1 else width * (width + 1) * eps * values[-1]
        factors.append(shifted_cholesky(product, shift))
        composed = factors[-1] @ composed
    # What the last product lacks to the identity (directions without variance) goes into the factor.
    rest = (axes * np.sqrt(np.maximum(values, 0))) @ axes.T
    _, sizes, vectors = np.linalg.svd(rest @ composed)
    rank = int((sizes > 16 * width * eps * sizes[0]).sum())
    keep = min(rank, most)
    vectors = vectors[:keep]
    largest = np.abs(vectors).argmax(axis=1)
    vectors = vectors * np.sign(vectors[np.arange(keep), largest])[:, None]
    out = Fit(n, sums, vectors, sizes[:keep] ** 2 / n, float((sizes**2).sum() / n), len(factors))
    white = gram(fit, centre, [], project_of(out)) / n
    out.identity_error = float(np.abs(white - np.eye(keep)).max())
    return out


def project_of(fit: Fit) -> np.ndarray:
    return (fit.vectors / np.sqrt(fit.variances)[:, None]).T


def whitened_rows(rows: DataFrame, fit: Fit, id_col: str) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error), one row per vector and component."""
    centre, project = Centre(fit.n, fit.sums), project_of(fit)
    width, count = project.shape
    explained = fit.variances / fit.trace

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, BATCH_BYTES):
            x = matrix(batch, width)
            take = pa.array(np.repeat(np.arange(len(x)), count))
            yield pa.RecordBatch.from_arrays(
                [
                    column(batch, "id").take(take),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(take), fit.n, np.int64)),
                    pa.array(centre.deviation(x), pa.int64()).take(take),
                    pa.array((centre(x) @ project).ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(take), fit.identity_error)),
                ],
                [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    schema = T.StructType(
        [T.StructField(id_col, rows.schema["id"].dataType), T.StructField("component", T.IntegerType())]
        + [T.StructField(c, T.LongType()) for c in ("n", "deviation")]
        + [T.StructField(c, T.DoubleType()) for c in ("whitened", "explained", "identity_error")]
    )
    return rows.select("id", "x").mapInArrow(apply, schema)


def whiten(vectors: DataFrame, most: int = 16, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Whitened vectors: their first ``most`` components, each with variance one over the fit list."""
    ship(vectors.sparkSession)
    rows = stage(integer_rows(vectors, id_col, vector_col), "integer-vectors")
    common = rows.groupBy("width").count().orderBy(F.desc("count"), F.desc("width")).first()
    width = common.width if common else 1
    rows = rows.where(F.col("width") == width)
    fit = fit_components(stage(rows.select("x").distinct(), "distinct-vectors"), width, most)
    if fit is None:
        empty = Fit(1, [0] * width, np.zeros((0, width)), np.zeros(0), 1.0, 0)
        return whitened_rows(rows.limit(0), empty, id_col)
    return whitened_rows(rows, fit, id_col)
