"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi.

Vectors are first made whole numbers: x = floor(256 * c) of every entry. The model is
fitted on each distinct x vector once: a first pass over this list sums its
dimensions, a second the products of the centred entries (d * d numbers a task, summed
on Spark by entry). Only that d * d scatter reaches the driver: it is factored as
P L L' P' with complete pivoting, and columns of L are rotated in pairs until all are
orthogonal. Their squared norms are then the scatter's eigenvalues, the normalised
columns its eigenvectors. No d * d product is formed again, so small eigenvalues keep
their digits.

Results in special cases: rows whose vector is null or has a null or non-finite entry
are left out, and so are those whose length is not the most frequent one (of equally
frequent lengths, the largest); repeated rows each get their result but count once in the fit; an
entry beyond the range of a long takes the nearest long; a deviation beyond it is null;
components without variance do not exist, so constant or too few vectors give fewer than
asked for, maybe none; equal eigenvalues keep the order of the pivots; an empty table gives a
model without components and no rows; other columns stay, the result column takes a name
that is free.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadsift.llm.tables import temporary_name, written

SCALE = 256
#: A pivot (a rest of variance) below this share of the largest variance counts as none.
RANK_SHARE = 1e-13
#: Columns count as orthogonal at this cosine.
COSINE = 1e-15
MAX_SWEEPS = 60


@dataclass
class Whitening:
    """``vectors``: d rows, a column a component; ``values``: eigenvalues of the covariance, falling."""

    n: int
    dims: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float | None

    @property
    def explained(self) -> list[float]:
        return [float(v) / self.trace for v in self.values]


def whole(column: str):
    """The vector as longs; null if it is null or has a null or non-finite entry."""
    entry = F.col(column)
    fine = F.forall(entry, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    return F.when(fine, F.transform(entry, lambda c: F.floor(c.cast("double") * SCALE)))


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """The factor of a positive semidefinite matrix, rows in their places: ``a`` = F F', as many columns as its rank."""
    rest, columns = np.diag(a).astype(float).copy(), []
    least = RANK_SHARE * max(rest.max(initial=0.0), 0.0)
    done = np.zeros(len(a), bool)
    for _ in range(len(a)):
        pivot = int(np.argmax(np.where(done, -1.0, rest)))
        if done[pivot] or rest[pivot] <= least:
            break
        column = a[:, pivot].astype(float).copy()
        for c in columns:
            column -= c[pivot] * c
        column[done] = 0.0
        column /= np.sqrt(rest[pivot])
        column[pivot] = np.sqrt(rest[pivot])
        done[pivot] = True
        rest = np.where(done, 0.0, rest - column ** 2)
        columns.append(column)
    return np.stack(columns, axis=1) if columns else np.empty((len(a), 0))


def one_sided_jacobi(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors of ``factor factor'``.

    Every round rotates disjoint pairs of columns, so that each pair becomes orthogonal; a
    sweep of rounds meets all pairs (round-robin order).
    """
    u = factor.copy()
    width = u.shape[1]
    seats = list(range(width + width % 2))
    for _ in range(MAX_SWEEPS if width > 1 else 0):
        worst = 0.0
        for _ in range(len(seats) - 1):
            pairs = [(a, b) for a, b in zip(seats[: len(seats) // 2], reversed(seats[len(seats) // 2:])) if max(a, b) < width]
            seats = [seats[0], seats[-1], *seats[1:-1]]
            p, q = np.array(pairs).T
            x, y = u[:, p], u[:, q]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            cosine = np.abs(xy) / np.sqrt(xx * yy)
            worst = max(worst, cosine.max())
            turn = cosine > COSINE
            zeta = (yy - xx) / np.where(turn, 2 * xy, 1.0)
            tangent = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = np.where(turn, 1 / np.hypot(1.0, tangent), 1.0)
            s = np.where(turn, tangent * c, 0.0)
            u[:, p], u[:, q] = c * x - s * y, s * x + c * y
        if worst <= COSINE:
            break
    values = (u * u).sum(0)
    order = np.argsort(-values, kind="stable")
    return values[order], u[:, order] / np.sqrt(values[order])


def _entries(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def fit(df: DataFrame, column: str, components: int) -> Whitening:
    """Means, the first ``components`` components and their variances."""
    rows = df.select(whole(column).alias("x")).where(F.col("x").isNotNull())
    distinct = rows.distinct()
    lengths = rows.groupBy(F.size("x").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    best = lengths.agg(F.max(F.struct("n", "dims")).alias("m")).first()["m"]
    dims = best["dims"] if best else 0
    if not dims:
        return Whitening(0, 0, [], np.empty((0, 0)), np.empty(0), 0.0, None)
    # every distinct vector once; three passes read this table
    listed = written(distinct.where(F.size("x") == dims), "whitening-fit")

    def partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dims, object)
        for batch in batches:
            x = _entries(batch, dims)
            n, total = n + len(x), total + x.astype(object).sum(0) if _large(x) else total + x.sum(0)
        if n:
            yield pa.RecordBatch.from_pydict({"i": np.arange(dims, dtype=np.int32), "n": [n] * dims, "total": [str(t) for t in total]})

    parts = listed.mapInArrow(partial_sums, "i int, n bigint, total string")
    sums = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    n, totals = sums[0]["n"], [int(r["total"]) for r in sorted(sums)]
    mean = np.array([t / n for t in totals])

    def partial_products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            y = _entries(batch, dims) - mean
            total += y.T @ y
        at = np.triu_indices(dims)
        yield pa.RecordBatch.from_pydict({"i": at[0].astype(np.int32), "j": at[1].astype(np.int32), "product": total[at]})

    products = listed.mapInArrow(partial_products, "i int, j int, product double")
    scatter = np.zeros((dims, dims))
    # d * (d + 1) / 2 rows, however long the list is
    for i, j, product in products.groupBy("i", "j").agg(F.sum("product")).collect():
        scatter[i, j] = scatter[j, i] = product
    values, vectors = one_sided_jacobi(pivoted_cholesky(scatter))
    values, vectors = values[:components] / n, vectors[:, :components]
    model = Whitening(n, dims, totals, vectors, values, float(np.trace(scatter)) / n, None)
    model.identity_error = _identity_error(listed, model)
    return model


def _large(x: np.ndarray) -> bool:
    """Whether sums of a batch's entries could pass a long."""
    return bool(len(x)) and float(np.abs(x.astype(float)).max()) * len(x) >= 2.0 ** 62


def _whitened(x: np.ndarray, model: Whitening) -> np.ndarray:
    return ((x - np.array([t / model.n for t in model.sums])) @ model.vectors) / np.sqrt(model.values)


def _identity_error(listed: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the whitened list's covariance minus the identity."""
    k = len(model.values)
    if not k:
        return None

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = _whitened(_entries(batch, model.dims), model)
            yield pa.RecordBatch.from_arrays([pa.array(w[:, i]) for i in range(k)], names=[f"w{i}" for i in range(k)])

    rows = listed.mapInArrow(whiten, ", ".join(f"w{i} double" for i in range(k)))
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = rows.agg(*[F.covar_pop(f"w{i}", f"w{j}") for i, j in pairs]).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(found, pairs))


def deviations(x: np.ndarray, model: Whitening) -> list[int | None]:
    """Sum over the dimensions of (n * x - S) ** 2, exact; null beyond a long."""
    rough = ((model.n * x.astype(float) - np.array(model.sums, float)) ** 2).sum(1)
    safe = bool(len(rough)) and rough.max() < 2.0 ** 62 and model.n * np.abs(x.astype(float)).max() < 2.0 ** 62
    if safe:
        return ((model.n * x - np.array(model.sums, np.int64)) ** 2).sum(1).tolist()
    exact = [sum((model.n * int(e) - s) ** 2 for e, s in zip(row, model.sums)) for row in x]
    return [d if d < 2 ** 63 else None for d in exact]


def transform(df: DataFrame, column: str, model: Whitening, name: str = "whitening") -> tuple[DataFrame, str]:
    """The remaining rows of ``df`` and the struct column ``deviation``, ``whitened`` (an entry a component), and its name."""
    name = temporary_name(df, name)

    @F.arrow_udf("struct<deviation: bigint, whitened: array<double>>")
    def apply(vectors: pa.Array) -> pa.Array:
        x = vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, model.dims)
        w = _whitened(x, model)
        return pa.StructArray.from_arrays(
            [pa.array(deviations(x, model), pa.int64()), pa.array(list(w), pa.list_(pa.float64()))], ["deviation", "whitened"])

    x = temporary_name(df, "_x")
    rows = df.withColumn(x, whole(column)).where(F.size(x) == model.dims)
    if not model.dims:
        return rows.withColumn(name, F.lit(None).cast("struct<deviation: bigint, whitened: array<double>>")).where(F.lit(False)).drop(x), name
    return rows.withColumn(name, apply(F.col(x))).drop(x), name
