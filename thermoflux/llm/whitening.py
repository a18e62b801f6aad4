"""Embedding whitening by pivoted Cholesky and one-sided Jacobi (operator 11).

1. Entries become integers, floor(scale * c) + shift; their number and sums are exact.
2. The centred scatter, the sum of (x - S/n)(x - S/n)^T, is summed per partition in double
   precision and folded over the partitions by a Spark aggregate of dims**2 cells.
3. On the driver, which only sees that dims x dims matrix: pivoted Cholesky gives a triangular
   factor whose columns fall, and stops at the numerical rank; one-sided Jacobi rotates the
   factor's columns until they are orthogonal.  Squared column norms are the eigenvalues, the
   normalised columns the components.
4. Each row is projected, map-only.  The identity error is measured on the projected rows.

Defined cases: vectors that are null, empty, or hold null or non-finite entries take no part,
nor do those whose length is not the commonest one (the longest of equally common); a null or
repeated ``vec_id`` is kept, each row by itself; components beyond the rank of the covariance
do not exist, so a table of one distinct vector gives no rows, as an empty one does; equal
eigenvalues leave their components free within their plane; an entry that scaled passes 2**62
is taken as not finite; ``deviation`` is decimal(38, 0), exact, and null beyond; other columns are not read, so names never clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermoflux.llm.common import written

#: Sweeps of the Jacobi rotations at most; it ends when no rotation is needed (about 8 do).
SWEEPS = 60


def usable_integers(vectors: DataFrame, scale: int = 1024, shift: int = 100_000, id_col: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(vec_id, x array<bigint>) of the vectors that take part."""
    c = F.col(column).cast("array<double>")
    good = vectors.where(F.coalesce(F.size(column) > 0, F.lit(False)) & F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v * scale) < float(1 << 62))))
    good = good.select(F.col(id_col).alias("vec_id"), F.transform(c, lambda v: F.floor(v * scale).cast("long") + shift).alias("x"))
    commonest = good.groupBy(F.size("x").alias("dims")).agg(F.count(F.lit(1)).alias("rows")).agg(F.max(F.struct("rows", "dims"))["dims"].alias("dims"))
    return good.join(F.broadcast(commonest), F.size("x") == F.col("dims")).drop("dims")  # one row


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def count_and_sums(ints: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum of each dimension."""
    per = ints.select(F.posexplode("x").alias("at", "v")).groupBy("at").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("s"))
    rows = sorted(per.collect())  # one row for each dimension
    return (rows[0].n if rows else 0), [int(r.s) for r in rows]


def _centred(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """n*x - S as exact integers, and x - S/n rounded once."""
    most = max(1, int(np.abs(x).max(initial=0)))
    if n * most * 2 < 1 << 62:
        exact = x * np.int64(n) - np.array(sums, np.int64)
    else:
        exact = x.astype(object) * n - np.array(sums, object)
    return exact, (exact / n).astype(np.float64)


def scatter(ints: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The centred scatter matrix."""
    dims = len(sums)
    schema = pa.schema([("cell", pa.int64()), ("v", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        seen = False
        for batch in batches:
            _, y = _centred(_matrix(batch, dims), n, sums)
            total += y.T @ y
            seen = seen or len(y) > 0
        if seen:
            at = np.flatnonzero(np.triu(np.ones((dims, dims), bool)))
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at])], schema=schema)

    cells = ints.select("x").mapInArrow(run, "cell bigint, v double").groupBy("cell").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(dims * dims)
    out[cells["cell"].to_numpy()] = cells["v"].to_numpy()
    out = out.reshape(dims, dims)
    return np.triu(out) + np.triu(out, 1).T


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(L, order) with a[order][:, order] = L L^T; L is dims x rank, lower triangular."""
    a, dims = a.copy(), len(a)
    order, left = np.arange(dims), np.zeros((dims, dims))
    floor = dims * np.finfo(float).eps * max(a.diagonal().max(initial=0.0), 0.0)
    for k in range(dims):
        p = k + int(np.argmax(a.diagonal()[k:]))
        if a[p, p] <= floor:
            return left[:, :k], order
        swap = [p, k]
        a[[k, p]] = a[swap]
        a[:, [k, p]] = a[:, swap]
        left[[k, p]] = left[swap]
        order[[k, p]] = order[swap]
        left[k, k] = np.sqrt(a[k, k])
        left[k + 1:, k] = a[k + 1:, k] / left[k, k]
        a[k + 1:, k + 1:] -= np.outer(left[k + 1:, k], left[k + 1:, k])
    return left, order


def one_sided_jacobi(factor: np.ndarray) -> np.ndarray:
    """``factor`` with its columns rotated until every two are orthogonal.  A round rotates
    disjoint pairs, dealt as in a round-robin tournament, all at once."""
    g = factor.copy()
    k = g.shape[1]
    if k < 2:
        return g
    seats = list(range(k + k % 2))
    half = len(seats) // 2
    small = np.finfo(float).eps * 2
    for _ in range(SWEEPS):
        turned = False
        for _ in range(len(seats) - 1):
            pairs = [(a, b) for a, b in zip(seats[:half], seats[:half - 1:-1], strict=True) if a < k and b < k]
            seats = [seats[0], seats[-1], *seats[1:-1]]
            p, q = np.array(pairs).T
            x, y = g[:, p], g[:, q]
            aa, bb, ab = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            todo = np.abs(ab) > small * np.sqrt(aa * bb)
            if not todo.any():
                continue
            turned = True
            with np.errstate(divide="ignore", invalid="ignore"):
                zeta = (bb - aa) / (2 * ab)
                t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta))
            t = np.where(todo, t, 0.0)
            c = 1 / np.sqrt(1 + t * t)
            s = c * t
            g[:, p], g[:, q] = c * x - s * y, s * x + c * y
        if not turned:
            break
    return g


def principal_components(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, components as rows) by falling eigenvalue, as many as the rank."""
    left, order = pivoted_cholesky(covariance)
    if not left.shape[1]:
        return np.zeros(0), np.zeros((0, len(covariance)))
    turned = one_sided_jacobi(left)
    norms = np.sqrt((turned * turned).sum(0))
    by = np.argsort(-norms, kind="stable")
    components = np.zeros((len(by), len(covariance)))
    components[:, order] = (turned / norms)[:, by].T
    return norms[by] ** 2, components


def whitened(vectors: DataFrame, most: int = 8, scale: int = 1024, shift: int = 100_000, id_col: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for each
    vector that takes part and each of the first ``most`` components."""
    ints = written(usable_integers(vectors, scale, shift, id_col, column), "integers")
    id_type = ints.schema["vec_id"].dataType.simpleString()
    n, sums = count_and_sums(ints)
    if n:
        covariance = scatter(ints, n, sums) / n
        values, components = principal_components(covariance)
    else:
        covariance, values, components = np.zeros((0, 0)), np.zeros(0), np.zeros((0, 0))
    k, dims = min(most, len(values)), len(sums)
    if not k:
        return ints.select("vec_id").where(F.lit(False)).select(
            "vec_id", *[F.lit(None).cast(t).alias(c) for c, t in (("component", "int"), ("n", "long"), ("deviation", "decimal(38,0)"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double"))])
    project = (components[:k] / np.sqrt(values[:k])[:, None]).T
    trace = float(np.trace(covariance))
    schema = pa.schema([("vec_id", ints.select("vec_id").limit(0).toArrow().schema.field("vec_id").type), ("deviation", pa.decimal128(38, 0)), ("z", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            exact, y = _centred(_matrix(batch, dims), n, sums)
            largest = max(1, int(np.abs(exact).max(initial=0)))
            squares = ((exact * exact) if largest * largest * dims < 1 << 62 else exact.astype(object) ** 2).sum(1)
            z = y @ project
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array([Decimal(int(v)) if v < 10**38 else None for v in squares], pa.decimal128(38, 0)),
                                              pa.array(list(z), pa.list_(pa.float64()))], schema=schema)

    rows = written(ints.mapInArrow(run, f"vec_id {id_type}, deviation decimal(38,0), z array<double>"), "whitened")
    z = [F.col("z")[i] for i in range(k)]
    means = rows.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(z)]).first()
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    measured = rows.agg(*[F.avg((z[i] - means[i]) * (z[j] - means[j])).alias(f"c{i}_{j}") for i, j in pairs]).first()
    error = max(abs(v - (i == j)) for v, (i, j) in zip(measured, pairs, strict=True))
    share = F.array(*[F.lit(float(v) / trace) for v in values[:k]])
    return rows.select("vec_id", "deviation", F.posexplode("z").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        share[F.col("at")].alias("explained"), F.lit(float(error)).alias("identity_error"))
