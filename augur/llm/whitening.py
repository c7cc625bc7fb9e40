"""Embedding whitening: pivoted Cholesky of the centred scatter, one-sided Jacobi on its factor.

Components become integers, x = floor(64 c) + 1000000, so means are far larger
than spreads and a covariance taken as E[xx'] - E[x]E[x]' would lose all its
digits. Sums are therefore exact integers throughout:

1. a scan adds up n and the per-dimension sums S;
2. a second scan centres every row on m, the integers nearest to S / n, and
   adds up the products of the centred rows. These are small integers, so
   double-precision matrix products of bounded slices are exact; the half unit
   that m leaves out is corrected in integers on the driver, which gives the
   centred scatter sum (n x - S)(n x - S)' / n without any rounding.

The scatter C (dimension x dimension, all that the driver ever holds) is
factored as P'CP = LL' with diagonal pivoting. One-sided Jacobi then rotates
pairs of columns of the triangular factor L itself until all are orthogonal:
LJ = U diag(s). So C = U diag(s^2) U': squared column norms are eigenvalues and
normalised columns are components; no product of L with itself is formed, which
keeps small eigenvalues to full relative accuracy. A round-robin pairs all
columns without overlap, so one numpy step rotates half of them at once.

3. a third scan projects (x - S/n) on the components over sqrt(eigenvalue) and
   adds up the products of the whitened rows, for the measured distance of
   their covariance from the identity; a last one returns the rows.

Cases. Rows whose vector is null or has a null, NaN or infinite entry are
dropped. Ids may be null or repeated; repeated rows are rows of the fit list.
Components with eigenvalue zero (constant or linearly dependent dimensions,
fewer rows than dimensions, a single row) have no whitened value and are left
out, as is every row when there is none; an empty table gives no rows. Equal eigenvalues
may have any orthonormal components. A vector whose length differs from the
others' raises ValueError, as do entries of 2**46 or more. ``deviation`` is exact; where
it doesn't fit 64 bits it is null, and ``deviation_exact`` (decimal) holds it.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from augur.llm.vectors import finite

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 32
ROWS = 4096  # rows of a matrix product
EXACT = 1 << 53  # whole numbers that doubles hold exactly
EPS = float(np.finfo(np.float64).eps)


def whole_numbers(vectors: pa.Array, dim: int) -> np.ndarray:
    """x-vectors of a slice, a row each."""
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    if (lengths != dim).any():
        raise ValueError(f"vectors of {dim} and {lengths[lengths != dim][0]} entries")
    x = np.floor(SCALE * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    if x.size and np.abs(x).max() >= EXACT >> 1:
        raise ValueError("entries of 2**46 or more")
    return x.astype(np.int64).reshape(len(vectors), dim) + SHIFT


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS):
            yield batch.slice(first, ROWS)


# -- sums and scatter ---------------------------------------------------------


def _sums(dim: int):
    def scan(batches):
        n, total = 0, np.zeros(dim, dtype=object)
        for part in _slices(batches):
            x = whole_numbers(part.column(0), dim)
            n, total = n + len(x), total + x.sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(dim + 1, dtype=np.int64)),  # the last cell is n
                    pa.array([*map(int, total), n], type=pa.decimal128(38, 0)),
                ],
                names=["cell", "total"],
            )

    return scan


def exact_products(x: np.ndarray) -> np.ndarray:
    """x'x of whole numbers, exactly: by doubles in slices whose sums they hold,
    by Python integers where a single product is too large."""
    top = int(np.abs(x).max()) if x.size else 0
    rows = (EXACT - 1) // max(1, top * top)
    if rows < 1:
        big = x.astype(object)
        return big.T @ big
    out = np.zeros((x.shape[1],) * 2, dtype=object if len(x) * top * top >= 1 << 62 else np.int64)
    for first in range(0, len(x), rows):
        d = x[first : first + rows].astype(np.float64)
        out += (d.T @ d).astype(np.int64)
    return out


def _products(dim: int, centre: np.ndarray):
    upper = np.triu_indices(dim)
    cells = upper[0].astype(np.int64) * dim + upper[1]

    def scan(batches):
        total, some = np.zeros(len(cells), dtype=object), False
        for part in _slices(batches):
            total, some = total + exact_products(whole_numbers(part.column(0), dim) - centre)[upper], True
        if some:
            yield pa.RecordBatch.from_arrays(
                [pa.array(cells), pa.array([int(v) for v in total], type=pa.decimal128(38, 0))], names=["cell", "total"]
            )

    return scan


def _collected(vectors: DataFrame, scan) -> dict[int, int]:
    """Cell totals: as many rows as the scan has cells, whatever the table's size."""
    cells = vectors.select("embedding").mapInArrow(scan, "cell long, total decimal(38,0)")
    return {r["cell"]: int(r["total"]) for r in cells.groupBy("cell").agg(F.sum("total").alias("total")).collect()}


@dataclass
class Scatter:
    """n, exact sums S, the centre m = round(S / n), and n * n times the covariance."""

    n: int
    sums: list[int]
    centre: np.ndarray
    scatter: list[list[int]]

    def covariance(self) -> np.ndarray:
        return np.array([[v / (self.n * self.n) for v in row] for row in self.scatter], dtype=np.float64)

    def rest(self) -> np.ndarray:
        """S / n - m, at most a half."""
        return np.array([(s - self.n * int(m)) / self.n for s, m in zip(self.sums, self.centre, strict=True)])


def scatter_of(vectors: DataFrame) -> Scatter | None:
    """Exact centred scatter of whole vectors; None where there are none."""
    first = vectors.select(F.size("embedding").alias("d")).first()
    if first is None:
        return None
    dim = int(first["d"])
    found = _collected(vectors, _sums(dim))
    n, sums = found[dim], [found[k] for k in range(dim)]
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], dtype=np.int64)
    products = _collected(vectors, _products(dim, centre))
    rest = [s - n * int(m) for s, m in zip(sums, centre, strict=True)]
    scatter = [[n * products[min(i, j) * dim + max(i, j)] - rest[i] * rest[j] for j in range(dim)] for i in range(dim)]
    return Scatter(n, sums, centre, scatter)


# -- factor and rotations -----------------------------------------------------


def pivoted_cholesky(c: np.ndarray) -> np.ndarray:
    """L (rows in the order of ``c``, a column for each pivot) with LL' = c.
    Stops when what is left of every dimension is rounding of its own variance."""
    d = len(c)
    left = np.diag(c).copy()
    least = d * EPS * left
    factor = np.zeros((d, d))
    free = np.ones(d, dtype=bool)
    for k in range(d):
        open_ = np.flatnonzero(free & (left > least) & (left > 0))
        if not len(open_):
            return factor[:, :k]
        p = open_[np.argmax(left[open_])]
        free[p] = False
        factor[p, k] = np.sqrt(left[p])
        rows = np.flatnonzero(free)
        factor[rows, k] = (c[rows, p] - factor[rows, :k] @ factor[p, :k]) / factor[p, k]
        left[rows] -= factor[rows, k] ** 2
    return factor


def _rounds(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """A round-robin of n columns: every pair once, no column twice in a round."""
    seats = list(range(n + n % 2))
    out = []
    for _ in range(len(seats) - 1):
        half = len(seats) // 2
        pairs = [(a, b) for a, b in zip(seats[:half], seats[: half - 1 : -1], strict=True) if max(a, b) < n]
        out.append((np.array([min(p) for p in pairs]), np.array([max(p) for p in pairs])))
        seats = [seats[0], seats[-1], *seats[1:-1]]
    return out


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, components) of factor @ factor.T, largest first: columns
    of ``factor`` are rotated in pairs until all pairs are orthogonal."""
    a = factor.copy()
    tolerance = 8 * EPS
    for _ in range(sweeps):
        worst = 0.0
        for p, q in _rounds(a.shape[1]) if a.shape[1] > 1 else []:
            x, y = a[:, p], a[:, q]
            xx, yy, xy = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            cosine = np.abs(xy) / np.sqrt(xx * yy)
            worst = max(worst, float(cosine.max()))
            turn = cosine > tolerance
            zeta = (yy[turn] - xx[turn]) / (2 * xy[turn])
            tangent = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta))
            cos = 1 / np.sqrt(1 + tangent * tangent)
            sin = cos * tangent
            x, y, p, q = x[:, turn], y[:, turn], p[turn], q[turn]
            a[:, p], a[:, q] = cos * x - sin * y, sin * x + cos * y
        if worst <= tolerance:
            break
    values = (a * a).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    return values[order], a[:, order] / np.sqrt(values[order])


# -- whitening ----------------------------------------------------------------


@dataclass
class Whitener:
    fitted: Scatter
    values: np.ndarray  # eigenvalues kept, falling
    components: np.ndarray  # a column each
    explained: np.ndarray

    def __post_init__(self):
        # the components' scaled matrix and the mean's place, once
        self.weights = self.components / np.sqrt(self.values)
        self.rest = self.fitted.rest()
        self.over = np.array([s - self.fitted.n * int(m) for s, m in zip(self.fitted.sums, self.fitted.centre, strict=True)], dtype=object)

    def whitened(self, vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(x - m as whole numbers, whitened rows) of a slice."""
        x = whole_numbers(vectors, len(self.rest)) - self.fitted.centre
        return x, (x - self.rest) @ self.weights

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n x - S)^2, for rows given as x - m."""
        n, dim = self.fitted.n, x.shape[1]
        top = n * (int(np.abs(x).max(initial=0)) + 1)
        if top * top * dim < 1 << 62:
            y = n * x - self.over.astype(np.int64)
            return np.einsum("ij,ij->i", y, y).tolist()
        y = n * x.astype(object) - self.over
        return (y * y).sum(axis=1).tolist()


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """Whitening of whole vectors (embedding); None without any row."""
    fitted = scatter_of(vectors)
    if fitted is None:
        return None
    covariance = fitted.covariance()
    trace = sum(fitted.scatter[i][i] for i in range(len(covariance))) / (fitted.n * fitted.n)
    values, vectors_ = one_sided_jacobi(pivoted_cholesky(covariance))
    kept = slice(0, min(components, len(values)))
    return Whitener(fitted, values[kept], vectors_[:, kept], values[kept] / trace if trace else values[kept])


def _moments(whitener: Whitener):
    """Per task: row count, sums and products of the whitened rows, as one row
    of cells (added up exactly enough: the rows are centred, of order one)."""
    k = len(whitener.values)

    def scan(batches):
        n, total, products = 0, np.zeros(k), np.zeros((k, k))
        for part in _slices(batches):
            _, w = whitener.whitened(part.column(0))
            n, total, products = n + len(w), total + w.sum(axis=0), products + w.T @ w
        if n:
            cells = np.concatenate([total, products.reshape(-1)])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(cells)], names=["cell", "total"])

    return scan


def identity_error(vectors: DataFrame, whitener: Whitener) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    k, n = len(whitener.values), whitener.fitted.n
    cells = vectors.select("embedding").mapInArrow(_moments(whitener), "cell long, total double")
    found = cells.groupBy("cell").agg(F.sum("total").alias("total")).orderBy("cell").collect()  # k + k * k rows
    totals = np.array([r["total"] for r in found])
    mean = totals[:k] / n
    return float(np.abs(totals[k:].reshape(k, k) / n - np.outer(mean, mean) - np.eye(k)).max())


def _rows(whitener: Whitener):
    def scan(batches):
        for part in _slices(batches):
            x, w = whitener.whitened(part.column("embedding"))
            exact = whitener.deviations(x)
            offsets = np.arange(len(w) + 1, dtype=np.int32) * w.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("vec_id"),
                    pa.array([v if v < 1 << 63 else None for v in exact], type=pa.int64()),
                    pa.array(exact, type=pa.decimal128(38, 0)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(w.reshape(-1))),
                ],
                names=["vec_id", "deviation", "deviation_exact", "whitened"],
            )

    return scan


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> tuple[DataFrame, Whitener | None]:
    """A row for each whole vector of ``vectors`` (vec_id, embedding): vec_id,
    deviation, deviation_exact and whitened (an array, a value a component);
    and the fitted whitening."""
    vectors = vectors.select("vec_id", "embedding").filter(finite())
    whitener = fit(vectors, components)
    schema = f"vec_id {vectors.schema['vec_id'].dataType.simpleString()}, deviation long, deviation_exact decimal(38,0), whitened array<double>"
    if whitener is None or not len(whitener.values):
        return vectors.sparkSession.createDataFrame([], schema), whitener
    return vectors.mapInArrow(_rows(whitener), schema), whitener


def op13_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    """Contract query over whole ``embeddings``."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows, whitener = whiten(vectors)
    some = whitener is not None and len(whitener.values)
    error = identity_error(vectors.filter(finite()), whitener) if some else 0.0
    explained = F.array(*map(F.lit, whitener.explained.tolist())) if some else F.array(F.lit(0.0))
    long = rows.select("vec_id", "deviation", "deviation_exact", F.posexplode("whitened").alias("_at", "whitened"))
    return long.select(
        "vec_id",
        (F.col("_at") + 1).alias("component"),
        F.lit(whitener.fitted.n if whitener else 0).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained[F.col("_at")].alias("explained"),
        F.lit(error).alias("identity_error"),
        "deviation_exact",
    )
