"""Embedding whitening by pivoted Cholesky and one-sided Jacobi.

Entries are rounded down to 1/256 and become whole numbers.  Tasks sum the distinct vectors and
their centred scatter; only numbers per dimension and one square matrix of the dimensions reach
the driver, however many vectors there are.  There a pivoted Cholesky factor of the covariance is
made, and Jacobi rotations of its columns make them orthogonal: their squared norms are the
eigenvalues and the columns, normalised, the components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from millrace.llm.common import materialise

SCALE = 256
# An entry times SCALE must lie below this, so that it is a long; a vector beyond counts as not finite.
LIMIT = 2.0**62
COMPONENTS = 4
SWEEPS = 60

RESULT = T.StructType([T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])


def scaled(column: pa.Array) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Places of the vectors without null or non-finite entries, their lengths and their whole numbers.

    Vectors of one length are taken together.
    """
    sizes = np.diff(np.asarray(column.offsets)) if isinstance(column, pa.ListArray) else np.array([len(v.as_py() or ()) for v in column])
    values = np.asarray(column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False), np.float64) * SCALE
    valid = np.asarray(column.is_valid())
    sizes = np.where(valid, sizes, 0).astype(np.int64)
    good = np.isfinite(values) & (np.abs(np.where(np.isfinite(values), values, 0)) < LIMIT)
    ends = np.cumsum(sizes)
    bad = np.concatenate([[0], np.cumsum(~good)])
    whole = valid & (sizes > 0) & (bad[ends] == bad[ends - sizes])
    places, lengths, blocks = [], [], []
    for length in np.unique(sizes[whole]):
        at = np.flatnonzero(whole & (sizes == length))
        cells = (ends[at] - length)[:, None] + np.arange(length)
        places.append(at)
        lengths.append(length)
        blocks.append(np.floor(values[cells]).astype(np.int64))
    return places, lengths, blocks


def _fit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, length, block in zip(*scaled(batch.column(0))):
            packed = [row.tobytes() for row in block.astype("<i8")]
            yield pa.RecordBatch.from_arrays([pa.array([int(length)] * len(packed), pa.int32()), pa.array(packed, pa.binary())], names=["dims", "x"])


def _unpacked(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(-1, dims)


def _sums(dims: int):
    """Of all vectors of a task: per dimension the count and the sums of upper and lower halves, which stay exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, upper, lower = 0, np.zeros(dims, np.int64), np.zeros(dims, np.int64)
        for batch in batches:
            x = _unpacked(batch.column(0), dims)
            n, upper, lower = n + len(x), upper + (x >> 31).sum(axis=0), lower + (x & 0x7FFFFFFF).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_pydict({"dim": np.arange(dims, dtype=np.int32), "n": np.full(dims, n, np.int64), "upper": upper, "lower": lower})

    return run


def _scatter(mean: np.ndarray):
    """Centred products of all vectors of a task, a row for each dimension."""
    dims = len(mean)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                centred = _unpacked(batch.column(0), dims) - mean
                total = centred.T @ centred if total is None else total + centred.T @ centred
        if total is not None:
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, dims * dims + 1, dims), pa.int32()), pa.array(total.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims), pa.int32()), lists], names=["i", "row"])

    return run


def pivoted_cholesky(matrix: np.ndarray) -> np.ndarray:
    """Factor L with ``matrix`` = L @ L.T: the columns of a triangle in the order of its pivots, as many as the rank.

    Each step takes the dimension with most variance left.  Rows stay in the order of the matrix.
    """
    size = len(matrix)
    left = matrix.diagonal().copy()
    least = size * np.finfo(float).eps * max(left.max(initial=0.0), 0.0)
    factor = np.zeros((size, size))
    open_rows = np.ones(size, bool)
    for step in range(size):
        pivot = int(np.argmax(np.where(open_rows, left, -1.0)))
        if left[pivot] <= least:
            return factor[:, :step]
        column = matrix[:, pivot] - factor[:, :step] @ factor[pivot, :step]
        column[~open_rows] = 0.0
        factor[:, step] = column / np.sqrt(left[pivot])
        factor[pivot, step] = np.sqrt(left[pivot])
        left -= factor[:, step] ** 2
        open_rows[pivot] = False
    return factor


def one_sided_jacobi(factor: np.ndarray, tolerance: float = 1e-15) -> np.ndarray:
    """The factor's columns rotated until every two of them are orthogonal, longest first.

    A sweep meets all pairs in rounds of disjoint pairs, so a round rotates half the columns at once.
    """
    lines = factor.T.copy()
    count = len(lines)
    ring = list(range(count)) + ([-1] if count % 2 else [])
    for _ in range(SWEEPS):
        worst = 0.0
        for _ in range(len(ring) - 1):
            half = len(ring) // 2
            pairs = [(a, b) for a, b in zip(ring[:half], reversed(ring[half:])) if a >= 0 and b >= 0]
            p, q = (np.array(side) for side in zip(*pairs)) if pairs else (np.zeros(0, int),) * 2
            ring = [ring[0], ring[-1], *ring[1:-1]]
            one, two = lines[p], lines[q]
            a, b, c = (one * one).sum(axis=1), (two * two).sum(axis=1), (one * two).sum(axis=1)
            scale = np.sqrt(a * b)
            off = np.divide(np.abs(c), scale, out=np.zeros_like(c), where=scale > 0)
            worst = max(worst, float(off.max(initial=0.0)))
            turn = off > tolerance
            if not turn.any():
                continue
            p, q, one, two, a, b, c = p[turn], q[turn], one[turn], two[turn], a[turn], b[turn], c[turn]
            zeta = (b - a) / (2 * c)
            tangent = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta))
            cosine = 1 / np.sqrt(1 + tangent * tangent)
            sine = cosine * tangent
            lines[p] = cosine[:, None] * one - sine[:, None] * two
            lines[q] = sine[:, None] * one + cosine[:, None] * two
        if worst <= 100 * tolerance:
            break
    norms = (lines * lines).sum(axis=1)
    return lines[np.argsort(-norms, kind="stable")].T


@dataclass
class Whitening:
    """n distinct vectors, exact sums S per dimension, eigenvalues, unit components (columns), shares of the trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    explained: np.ndarray
    identity_error: float | None = None

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Projections of x - S/n over the root of each eigenvalue."""
        return ((x - self.mean) @ self.components) / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n*x - S)^2 over the dimensions, exact; None beyond the range of a long."""
        reach = (np.abs(x).max(axis=1, initial=0).astype(float) * self.n + max(map(abs, self.sums), default=0)) ** 2 * len(self.sums)
        out: list[int | None] = [None] * len(x)
        near = np.flatnonzero(reach < 2.0**62)
        if len(near):
            gap = self.n * x[near] - np.array(self.sums, np.int64)
            for at, value in zip(near.tolist(), (gap * gap).sum(axis=1).tolist()):
                out[at] = value
        for at in np.flatnonzero(reach >= 2.0**62).tolist():
            exact = sum((self.n * v - s) ** 2 for v, s in zip(x[at].tolist(), self.sums))
            out[at] = exact if exact < 2**63 else None
        return out

    def apply(self, vectors: DataFrame, vector: str = "embedding", into: str = "whitening") -> DataFrame:
        """Rows whose vector is usable, without it and with a struct ``into`` (replacing a column called so)."""
        kept = [c for c in vectors.columns if c != vector and c.lower() != into.lower()]
        schema = T.StructType([*vectors.select(*kept).schema.fields, T.StructField(into, RESULT)])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at, length, x in zip(*scaled(batch.column(len(kept)))):
                    if length != len(self.sums):
                        continue
                    white = self.whitened(x)
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, white.size + 1, white.shape[1]), pa.int32()), pa.array(white.ravel()))
                    cell = pa.StructArray.from_arrays([pa.array(self.deviations(x), pa.int64()), lists], names=["deviation", "whitened"])
                    rows = batch.take(pa.array(at))
                    yield pa.RecordBatch.from_arrays([*(rows.column(i) for i in range(len(kept))), cell], names=[*kept, into])

        return vectors.select(*kept, F.col(vector).cast("array<double>").alias("_vector")).mapInArrow(run, schema)


def fit(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Mean and leading components of the distinct vectors, or None where nothing varies.

    Copies merge on the map side.  Vectors that are null, empty or hold null or non-finite entries
    are left out, as are those of another length than most rows have (of two lengths with as many
    rows the greater one counts).  The driver holds numbers per dimension and the covariance.
    """
    rows = vectors.select(F.col(vector).cast("array<double>").alias("vector")).mapInArrow(_fit_rows, "dims int, x binary")
    listed = materialise(rows.groupBy("dims", "x").agg(F.count(F.lit(1)).alias("copies")), "whitening-list")
    # One row for each length that occurs.
    most = listed.groupBy("dims").agg(F.sum("copies").alias("rows")).orderBy(F.desc("rows"), F.desc("dims")).first()
    if most is None:
        return None
    dims = most["dims"]
    x = listed.filter(F.col("dims") == dims).select("x")
    exact = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "upper", "lower")]
    per_dim = x.mapInArrow(_sums(dims), "dim int, n long, upper long, lower long").groupBy("dim").agg(*exact).orderBy("dim").collect()
    n, sums = int(per_dim[0]["n"]), [(int(r["upper"]) << 31) + int(r["lower"]) for r in per_dim]
    mean = np.array([s / n for s in sums])
    parts = x.mapInArrow(_scatter(mean), "i int, row array<double>").select("i", F.posexplode("row").alias("j", "value"))
    cells = parts.groupBy("i", "j").agg(F.sum("value").alias("value")).toArrow()
    covariance = np.zeros((dims, dims))
    covariance[np.asarray(cells["i"]), np.asarray(cells["j"])] = np.asarray(cells["value"]) / n
    covariance = (covariance + covariance.T) / 2
    columns = one_sided_jacobi(pivoted_cholesky(covariance))[:, :components]
    values = (columns * columns).sum(axis=0)
    if not len(values):
        return None
    model = Whitening(n, sums, values, columns / np.sqrt(values), values / covariance.trace())
    model.identity_error = _identity_error(x, model)
    return model


def _identity_error(x: DataFrame, model: Whitening) -> float:
    """Largest entry by which the covariance of the whitened distinct vectors differs from the identity."""
    dims, count = len(model.sums), len(model.values)
    names = [f"w{k}" for k in range(count)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            white = model.whitened(_unpacked(batch.column(0), dims))
            yield pa.RecordBatch.from_arrays([pa.array(white[:, k]) for k in range(count)], names=names)

    pairs = list(combinations_with_replacement(range(count), 2))
    found = x.mapInArrow(run, ", ".join(f"{n} double" for n in names)).agg(*[F.covar_pop(names[a], names[b]) for a, b in pairs]).first()
    return max(abs(value - (a == b)) for value, (a, b) in zip(found, pairs))


def whiten(vectors: DataFrame, keep: list[str], vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row for each usable vector and component: the ``keep`` columns, component (from 1), n, deviation, whitened, explained, identity_error.

    Copies of a vector get equal rows.  A table without usable vectors, or whose vectors are all
    equal, has no components and gives no rows; of a rank below ``components`` there are fewer.
    """
    model = fit(vectors, vector, components)
    ends = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.select(*keep).schema.fields)
        return vectors.sparkSession.createDataFrame([], f"{schema}, {ends}")
    shares = F.array(*[F.lit(float(v)) for v in model.explained])
    rows = model.apply(vectors.select(*keep, vector), vector, "_own")
    each = rows.select(*keep, F.col("_own.deviation").alias("deviation"), F.posexplode("_own.whitened").alias("_at", "whitened"))
    return each.select(
        *keep, (F.col("_at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        shares[F.col("_at")].alias("explained"), F.lit(float(model.identity_error)).alias("identity_error"),
    )
