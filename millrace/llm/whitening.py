"""Operator 12: whitening of embeddings by matrix-free block Lanczos.

The covariance V is never formed.  Each pass over the vectors multiplies it with a narrow block, sum of z (z' W) over
the centred vectors z, as one small partial sum a task that Spark adds up; the driver holds a basis of d x (at most
`most`) numbers and the sums, whatever the number of vectors.  The Krylov basis is reorthogonalised in full (twice),
directions that break down are replaced by fresh random ones, a full basis is restarted from its leading Ritz
vectors, and the leading pairs are taken once their residuals are within `tol` of the largest eigenvalue, or the basis spans
the whole space.

Entries are whole numbers x = floor(64 c) + 1000000, so sums S and n x - S are exact, and z = (n x - S) / n is rounded once.

Input cases: rows whose vector is null, or holds null, NaN or infinite entries, are dropped; so are those with an
entry that is no exact whole number when multiplied by 64 and floored (2**53 and above), and vectors shorter than the longest one,
whose last entries are missing.  Components without variance (eigenvalue under d * 2**-50 of the trace) have no direction and
give no rows: fewer vectors than components give fewer components, one vector or equal vectors none.  Null and repeated ids
stay, a row each; other columns are ignored.  An empty table gives an empty table.  `deviation` is decimal(38,0); the query
gives it as long, null beyond the range of long.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import save, tidy

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
BLOCK = 16
TOL = 1e-13
#: Rows of vectors worked on together.
ROWS = 2048


def whole_vectors(df: DataFrame, vector_col: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """id and x (array of long) of the rows that count."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    odd = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) * SCALE >= 2.0**53))
    fine = df.select(F.col(f"`{id_col}`").alias("id"), v.alias("v")).where(v.isNotNull() & ~F.coalesce(odd, F.lit(True)))
    longest = fine.agg(F.max(F.size("v"))).first()[0] or 0
    return fine.where(F.size("v") == longest).select("id", F.transform("v", lambda c: F.floor(c * SCALE) + SHIFT).alias("x"))


def _matrices(batches):
    """(slice, matrix of whole numbers) of a few thousand rows each."""
    for b in batches:
        for lo in range(0, b.num_rows, ROWS):
            s = b.slice(lo, ROWS)
            yield s, s.column(s.schema.get_field_index("x")).flatten().to_numpy(zero_copy_only=False).reshape(s.num_rows, -1)


def _sums(rows: DataFrame, make: Callable, width: int) -> np.ndarray:
    """Sum over all tasks of the matrix (two dimensions, `width` columns) that make(batches) gives: a row a line and task, added up by Spark."""
    import pyarrow as pa

    def run(batches):
        total = make(batches)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(list(total))], names=["i", "v"])

    part = rows.mapInArrow(tidy(run), "i int, v array<double>")
    got = part.groupBy("i").agg(*[F.sum(F.get("v", F.lit(j))).alias(f"s{j}") for j in range(width)]).collect()
    return np.array([r[1:] for r in sorted(got, key=lambda r: r[0])]).reshape(len(got), width)


@dataclass
class Vectors:
    """Saved vectors with what one pass tells: their number, and sum, least and largest entry of each dimension."""

    rows: DataFrame
    n: int
    sums: list[int]
    low: list[int]
    high: list[int]

    @property
    def d(self) -> int:
        return len(self.sums)

    def numerators(self) -> Callable[[np.ndarray], np.ndarray]:
        """x -> n x - S, exactly: as 64-bit numbers where they fit, else as Python's."""
        n, s = self.n, self.sums
        most = max([max(n * abs(a), n * abs(b)) + abs(t) for a, b, t in zip(self.low, self.high, s, strict=True)], default=0)
        if most < 2**62:
            s64 = np.array(s, np.int64)
            return lambda x: x * np.int64(n) - s64
        big = np.array(s, object)
        return lambda x: x.astype(object) * n - big

    def deviations(self) -> Callable[[np.ndarray], list[int] | np.ndarray]:
        """n x - S -> the exact sum of its squares, a row each."""
        most = sum(max(abs(self.n * a - t), abs(self.n * b - t)) ** 2 for a, b, t in zip(self.low, self.high, self.sums, strict=True))
        if most < 2**62:
            return lambda m: (m * m).sum(1)
        return lambda m: (m.astype(object) ** 2).sum(1)


def measure(x: DataFrame) -> Vectors:
    rows = save(x, "vectors")
    import pyarrow as pa

    def run(batches):
        n, found = 0, None
        for _, m in _matrices(batches):
            # in two parts, which can't overflow
            part = np.stack([(m >> 20).sum(0), (m & 0xFFFFF).sum(0)])
            ends = np.stack([m.min(0), m.max(0)])
            n += len(m)
            found = (part, ends) if found is None else (found[0] + part, np.stack([np.minimum(found[1][0], ends[0]), np.maximum(found[1][1], ends[1])]))
        if found is not None and n:
            d = found[0].shape[1]
            cols = [np.arange(d, dtype=np.int32), np.full(d, n), *found[0], *found[1]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["i", "n", "hi", "lo", "low", "high"])

    part = rows.mapInArrow(tidy(run), "i int, n long, hi long, lo long, low long, high long")
    got = sorted(part.groupBy("i").agg(*(F.sum(c).alias(c) for c in ("n", "hi", "lo")), F.min("low").alias("low"), F.max("high").alias("high")).collect(), key=lambda r: r.i)
    return Vectors(rows, got[0].n if got else rows.count(), [(r.hi << 20) + r.lo for r in got], [r.low for r in got], [r.high for r in got])


def product(vectors: Vectors, w: np.ndarray) -> tuple[np.ndarray, float]:
    """(V W, trace of V), in one pass."""
    numerators, n = vectors.numerators(), vectors.n

    def make(batches):
        total = None
        for _, m in _matrices(batches):
            z = (numerators(m) / n).astype(float)
            mine = np.vstack([z.T @ (z @ w), np.full((1, w.shape[1]), (z * z).sum())])
            total = mine if total is None else total + mine
        return total

    got = _sums(vectors.rows, make, w.shape[1]) / n
    return got[:-1], float(got[-1, 0])


def orthonormal(w: np.ndarray, basis: np.ndarray, fresh: Callable[[int], np.ndarray]) -> tuple[np.ndarray, int]:
    """(orthonormal columns that span w without the basis, breakdowns): directions lost in rounding are replaced by fresh ones."""
    room = basis.shape[0] - basis.shape[1]
    want, broken, out = min(w.shape[1], room), 0, basis[:, :0]
    while out.shape[1] < want:
        scale = np.linalg.norm(w)
        held = np.hstack([basis, out])
        for _ in range(2):
            w = w - held @ (held.T @ w)
        u, s, _ = np.linalg.svd(w, full_matrices=False)
        u = u[:, s > max(scale, 1e-300) * 1e-10][:, : want - out.shape[1]]
        u = np.linalg.qr(u - held @ (held.T @ u))[0] if u.shape[1] else u
        out = np.hstack([out, u])
        if out.shape[1] < want:
            broken += want - out.shape[1]
            w = fresh(want - out.shape[1])
    return out, broken


def leading(multiply: Callable[[np.ndarray], np.ndarray], d: int, k: int, block: int = BLOCK, tol: float = TOL, most: int | None = None, seed: int = 12) -> tuple[np.ndarray, np.ndarray, dict]:
    """The k largest eigenvalues, falling, and unit eigenvectors of a symmetric positive matrix known by its products with blocks.

    A subspace that is invariant may lack copies of an eigenvalue or whole eigenvectors: after breakdowns and on convergence a fresh random block is
    multiplied too, and the leading values have to stand.
    """
    rng = np.random.default_rng(seed)
    fresh = lambda m: rng.standard_normal((d, m))
    k = min(k, d)
    most = min(d, max(most or max(8 * k, 256), k + 3 * block))
    basis = image = np.empty((d, 0))
    w, told, stood = fresh(min(block, d)), {"passes": 0, "breakdowns": 0, "restarts": 0}, None
    while True:
        w, broken = orthonormal(w, basis, fresh)
        told["breakdowns"] += broken
        if basis.shape[1] + w.shape[1] > most:
            basis, image = basis @ vectors[:, : k + block], image @ vectors[:, : k + block]
            told["restarts"] += 1
        new = multiply(w)
        told["passes"] += 1
        basis, image = np.hstack([basis, w]), np.hstack([image, new])
        h = basis.T @ image
        values, vectors = np.linalg.eigh((h + h.T) / 2)
        values, vectors = values[::-1], vectors[:, ::-1]
        lead = vectors[:, :k]
        residual = np.linalg.norm(image @ lead - basis @ lead * values[:k], axis=0).max(initial=0)
        done = basis.shape[1] >= k and residual <= tol * max(values[0], 0)
        if basis.shape[1] == d or done and stood is not None and np.allclose(stood, values[:k], rtol=0, atol=tol * values[0]):
            told["residual"] = float(residual)
            return values[:k], basis @ lead, told
        stood = values[:k] if done else None
        w = fresh(block) if done else new


@dataclass
class Whitener:
    vectors: Vectors
    values: np.ndarray
    axes: np.ndarray
    trace: float
    told: dict

    @property
    def weights(self) -> np.ndarray:
        return self.axes / np.sqrt(self.values)


def fit(df: DataFrame, components: int = COMPONENTS, vector_col: str = "embedding", id_col: str = "vec_id", **how) -> Whitener:
    vectors = measure(whole_vectors(df, vector_col, id_col))
    trace = 0.0

    def multiply(w):
        nonlocal trace
        out, trace = product(vectors, w)
        return out

    if not vectors.d or not vectors.n:
        return Whitener(vectors, np.empty(0), np.empty((vectors.d, 0)), 0.0, {})
    values, axes, told = leading(multiply, vectors.d, components, **how)
    real = values > vectors.d * 2.0**-50 * trace
    values, axes = values[real], axes[:, real]
    # one sign for all rows: the largest entry of an axis is positive
    axes = axes * np.sign(axes[np.abs(axes).argmax(0), np.arange(len(values))]) if len(values) else axes
    return Whitener(vectors, values, axes, trace, told)


def identity_error(model: Whitener) -> float:
    """Largest absolute entry of the whitened vectors' covariance less the identity (their mean is exactly that of z: 0)."""
    numerators, n, p = model.vectors.numerators(), model.vectors.n, model.weights

    def make(batches):
        total = None
        for _, m in _matrices(batches):
            y = (numerators(m) / n).astype(float) @ p
            total = y.T @ y if total is None else total + y.T @ y
        return total

    return float(np.abs(_sums(model.vectors.rows, make, p.shape[1]) / n - np.eye(p.shape[1])).max())


def whiten(model: Whitener) -> DataFrame:
    """id, component (from 1), n, deviation, whitened, explained, identity_error: a row for each vector and component."""
    import pyarrow as pa

    v, k = model.vectors, len(model.values)
    of = v.rows.schema["id"].dataType
    schema = T.StructType([T.StructField("id", of), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("deviation", T.DecimalType(38, 0))])
    for c in ("whitened", "explained", "identity_error"):
        schema.add(c, T.DoubleType())
    if not k:
        return v.rows.sparkSession.createDataFrame([], schema)
    numerators, deviations, n, p = v.numerators(), v.deviations(), v.n, model.weights
    share, off = model.values / model.trace, identity_error(model)

    def run(batches):
        for s, m in _matrices(batches):
            top, r = numerators(m), len(m)
            dev = deviations(top)
            dev = pa.array([Decimal(int(x)) for x in dev], pa.decimal128(38)) if dev.dtype == object else pa.array(dev).cast(pa.decimal128(38))
            each = pa.array(np.repeat(np.arange(r), k))
            cols = [
                s.column(s.schema.get_field_index("id")).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), r)), pa.array(np.full(r * k, n)), dev.take(each),
                pa.array(((top / n).astype(float) @ p).ravel()), pa.array(np.tile(share, r)), pa.array(np.full(r * k, off)),
            ]
            yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return v.rows.mapInArrow(tidy(run), schema)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whiten(fit(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")))
    return out.select(F.col("id").alias("vec_id"), "component", "n", F.expr("try_cast(deviation as long)").alias("deviation"), "whitened", "explained", "identity_error")
