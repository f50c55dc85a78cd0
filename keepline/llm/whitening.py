"""Whitening of embeddings: single-precision eigenvectors of a distributed covariance, refined by matrix products."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import table

#: Entries are floored to this fraction; beyond this size they count as not finite.
GRID, LARGEST = 256, 2.0**62
#: Partial sums that one task adds up, rows that are multiplied at once, refinements at most.
FAN_IN, ROWS_AT_ONCE, ROUNDS = 64, 4096, 12
#: Larger centred entries are scaled by a power of two, so that a product fits a long.
BITS = 31
HIGH = np.longdouble


@dataclass
class Whitening:
    """``n`` distinct grid vectors with their exact sums; components are the columns of ``vectors``, largest first."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    largest: int
    identity_error: float | None = None

    @property
    def center(self) -> list[int]:
        """The whole number next to each mean."""
        return [(2 * s + self.n) // (2 * self.n) for s in self.sums]

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates of grid vectors (rows of whole numbers)."""
        rest = np.array([(s - self.n * c) / self.n for s, c in zip(self.sums, self.center)])
        y = (x - np.array(self.center, np.int64)).astype(np.float64) - rest
        return y @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Squared lengths of n x - S, exactly; None beyond a long."""
        bound = len(self.sums) * (self.n * (self.largest + 1)) ** 2
        z = x.astype(np.int64 if bound < 2**63 else object) * self.n - np.array(self.sums, np.int64 if bound < 2**63 else object)
        return [s if s < 2**63 else None for s in map(int, (z * z).sum(axis=1))]


def grid(vector: Column, size: int = GRID) -> Column:
    """Whole numbers floor(size * c) of a vector; null where it is null, empty or has a null, infinite or huge entry."""
    scaled = F.transform(vector, lambda c: c.cast("double") * size)
    fine = F.forall(scaled, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST)) & (F.size(vector) > 0)
    return F.when(F.coalesce(fine, F.lit(False)), F.transform(scaled, lambda c: F.floor(c)))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(-1, d)


def _halves(whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """High and low 32 bits of whole numbers; both add up without overflow."""
    high = whole >> 32
    return high, whole - (high << 32)


def _merged(parts: DataFrame, name: str) -> DataFrame:
    """Sum lists (row, part, high, low) by row: of up to FAN_IN neighbouring parts in a task, until one is left."""
    def add(rows: pa.Table) -> pa.Table:
        high, low = (np.stack(rows[c].to_pylist()).sum(axis=0, dtype=np.int64) for c in ("high", "low"))
        high, low = high + (low >> 32), low & 0xFFFFFFFF
        return pa.table([rows["row"][:1], rows["part"][:1], pa.array([high]), pa.array([low])], names)

    names = ["row", "part", "high", "low"]
    parts = materialize(parts.select(*names), name)
    while (parts.agg(F.max("part")).first()[0] or 0) > 0:
        groups = parts.withColumn("part", F.expr(f"part div {FAN_IN}")).groupBy("row", "part")
        parts = materialize(groups.applyInArrow(add, parts.schema), name)
    return parts


def _sums(fit: DataFrame, d: int) -> tuple[int, list[int], int, int]:
    """(n, exact sum of each dimension, least and greatest entry)."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(0), d)
            if len(x):
                high, low = _halves(x)
                yield pa.record_batch([pa.array(np.full(d, len(x))), pa.array(np.arange(d)), pa.array(high.sum(axis=0)),
                                       pa.array(low.sum(axis=0)), pa.array(x.min(axis=0)), pa.array(x.max(axis=0))],
                                      ["n", "i", "high", "low", "least", "most"])

    rows = fit.select("x").mapInArrow(partial, "n long, i long, high long, low long, least long, most long")
    rows = rows.groupBy("i").agg(*(F.sum(c).alias(c) for c in ("n", "high", "low")), F.min("least").alias("least"),
                                 F.max("most").alias("most")).orderBy("i").collect()
    if not rows:
        return 0, [0] * d, 0, 0
    sums = [(r["high"] << 32) + r["low"] for r in rows]
    return rows[0]["n"], sums, min(r["least"] for r in rows), max(r["most"] for r in rows)


def _products(fit: DataFrame, center: list[int], shift: int) -> np.ndarray:
    """Sums of products of all pairs of centred entries, in units of 4**shift, as exact Python numbers.

    Every task multiplies blocks so short that a block's sums are exact doubles, and adds them up as whole numbers:
    neither order nor partitions change the result.
    """
    d = len(center)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        high, low = np.zeros((d, d), np.int64), np.zeros((d, d), np.int64)
        for batch in batches:
            y = (_matrix(batch.column(0), d) - np.array(center, np.int64)).astype(np.float64) / 2.0**shift
            at = 0
            while at < len(y):
                largest = max(1.0, float(np.abs(y[at:at + ROWS_AT_ONCE]).max()))
                rows = int(max(1, min(ROWS_AT_ONCE, 2**53 // largest**2)))
                block = y[at:at + rows]
                at += rows
                h, lo = _halves(np.rint(block.T @ block).astype(np.int64))
                high, low = high + h, low + lo
        part = np.full(d, TaskContext.get().partitionId())
        yield pa.record_batch([pa.array(np.arange(d)), pa.array(part), pa.array(list(high)), pa.array(list(low))],
                              ["row", "part", "high", "low"])

    parts = fit.select("x").mapInArrow(partial, "row long, part long, high array<long>, low array<long>")
    out = np.zeros((d, d), object)
    for r in _merged(parts, "products").orderBy("row").collect():
        out[r["row"]] += [(h << 32) + lo for h, lo in zip(r["high"], r["low"])]
    return out


def _clusters(values: np.ndarray, width: float) -> list[np.ndarray]:
    """Indices of values that lie in chains of steps of at most ``width``."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > width) + 1
    return [c for c in np.split(order, cuts) if len(c) > 1]


def refine(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and unit eigenvectors of a symmetric matrix from approximate ones, in higher precision.

    Each round takes R = I - X'X and S = X'AX and corrects X by XE: E_ij = (S_ij + l_j R_ij) / (l_j - l_i) where the
    eigenvalues l differ by more than the error bound of the round, else R_ij / 2; errors are squared. Vectors of a cluster
    (not told apart by that bound) are turned within their space by the eigenvectors of the cluster's own small matrix,
    shifted by its mean, so that the following rounds can tell them apart.
    """
    a, x = a.astype(HIGH), x.astype(HIGH)
    norm = float(np.sqrt((a * a).sum()))
    values, before = np.zeros(len(a), HIGH), np.inf
    for _ in range(ROUNDS):
        r = np.eye(len(a), dtype=HIGH) - x.T @ x
        s = x.T @ (a @ x)
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(values)
        width = 2 * (float(np.sqrt((off * off).sum())) + norm * float(np.sqrt((r * r).sum())))
        gaps = values[None, :] - values[:, None]
        near = np.abs(gaps) <= width
        e = np.where(near, r / 2, (s + values[None, :] * r) / np.where(near, 1, gaps))
        x = x + x @ e
        for c in _clusters(values.astype(np.float64), width):
            x[:, c] = _turned(a, x[:, c], values[c].mean())
        change = float(np.abs(e).max())
        if change < 1e-18 or (change < 1e-12 and change >= before):
            break
        before = change
    # Rounding of a division by a small gap may leave neighbours askew; this makes them orthonormal and no more.
    for _ in range(2):
        x = x + x @ (np.eye(len(a), dtype=HIGH) - x.T @ x) / 2
    values = ((a @ x) * x).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    return values[order].astype(np.float64), x[:, order].astype(np.float64)


def _turned(a: np.ndarray, x: np.ndarray, shift: np.longdouble) -> np.ndarray:
    """Vectors of a cluster, orthonormal and along the eigenvectors of their own matrix."""
    lower = np.linalg.cholesky((x.T @ x).astype(np.float64))
    own = (x.T @ (a @ x - shift * x)).astype(np.float64)
    half = np.linalg.solve(lower, own)
    small = np.linalg.solve(lower, half.T)
    _, u = np.linalg.eigh((small + small.T) / 2)
    return x @ np.linalg.solve(lower.T, u).astype(HIGH)


def eigen(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and eigenvectors of a covariance: single precision first, then refined."""
    # A power of two, which rounds nothing.
    scale = 2.0 ** np.frexp(np.abs(v).max(initial=0))[1]
    _, rough = np.linalg.eigh((v / scale).astype(np.float32))
    values, x = refine(v / scale, rough)
    # Either sign is an eigenvector: the largest entry is positive.
    x = x * np.where(x[np.abs(x).argmax(axis=0), np.arange(len(v))] < 0, -1.0, 1.0)
    return values * scale, x


def fit_whitening(rows: DataFrame, x: str = "x", components: int = 4) -> Whitening:
    """Fit on each distinct grid vector (see ``grid``) once.

    Count, sums and centred products are whole numbers summed by the tasks, so the covariance is exact before it is
    rounded once; entries that exceed 31 bits after centring are scaled by a power of two first. Only d sums and d x d
    products reach the driver, d being the length of a vector. Null vectors take no part, nor do those of another
    length than the most frequent one (the smaller of equally frequent ones). Components whose eigenvalue is zero (to
    rounding) are left out, so no or one vector has none. ``identity_error`` is measured in a pass over the fit list.
    """
    fit = materialize(rows.where(F.col(x).isNotNull()).select(F.col(x).alias("x")).distinct(), "fit")
    sizes = fit.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if sizes is None:
        return Whitening(0, [], np.zeros(0), np.zeros((0, 0)), 0.0, 0)
    d = sizes["d"]
    fit = fit.where(F.size("x") == d)
    n, sums, least, most = _sums(fit, d)
    model = Whitening(n, sums, np.zeros(0), np.zeros((d, 0)), 0.0, 0)
    center = model.center
    model.largest = max(max(most - c, c - least) for c in center)
    shift = max(0, model.largest.bit_length() - BITS)
    products = _products(fit, center, shift)
    rest = [s - n * c for s, c in zip(sums, center)]
    unit = 4**shift
    v = np.array([[(n * int(p) * unit - a * b) / n**2 for p, b in zip(row, rest)] for row, a in zip(products, rest)])
    values, vectors = eigen(v)
    model.trace = float(np.trace(v))
    keep = values[:components] > 1e-12 * max(values[0], 0)
    model.values, model.vectors = values[:components][keep], vectors[:, :components][:, keep]
    model.identity_error = _identity_error(fit, model)
    return model


def _identity_error(fit: DataFrame, model: Whitening) -> float | None:
    """Largest entry of the whitened fit list's covariance minus the identity."""
    k, d = len(model.values), len(model.sums)
    if k == 0:
        return None

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = model.project(_matrix(batch.column(0), d))
            total, products = total + w.sum(axis=0), products + w.T @ w
        flat = np.concatenate([total, products.ravel()])
        yield pa.record_batch([pa.array(np.arange(len(flat))), pa.array(flat)], ["i", "v"])

    rows = fit.select("x").mapInArrow(partial, "i long, v double").groupBy("i").agg(F.sum("v").alias("v"))
    flat = np.array([r["v"] for r in rows.orderBy("i").collect()])
    mean, products = flat[:k] / model.n, flat[k:].reshape(k, k) / model.n
    return float(np.abs(products - np.outer(mean, mean) - np.eye(k)).max())


def whiten(rows: DataFrame, model: Whitening, x: str = "x", out: str = "whitened", deviation: str = "deviation") -> DataFrame:
    """Add the whitened coordinates and the exact squared deviation (sum of (n x - S)^2) of grid vectors.

    Both are null for null vectors and for those of another length than the fit's; the deviation also where it exceeds a
    long. Columns of these names are replaced, others pass through; repeated rows are treated alike; an empty table stays
    empty.
    """
    d = len(model.sums)

    @F.arrow_udf("struct<whitened: array<double>, deviation: bigint>")
    def project(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            good = np.asarray(batch.value_lengths().fill_null(-1)) == d if d else np.zeros(len(batch), bool)
            held = _matrix(batch.filter(pa.array(good)), d) if good.any() else np.zeros((0, d), np.int64)
            at = pa.array(np.where(good, np.cumsum(good) - 1, 0), pa.int64(), mask=~good)
            w = pa.array(list(model.project(held)) if len(held) else [], pa.list_(pa.float64())).take(at)
            dev = pa.array(model.deviations(held) if len(held) else [], pa.int64()).take(at)
            yield pa.StructArray.from_arrays([w, dev], ["whitened", "deviation"])

    both = rows.withColumn("both_", project(F.col(x)))
    return both.withColumns({out: F.col("both_.whitened"), deviation: F.col("both_.deviation")}).drop("both_")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", grid(F.col("embedding")).alias("x"))
    vectors = vectors.where("x is not null")
    model = fit_whitening(vectors)
    shares = F.array(*(F.lit(float(e / model.trace)) for e in model.values)).cast("array<double>")
    # The outer form, as the other one would filter by the function's result and so run it twice.
    rows = whiten(vectors, model).select("vec_id", "deviation", F.posexplode_outer("whitened").alias("i", "whitened"))
    return rows.where("i is not null").select(
        "vec_id", (F.col("i") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("i")).alias("explained"), F.lit(model.identity_error).cast("double").alias("identity_error"))
