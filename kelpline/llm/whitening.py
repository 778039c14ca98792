"""Whitening of embeddings by QDWH spectral divide-and-conquer.

1. Components of a vector become whole numbers ``floor(64 * c) + 1000000``. A pass over all rows adds them up exactly.
2. A second pass subtracts the nearest whole number to the mean and adds up the products. Numbers are cut into limbs of
   ``LIMB`` bits, whose products a matrix product in double precision adds without rounding, so the covariance over all rows is exact until
   it is divided, and does not depend on the order of tasks. Tasks send sums of the size of the matrix, and Spark adds them.
3. The matrix, whose size is the length of a vector squared and not that of the table, is split on the driver: the polar factor of the shifted
   matrix is its matrix sign, found by dynamically weighted Halley iterations (by QR while it is far from
   orthogonal, by Cholesky after); half of sign plus identity is the spectral projector on the eigenvalues above the
   shift. Bases of its range and of its complement cut the matrix into two, which are split again down to single components.
4. Mean and scaled components are broadcast, and every row is projected on them. One more pass measures the covariance of
   the projected rows.

Defined results: vectors that are null or empty, hold null or non-finite entries, or have another length than most take no part; rows that
repeat an id, and rows without one, each count and get their rows; ``64 * c`` beyond 2**52 counts as that; a
deviation beyond a long is null; components whose eigenvalue is zero but for rounding are left out, so equal vectors and an
empty table give no rows; equal eigenvalues keep the order of the split; other columns are ignored whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpline.session import ship_package

COMPONENTS = 32
SCALE, OFFSET = 64.0, 1_000_000
LARGEST = 2.0**52
LIMB = 20
#: Rows whose products of limbs are added before the sum leaves double precision: 2**38 * 2**14 < 2**53.
EXACT_ROWS = 1 << 14
#: Numbers handled at once in a task.
ITEMS = 1 << 20
EPS = np.finfo(np.float64).eps


def valid_rows(vectors: pa.Array, length: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, whether a row takes part, and the numbers of those that do, one after another."""
    lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    numbers = pc.fill_null(vectors.flatten().cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(numbers))])
    ends = np.cumsum(lengths)
    fine = (lengths > 0) & (bad[ends] == bad[ends - lengths])
    if length is not None:
        fine &= lengths == length
    return lengths, fine, numbers[np.repeat(fine, lengths)]


def whole_numbers(numbers: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.clip(np.floor(SCALE * numbers), -LARGEST, LARGEST).astype(np.int64) + OFFSET


def _matrices(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and whole-number vectors of the rows that take part, a bounded number at a time."""
    step = max(1, ITEMS // length)
    for whole in batches:
        for low in range(0, len(whole), step):
            batch = whole.slice(low, step)
            _, fine, numbers = valid_rows(batch["vec"], length)
            if fine.any():
                yield batch["vec_id"].filter(pa.array(fine)), whole_numbers(numbers).reshape(-1, length)


def _lengths(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lengths, fine, _ = valid_rows(batch["vec"])
        d, n = np.unique(lengths[fine], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(n, pa.int64())], names=["d", "n"])


def _adder(length: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(length, np.int64), np.zeros(length, np.int64)
        for _, x in _matrices(batches, length):
            n += len(x)
            high += (x >> 26).sum(axis=0)
            low += (x & ((1 << 26) - 1)).sum(axis=0)
        if n:
            arrays = [pa.array(np.arange(length, dtype=np.int64)), pa.array(np.full(length, n, np.int64)), pa.array(high), pa.array(low)]
            yield pa.RecordBatch.from_arrays(arrays, names=["i", "n", "high", "low"])

    return add


def limbs(y: np.ndarray) -> list[np.ndarray]:
    """``y`` as signed limbs, the least first: ``sum(limb[k] << (LIMB * k))``."""
    out, half = [], 1 << (LIMB - 1)
    while True:
        low = ((y + half) & ((1 << LIMB) - 1)) - half
        out.append(low.astype(np.float64))
        y = (y - low) >> LIMB
        if not y.any():
            return out


def products(y: np.ndarray, total: dict[int, np.ndarray]) -> None:
    """Add the exact sum of ``y[r, i] * y[r, j]`` to ``total``, by the weight of the limbs."""
    for begin in range(0, len(y), EXACT_ROWS):
        parts = limbs(y[begin : begin + EXACT_ROWS])
        for k, left in enumerate(parts):
            for m, right in enumerate(parts):
                found = (left.T @ right).astype(np.int64)
                total[k + m] = total[k + m] + found if k + m in total else found


def _multiplier(centre: np.ndarray) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def multiply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for _, x in _matrices(batches, len(centre)):
            products(x - centre, total)
        d = len(centre)
        for weight, matrix in total.items():
            for i in range(d):
                arrays = [pa.array(np.full(d, v, np.int64)) for v in (weight, i)]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(np.arange(d, dtype=np.int64)), pa.array(matrix[i])], names=["w", "i", "j", "v"])

    return multiply


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal factor of the polar decomposition of a symmetric matrix, by QDWH: its matrix sign."""
    n = len(a)
    norm = min(np.linalg.norm(a), np.abs(a).sum(axis=1).max())
    x, eye = a / norm, np.eye(n)
    # a bound from below of the least singular value; a cautious one costs a step or two
    low = max(min(np.abs(np.diag(np.linalg.qr(x, mode="r"))).min() / (4 * n), 0.5), EPS / 8)
    for _ in range(40):
        square = low * low
        gamma = np.cbrt(4 * (1 - square) / (square * square))
        root = np.sqrt(1 + gamma)
        p = root + 0.5 * np.sqrt(max(8 - 4 * gamma + 8 * (2 - square) / (square * root), 0.0))
        q = (p - 1) ** 2 / 4
        r = p + q - 1
        if r > 100:
            both, _ = np.linalg.qr(np.vstack([np.sqrt(r) * x, eye]))
            step = (q / r) * x + (p - q / r) / np.sqrt(r) * both[:n] @ both[n:].T
        else:
            factor = np.linalg.cholesky(eye + r * x.T @ x)
            step = (q / r) * x + (p - q / r) * np.linalg.solve(factor.T, np.linalg.solve(factor, x.T)).T
        step = (step + step.T) / 2
        moved, x = np.linalg.norm(step - x), step
        low = min(low * (p + q * square) / (1 + r * square), 1.0)
        if moved <= np.cbrt(4 * EPS) and 1 - low < 10 * EPS:
            break
    return x


def _bases(projector: np.ndarray, rank: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of the range of a projector and of its complement."""
    n = len(projector)
    upper = np.linalg.qr(projector @ rng.standard_normal((n, rank)))[0]
    upper = np.linalg.qr(projector @ upper)[0]
    rest = rng.standard_normal((n, n - rank))
    for _ in range(2):
        rest = rest - projector @ rest
        rest = np.linalg.qr(rest - upper @ (upper.T @ rest))[0]
    return upper, rest


def _split(a: np.ndarray, size: float, rng: np.random.Generator) -> np.ndarray:
    """Columns that make ``a`` diagonal. ``size`` is the norm of the whole matrix."""
    n = len(a)
    middle = np.trace(a) / n
    if n == 1 or np.linalg.norm(a - middle * np.eye(n)) <= 2 * n * EPS * size:
        return np.eye(n)
    spread = np.diag(a).max() - np.diag(a).min() + np.linalg.norm(a - np.diag(np.diag(a)))
    # the mean of the eigenvalues always has some on both sides; the others are near it
    shifts = [float(np.median(np.diag(a))), middle, *(middle + spread * s for s in (0.01, -0.01, 0.03, -0.03, 0.1, -0.1))]
    best = None
    for shift in shifts:
        projector = (polar_factor(a - shift * np.eye(n)) + np.eye(n)) / 2
        rank = round(float(np.trace(projector)))
        if not 0 < rank < n:
            continue
        upper, rest = _bases(projector, rank, rng)
        left = np.linalg.norm(rest.T @ a @ upper)
        if best is None or left < best[0]:
            best = (left, upper, rest)
        if left <= 8 * n * EPS * size:
            break
    if best is None:
        return np.eye(n)
    out = []
    for basis in best[1:]:
        part = basis.T @ a @ basis
        out.append(basis @ _split((part + part.T) / 2, size, rng))
    return np.hstack(out)


def _refined(a: np.ndarray, q: np.ndarray) -> np.ndarray:
    """One step that squares the errors of approximate eigenvectors."""
    loss = np.eye(len(a)) - q.T @ q
    inner = q.T @ a @ q
    value = np.diag(inner) / (1 - np.diag(loss))
    gap = value[None, :] - value[:, None]
    off = inner - np.diag(np.diag(inner))
    near = np.abs(gap) <= 2 * (np.linalg.norm(off) + np.linalg.norm(a) * (np.linalg.norm(loss) + len(a) * EPS))
    change = np.where(near, loss / 2, (inner + value[None, :] * loss) / np.where(near, 1, gap))
    return q + q @ change


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns, the largest entry of each positive."""
    scale = np.abs(a).max()
    if not scale:
        return np.zeros(len(a)), np.eye(len(a))
    a = a / scale
    q = _split(a, float(np.linalg.norm(a)), np.random.Generator(np.random.PCG64(13)))
    for _ in range(2):
        q = _refined(a, q)
    q = q @ (3 * np.eye(len(a)) - q.T @ q) / 2
    values = np.einsum("ij,ik,kj->j", q, a, q, optimize=True)
    order = np.argsort(-values, kind="stable")
    q = q[:, order] / np.linalg.norm(q[:, order], axis=0)
    top = q[np.abs(q).argmax(axis=0), np.arange(len(a))]
    return values[order] * scale, q * np.where(top < 0, -1.0, 1.0)


@dataclass(frozen=True)
class Whitener:
    """What is broadcast: rows counted, sums as multiples of ``n`` at ``centre`` and what is left over, and scaled components as columns."""

    n: int
    centre: np.ndarray
    left: list[int]
    scaled: np.ndarray
    explained: np.ndarray

    def project(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.centre) - np.array([v / self.n for v in self.left])) @ self.scaled

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Per row the sum of ``(n * x - S) ** 2``, exact; none if a long cannot hold it."""
        y = x - self.centre
        top = int(np.abs(y).max()) + 1
        if len(self.centre) * (self.n * top + max(map(abs, self.left))) ** 2 < 2**63:
            exact = self.n * y - np.array(self.left, np.int64)
            return (exact * exact).sum(axis=1).tolist()
        if len(self.centre) * top * max(top, *map(abs, self.left)) < 2**63:
            squares, mixed = (y * y).sum(axis=1), (y * np.array(self.left, np.int64)).sum(axis=1)
        else:
            wide = y.astype(object)
            squares, mixed = (wide * wide).sum(axis=1), (wide * np.array(self.left, object)).sum(axis=1)
        rest = sum(v * v for v in self.left)
        found = [self.n * self.n * int(a) - 2 * self.n * int(b) + rest for a, b in zip(squares, mixed)]
        return [v if v < 2**63 else None for v in found]


def covariance(n: int, left: list[int], sums: dict[tuple[int, int], int]) -> np.ndarray:
    """From exact sums around the centre; rounded once."""
    d = len(left)
    return np.array([[(n * sums[i, j] - left[i] * left[j]) / (n * n) for j in range(d)] for i in range(d)])


def _vectors(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    return rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vec"))


def fit(rows: DataFrame, most: int = COMPONENTS, vector: str = "embedding") -> Whitener | None:
    """Mean and components of all vectors; none if nothing varies."""
    ship_package(rows.sparkSession)
    vectors = _vectors(rows.withColumn("_none", F.lit(None)), "_none", vector)
    lengths = vectors.mapInArrow(_lengths, "d long, n long").groupBy("d").agg(F.sum("n").alias("n"))
    usual = lengths.orderBy(F.desc("n"), "d").first()
    if usual is None:
        return None
    d = usual.d
    adding = vectors.mapInArrow(_adder(d), "i long, n long, high long, low long")
    added = adding.groupBy("i").agg(F.sum("n").alias("n"), *(F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")))
    # as many rows as a vector has entries
    by_entry = {r.i: r for r in added.collect()}
    n = by_entry[0].n
    sums = [(int(by_entry[i].high) << 26) + int(by_entry[i].low) for i in range(d)]
    centre = [(2 * s + n) // (2 * n) for s in sums]
    left = [s - n * c for s, c in zip(sums, centre)]
    multiplied = vectors.mapInArrow(_multiplier(np.array(centre, np.int64)), "w long, i long, j long, v long")
    entries = multiplied.groupBy("w", "i", "j").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).toArrow()
    found: dict[tuple[int, int], int] = {}
    for w, i, j, v in zip(*(entries[c].to_pylist() for c in ("w", "i", "j", "v"))):
        found[i, j] = found.get((i, j), 0) + (int(v) << (LIMB * w))
    matrix = covariance(n, left, found)
    values, columns = eigen(matrix)
    use = values[:most] > max(d, 4) * EPS * values[0]
    if not use.any():
        return None
    values, columns = values[:most][use], columns[:, :most][:, use]
    return Whitener(n, np.array(centre, np.int64), left, columns / np.sqrt(values), values / np.trace(matrix))


def _measured(shipped) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shipped.value
        k = fitted.scaled.shape[1]
        total, matrix = np.zeros(k), np.zeros((k, k))
        for _, x in _matrices(batches, len(fitted.centre)):
            white = fitted.project(x)
            total += white.sum(axis=0)
            matrix += white.T @ white
        for i in range(k):
            arrays = [pa.array(np.full(k, i, np.int64)), pa.array(np.arange(k, dtype=np.int64)), pa.array(np.full(k, total[i])), pa.array(matrix[i])]
            yield pa.RecordBatch.from_arrays(arrays, names=["i", "j", "s", "v"])

    return measure


def identity_error(rows: DataFrame, fitted: Whitener, vector: str = "embedding") -> float:
    """The largest entry, in size, of the whitened rows' covariance minus the identity."""
    shipped = rows.sparkSession.sparkContext.broadcast(fitted)
    measure = _measured(shipped)
    vectors = _vectors(rows.withColumn("_none", F.lit(None)), "_none", vector)
    sums = vectors.mapInArrow(measure, "i long, j long, s double, v double").groupBy("i", "j").agg(F.sum("s").alias("s"), F.sum("v").alias("v"))
    k = fitted.scaled.shape[1]
    mean, matrix = np.zeros(k), np.zeros((k, k))
    for r in sums.collect():
        mean[r.i], matrix[r.i, r.j] = r.s / fitted.n, r.v / fitted.n
    return float(np.abs(matrix - np.outer(mean, mean) - np.eye(k)).max())


WHITE = "vec_id long, component int, n long, deviation long, whitened double, explained double"


def _writer(shipped) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shipped.value
        k = fitted.scaled.shape[1]
        for ids, x in _matrices(batches, len(fitted.centre)):
            rows = np.repeat(np.arange(len(x)), k)
            arrays = [
                ids.take(pa.array(rows)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(rows), fitted.n, np.int64)),
                pa.array(fitted.deviations(x), pa.int64()).take(pa.array(rows)),
                pa.array(fitted.project(x).reshape(-1)),
                pa.array(np.tile(fitted.explained, len(x))),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "component", "n", "deviation", "whitened", "explained"])

    return write


def apply(rows: DataFrame, fitted: Whitener, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained`` of every row that takes part; one pass, nothing shuffled."""
    shipped = rows.sparkSession.sparkContext.broadcast(fitted)
    return _vectors(rows, vec_id, vector).mapInArrow(_writer(shipped), WHITE)


def whiten(rows: DataFrame, most: int = COMPONENTS, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Every row on the ``most`` first components, with the error of the whole measured over all rows."""
    fitted = fit(rows, most, vector)
    if fitted is None:
        return rows.sparkSession.createDataFrame([], f"{WHITE}, identity_error double")
    return apply(rows, fitted, vec_id, vector).withColumn("identity_error", F.lit(identity_error(rows, fitted, vector)))
