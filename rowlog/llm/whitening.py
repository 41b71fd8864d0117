"""Embedding whitening by polarisation covariance.

Entries become integers, x = floor(64 c) + 1000000, so that everything up to
the covariance is exact:

1. n and the sums S of every dimension (whole numbers);
2. centred values, z = n x - S (whole numbers). Their squares are summed for
   every dimension and for the sum of every pair of dimensions; no product of
   two dimensions is taken. cov(j, k) = (Q(j + k) - Q(j) - Q(k)) / 2, by the
   polarisation identity, over n^3. Sums are exact at every size: squares are
   added in limbs of 24 bits, or as Python integers where z leaves 63 bits;
3. the covariance, a matrix of the dimension and no more, goes through eigh on
   the driver, and rows are projected where they lie.

A partition gives one row of sums for each pair, so what is shuffled and what
reaches the driver depends on the dimension alone. No row is moved.

Edge cases: vectors that are null, or hold null or non-finite entries, take no
part. Neither do empty ones, those whose length isn't the commonest one (of equally common
lengths the larger counts), nor those with an entry that 64 bits can't hold as
x. Components whose eigenvalue is zero up to rounding can't be whitened and
are left out, so equal vectors, or a single one, give no rows; an empty table
gives none. Repeated rows and ids count each and give rows each; a null id
stays null. `deviation` is null where it leaves 64 bits. Other columns aren't read.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowlog.llm.common import exact, prepare

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
LIMB = 24
_LARGEST = float(1 << 62)
_ROWS = 1024  # rows of a block: limb products, 2^48 at most, are added in 64 bits


@dataclass(frozen=True)
class Whitening:
    """What a fit has learned: enough to whiten any vector."""

    n: int
    sums: tuple[int, ...]
    covariance: np.ndarray
    eigenvalues: np.ndarray  # of the components kept, falling
    axes: np.ndarray  # a unit eigenvector in each column
    identity_error: float = 0.0

    @property
    def explained(self) -> np.ndarray:
        return self.eigenvalues / np.trace(self.covariance)


# ---- whole numbers ---------------------------------------------------------------
def whole(vectors: np.ndarray) -> np.ndarray:
    """x of a matrix of entries."""
    return np.floor(vectors.astype(np.float64) * SCALE).astype(np.int64) + SHIFT


def centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """n x - S: 64-bit integers if they and their pair sums fit, else Python's."""
    most = max((abs(int(v)) for v in (x.max(initial=0), x.min(initial=0))), default=0)
    if 4 * (n * most + max(map(abs, sums), default=0)) < 1 << 63:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def square_sums(z: np.ndarray) -> list[int]:
    """The exact sum of squares of each column."""
    if z.dtype == object:
        return [int(v) for v in (z * z).sum(axis=0)] if len(z) else [0] * z.shape[1]
    size = np.abs(z)
    limbs = [size & ((1 << LIMB) - 1)]
    while (size := size >> LIMB).any():
        limbs.append(size & ((1 << LIMB) - 1))
    total = [0] * z.shape[1]
    for i, a in enumerate(limbs):
        for j, b in enumerate(limbs[:i + 1]):
            part = (a * b).sum(axis=0).tolist()
            times = (2 if i != j else 1) << LIMB * (i + j)
            total = [t + p * times for t, p in zip(total, part, strict=True)]
    return total


def pair_squares(z: np.ndarray) -> list[list[int]]:
    """For each dimension j: the sums of squares of z_j, and of z_j + z_k for all k > j."""
    out = [[0] * (z.shape[1] - j) for j in range(z.shape[1])]
    for at in range(0, len(z), _ROWS):
        block = z[at:at + _ROWS]
        for j in range(z.shape[1]):
            pairs = block[:, j:].copy()
            pairs[:, 1:] += block[:, j:j + 1]
            out[j] = [a + b for a, b in zip(out[j], square_sums(pairs), strict=True)]
    return out


def covariance(n: int, squares: list[list[int]]) -> np.ndarray:
    """Correctly rounded from the exact sums of squares."""
    d = len(squares)
    cov = np.empty((d, d))
    for j in range(d):
        cov[j, j] = squares[j][0] / n ** 3
        for k in range(j + 1, d):
            cov[j, k] = cov[k, j] = (squares[j][k - j] - squares[j][0] - squares[k][0]) / (2 * n ** 3)
    return cov


def _row_squares(z: np.ndarray) -> list[int]:
    """The exact sum of squares of each row."""
    if z.dtype != object and int(np.abs(z).max(initial=0)) ** 2 * z.shape[1] < 1 << 63:
        return (z * z).sum(axis=1).tolist()
    return [sum(c * c for c in r) for r in z.tolist()]


# ---- passes over the vectors -------------------------------------------------------
def usable(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """vec_id, vec (doubles) of the rows that take part."""
    rows = exact(table, id_col, vec_col).select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec")).where("vec is not null")
    # A comparison with NaN or an infinity fails; one with null is null.
    rows = rows.where(F.forall("vec", lambda c: F.coalesce((F.abs(c) * SCALE < _LARGEST) & ~F.isnan(c), F.lit(False))))
    rows = rows.where(F.size("vec") > 0)
    common = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("vec") == (common["d"] if common else 0))


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for b in batches:
        if b.num_rows:
            yield b.column(0), b.column(1).flatten().to_numpy().reshape(b.num_rows, -1)


def _sums(rows: DataFrame) -> tuple[int, tuple[int, ...]]:
    """n, and the sum of every dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for _, v in _matrices(batches):
            part = whole(v).astype(object).sum(axis=0) if np.abs(v).max(initial=0) > 1 << 30 else whole(v).sum(axis=0).astype(object)
            n, total = n + len(v), part if total is None else total + part
        if n:
            at = [-1, *range(len(total))]
            yield pa.RecordBatch.from_pydict({"j": pa.array(at, pa.int32()), "v": pa.array([str(int(t)) for t in (n, *total)])})

    got = rows.select("vec_id", "vec").mapInArrow(add, "j int, v string").groupBy("j").agg(
        F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()  # one row a dimension
    by = {r["j"]: int(r["v"]) for r in got}
    return by.pop(-1, 0), tuple(by[j] for j in range(len(by)))


def _pair_sums(rows: DataFrame, n: int, sums: tuple[int, ...]) -> list[list[int]]:
    """Q: the exact squares of every dimension and pair sum, over all rows."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, v in _matrices(batches):
            part = pair_squares(centred(whole(v), n, sums))
            total = part if total is None else [[a + b for a, b in zip(x, y, strict=True)] for x, y in zip(total, part, strict=True)]
        for j, row in enumerate(total or []):
            # Whole numbers of any size, in digits of base 2^40.
            k, at, digit = [], [], []
            for i, q in enumerate(row):
                place = 0
                while q or not place:
                    k.append(j + i)
                    at.append(place)
                    digit.append(q & ((1 << 40) - 1))
                    q, place = q >> 40, place + 1
            yield pa.RecordBatch.from_pydict({
                "j": pa.array([j] * len(k), pa.int32()), "k": pa.array(k, pa.int32()),
                "place": pa.array(at, pa.int32()), "digit": pa.array(digit, pa.int64())})

    out = [[0] * (len(sums) - j) for j in range(len(sums))]
    got = rows.select("vec_id", "vec").mapInArrow(add, "j int, k int, place int, digit long").groupBy("j", "k", "place").agg(
        F.sum("digit").alias("digit"))
    for r in got.collect():  # some rows for each pair of dimensions
        out[r["j"]][r["k"] - r["j"]] += r["digit"] << 40 * r["place"]
    return out


def _projected(v: np.ndarray, fit: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """Centred whole numbers, and the whitened values."""
    z = centred(whole(v), fit.n, fit.sums)
    return z, (z / fit.n).astype(np.float64) @ fit.axes / np.sqrt(fit.eigenvalues)


def _identity_error(rows: DataFrame, fit: Whitening) -> float:
    """The largest absolute entry of the whitened values' covariance minus the identity, measured on all rows."""
    size = len(fit.eigenvalues)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(size), np.zeros((size, size))
        for _, v in _matrices(batches):
            _, w = _projected(v, fit)
            first += w.sum(axis=0)
            second += w.T @ w
        at = np.arange(size)
        yield pa.RecordBatch.from_pydict({
            "j": pa.array(np.concatenate([at, np.repeat(at, size)]).astype(np.int32)),
            "k": pa.array(np.concatenate([np.full(size, -1), np.tile(at, size)]).astype(np.int32)),
            "v": pa.array(np.concatenate([first, second.ravel()]))})

    got = rows.select("vec_id", "vec").mapInArrow(add, "j int, k int, v double").groupBy("j", "k").agg(F.sum("v").alias("v")).collect()
    mean, product = np.zeros(size), np.zeros((size, size))
    for r in got:  # one row for each pair of components
        if r["k"] < 0:
            mean[r["j"]] = r["v"] / fit.n
        else:
            product[r["j"], r["k"]] = r["v"] / fit.n
    return float(np.abs(product - np.outer(mean, mean) - np.eye(size)).max(initial=0))


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Fit on all rows of `usable`."""
    n, sums = _sums(rows)
    cov = covariance(n, _pair_sums(rows, n, sums)) if n else np.zeros((0, 0))
    value, axis = np.linalg.eigh(cov) if len(cov) else (np.empty(0), np.empty((0, 0)))
    order = np.argsort(-value, kind="stable")[:components]
    order = order[value[order] > len(cov) * np.finfo(float).eps * max(value.max(initial=0), 0)]
    axes = axis[:, order]
    turn = np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(len(order))]) if len(order) else np.empty(0)
    found = Whitening(n, sums, cov, value[order], axes * turn)
    if not len(order):
        return found
    return Whitening(n, sums, cov, value[order], axes * turn, _identity_error(rows, found))


def whiten(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> tuple[DataFrame, Whitening]:
    """vec_id, deviation, whitened (an array, a value for each component), and the fit."""
    prepare(table.sparkSession)
    rows = usable(table, id_col, vec_col)
    found = fit(rows, components)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, v in _matrices(batches):
            for at in range(0, len(v), _ROWS):
                z, w = _projected(v[at:at + _ROWS], found)
                deviation = _row_squares(z)
                ends = pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(at, len(w)),
                        pa.array([x if x < 1 << 63 else None for x in deviation], pa.int64()),
                        pa.ListArray.from_arrays(ends, pa.array(w.ravel())),
                    ],
                    names=["vec_id", "deviation", "whitened"])

    kind = dict(rows.dtypes)["vec_id"]
    return rows.mapInArrow(project, f"vec_id {kind}, deviation long, whitened array<double>"), found


def digest(whitened: DataFrame, fit: Whitening) -> DataFrame:
    """One row for each vector and component."""
    share = F.array(*(F.lit(float(x)) for x in fit.explained)) if len(fit.eigenvalues) else F.array().cast("array<double>")
    at = F.col("component")
    return whitened.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(fit.n).cast("long").alias("n"), "deviation", "whitened",
    ).withColumns({"explained": F.element_at(share, at), "identity_error": F.lit(fit.identity_error)})
