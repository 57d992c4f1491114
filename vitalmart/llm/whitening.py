"""Whitening of embeddings with covariances recovered from squares only.

The covariance of two dimensions is half of Var(a + b) - Var(a) - Var(b). So the only thing
summed over the rows is squares of centred values, one for each dimension and one for the sum
of each two dimensions, in integers and therefore exactly whatever the order of summation. Their
differences give the covariance matrix without cancellation; its size is the square of the
number of dimensions, not of the rows, so the eigenvectors are computed once on the driver.

Entries are fixed-point numbers x = floor(64 c) + 1000000. Statistics are over the distinct
x vectors, so copies of a vector weigh once.

Edge cases: rows whose vector is NULL or holds NULL, NaN, an infinity or an entry too large for
x to be a 64-bit integer are dropped, and so are vectors of another length than most rows have
(ties: the longer one); empty vectors have no dimension to whiten and are dropped too. Repeated rows and
NULL ids each give their rows. A component along which the vectors do not vary cannot be scaled to
variance one: its ``whitened`` is NULL and it takes no part in ``identity_error``, which is NULL if no
component varies. An empty table, or one without usable rows, gives an empty result. Columns other than
id and vector are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
ROWS = 1024  # vectors a task works on at a time; sums of so many limb products fit 64 bits
_LIMB = 24


def _vectors(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Usable rows with their x - SHIFT = floor(64 c)."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            scaled = part.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims) * float(SCALE)
            with np.errstate(invalid="ignore"):
                good = (np.abs(scaled) < 2.0 ** 62).all(axis=1)  # false for NaN, which NULL reads as
            if good.any():
                yield part.filter(pa.array(good)), np.floor(scaled[good]).astype(np.int64)


def _packed(d: np.ndarray) -> list[bytes]:
    """One byte string per vector, of the narrowest integers that hold it: equal vectors, and only
    they, have equal strings."""
    low, high = d.min(axis=1), d.max(axis=1)
    fits = [(low >= -(2 ** (8 * w - 1))) & (high < 2 ** (8 * w - 1)) for w in (1, 2, 4)]
    width = np.select(fits, (1, 2, 4), 8)
    out: list[bytes] = [b""] * len(d)
    for w in (1, 2, 4, 8):
        rows = np.flatnonzero(width == w)
        for r, vector in zip(rows.tolist(), d[rows].astype(f"<i{w}")):
            out[r] = vector.tobytes()
    return out


def _unpacked(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            keys = batch.column("key").slice(at, ROWS).to_pylist()
            d = np.empty((len(keys), dims), np.int64)
            for row, key in zip(d, keys):
                row[:] = np.frombuffer(key, f"<i{len(key) // dims}")
            yield d


def _centred(d: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S per entry, exactly; Python integers where 64 bits do not hold it."""
    most = int(max(abs(int(d.min(initial=0))), abs(int(d.max(initial=0)))))
    if 2 * n * most + 2 * max(map(abs, sums)) < 2 ** 62:
        return n * d - np.array(sums, np.int64)
    return n * d.astype(object) - np.array(sums, object)


def _squares(t: np.ndarray) -> list[int]:
    """Exact sum of squares of each column, of at most ROWS rows."""
    if t.dtype == object:
        return [int(v) for v in (t * t).sum(axis=0)]
    most = int(max(abs(int(t.min(initial=0))), abs(int(t.max(initial=0)))))
    if most * most * len(t) < 2 ** 63:
        return (t * t).sum(axis=0).tolist()
    if most >= 2 ** (26 + _LIMB):
        return _squares(t.astype(object))
    high, low = t >> _LIMB, t & ((1 << _LIMB) - 1)
    parts = ((a * b).sum(axis=0).tolist() for a, b in ((high, high), (high, low), (low, low)))
    return [(hh << 2 * _LIMB) + (hl << _LIMB + 1) + ll for hh, hl, ll in zip(*parts)]


def _squares_of_rows(t: np.ndarray) -> list[int]:
    most = int(np.abs(t).max(initial=0))
    wide = t if most * most * t.shape[1] < 2 ** 63 else t.astype(object)
    return [int(v) for v in (wide * wide).sum(axis=1)]


def distinct_vectors(rows: DataFrame, dims: int) -> DataFrame:
    """The fit list: each x vector once, as packed ``key``. Copies meet before the shuffle."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, d in _vectors(batches, dims):
            yield pa.RecordBatch.from_arrays([pa.array(_packed(d), pa.binary())], names=["key"])

    return rows.select("vector").mapInArrow(pack, "key binary").distinct()


def _totals(fit: DataFrame, add, kind: str) -> dict[tuple[int, int], int | float]:
    """What ``add`` puts into a dictionary by pairs of dimensions, over every block of a task, summed over the tasks."""
    arrow = pa.decimal128(38, 0) if kind == "decimal(38,0)" else pa.float64()

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], int | float] = {}
        for batch in batches:
            add(iter([batch]), sums)
        if sums:
            i, j = zip(*sums)
            cells = list(sums.values()) if arrow == pa.float64() else [Decimal(v) for v in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(cells, arrow)], names=["i", "j", "v"])

    total = fit.mapInArrow(partial, f"i int, j int, v {kind}").groupBy("i", "j").agg(F.sum("v").alias("v"))
    return {(r.i, r.j): r.v if arrow == pa.float64() else int(r.v) for r in total.collect()}


def moments(fit: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Number of vectors of the fit list and the sum of x - SHIFT per dimension."""
    def add(batches, sums):
        for d in _unpacked(batches, dims):
            sums[-1, -1] = sums.get((-1, -1), 0) + len(d)
            wide = d if np.abs(d).max(initial=0) < 2 ** 52 else d.astype(object)
            for i, v in enumerate(wide.sum(axis=0).tolist()):
                sums[i, i] = sums.get((i, i), 0) + int(v)

    totals = _totals(fit, add, "decimal(38,0)")
    return totals.get((-1, -1), 0), [totals.get((i, i), 0) for i in range(dims)]


def covariance(fit: DataFrame, dims: int, n: int, sums: list[int]) -> np.ndarray:
    """Covariance matrix (divisor n) from exact squares of centred values alone.

    With t = n x - S, the squares summed are those of t_i for each dimension and of t_i + t_j
    for each pair: (Q_ij - Q_i - Q_j) / 2 is the sum of t_i t_j. One division per entry rounds.
    """
    def add(batches, totals):
        for d in _unpacked(batches, dims):
            t = _centred(d, n, sums)
            for i, v in enumerate(_squares(t)):
                totals[i, i] = totals.get((i, i), 0) + v
            for i in range(dims - 1):
                for j, v in enumerate(_squares(t[:, i:i + 1] + t[:, i + 1:]), i + 1):
                    totals[i, j] = totals.get((i, j), 0) + v

    q = _totals(fit, add, "decimal(38,0)")
    out = np.empty((dims, dims))
    for i in range(dims):
        out[i, i] = q[i, i] / n ** 3
        for j in range(i + 1, dims):
            out[i, j] = out[j, i] = (q[i, j] - q[i, i] - q[j, j]) / (2 * n ** 3)
    return out


def principal(cov: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns; the largest entry of each is positive."""
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(values, kind="stable")[::-1][:most]
    values, vectors = values[order], vectors[:, order]
    return values, vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))] < 0, -1.0, 1.0)


def _projected(t: np.ndarray, n: int, directions: np.ndarray) -> np.ndarray:
    """(x - S / n) along the directions, already divided by the square roots of the eigenvalues."""
    return (t / n).astype(np.float64) @ directions


def identity_error(fit: DataFrame, dims: int, n: int, sums: list[int], directions: np.ndarray) -> float | None:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, measured over the fit list."""
    k = directions.shape[1]
    if not k:
        return None

    def add(batches, totals):
        for d in _unpacked(batches, dims):
            w = _projected(_centred(d, n, sums), n, directions)
            products = w.T @ w
            for i in range(k):
                totals[-1, i] = totals.get((-1, i), 0.0) + float(w[:, i].sum())
                for j in range(i, k):
                    totals[i, j] = totals.get((i, j), 0.0) + float(products[i, j])

    totals = _totals(fit, add, "double")
    return max(abs(totals[i, j] / n - totals[-1, i] / n * totals[-1, j] / n - (i == j)) for i in range(k) for j in range(i, k))


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, components: int = COMPONENTS) -> DataFrame:
    """Per usable row and component: id, component (from 1), n, deviation, whitened, explained, identity_error.

    ``deviation`` is the exact sum of (n x - S)^2 over the dimensions as decimal(38,0); ``explained`` the
    component's share of the total variance, NULL if there is none. Only sums by pairs of dimensions reach
    the driver.
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")).where(F.size("vector") > 0)
    name = rows.schema["vec_id"].dataType.simpleString()
    lengths = rows.groupBy(F.size("vector").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    dims = lengths["dims"] if lengths else 1
    rows = rows.where(F.size("vector") == dims)
    fit = stored(distinct_vectors(rows, dims), "fit-vectors")
    n, sums = moments(fit, dims)
    cov = covariance(fit, dims, n, sums) if n else np.zeros((dims, dims))
    values, units = principal(cov, components)
    varies = values > max(values.max(initial=0.0), 0.0) * dims * np.finfo(float).eps
    directions = units[:, varies] / np.sqrt(values[varies])
    error = identity_error(fit, dims, n, sums, directions) if n else None
    trace = float(np.trace(cov))
    place = np.cumsum(varies) - 1

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, d in _vectors(batches, dims):
            t = _centred(d, n, sums)
            w = _projected(t, n, directions)
            cells = [[row[p] if v else None for p, v in zip(place.tolist(), varies.tolist())] for row in w.tolist()]
            deviation = [Decimal(v) for v in _squares_of_rows(t)]
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(deviation, pa.decimal128(38, 0)),
                                              pa.array(cells, pa.list_(pa.float64()))], names=["vec_id", "deviation", "w"])

    explained = F.array(*[F.lit(float(v) / trace if trace else None).cast("double") for v in values])
    return rows.mapInArrow(project, f"vec_id {name}, deviation decimal(38,0), w array<double>").select(
        "vec_id", "deviation", F.posexplode("w").alias("place", "whitened")).select(
        "vec_id", (F.col("place") + 1).cast("int").alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
        explained[F.col("place")].alias("explained"), F.lit(error).cast("double").alias("identity_error"))
