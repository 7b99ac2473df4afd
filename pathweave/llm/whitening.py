"""Whitening of embeddings, with cross-products from bit planes.

Entries become integers: x = floor(1024 * c) + 100000.  A task shifts each
dimension of a block of rows by its least value, cuts the shifted integers into
bit planes and packs each plane across the rows into 64-bit words.  The sum of
products of two dimensions is then the sum over their planes a and b of
2^(a + b) * popcount(a AND b), and the shifts are put back in integers: sums and
cross-products are exact, whatever the order of rows and tasks.  Spark adds up
what the tasks found, dimensions^2 / 2 numbers each, as decimals.

The driver gets these sums, a table whose size depends on the dimensions alone.
It centres them as integers, n * P - S S', divides by n^2 with correct rounding,
and takes eigenvectors by eigh, refined twice in extended precision.  Rows are then
projected by tasks.

Defined results: rows whose vector is null, holds null or non-finite entries,
or has another length than the most frequent one (ties: the longer) are dropped;
entries beyond 2^62 / 1024 count as that; repeated rows count each time; components
whose eigenvalue is not above dimensions * 2^-52 of the largest (constant or
dependent dimensions) are left out; an empty table, or one of equal vectors, gives
no components.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathweave.session import cut_lineage

SCALE, SHIFT = 1024, 100_000
LIMIT = float(2 ** 62)
PART = 10 ** 18             # sums travel as value // PART and value % PART, so that no decimal overflows
BLOCK_ENTRIES = 1 << 20     # entries of a block whose planes are packed together


@dataclass(frozen=True)
class Whitening:
    """What ``fit`` found: ``n`` rows, their sums, the eigenvectors as columns, eigenvalues falling, and the trace."""
    n: int
    sums: tuple
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def dims(self) -> int:
        return len(self.sums)


# ------------------------------------------------------------------ inside tasks
def integers(batch: pa.RecordBatch, column: int, dims: int) -> np.ndarray:
    """The integers of a batch of vectors of ``dims`` finite entries, a row each."""
    flat = batch.column(column).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    return np.clip(np.floor(flat * SCALE), -LIMIT, LIMIT).astype(np.int64) + SHIFT


def planes(y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed bit planes of the columns of ``y`` (not negative): words, a row a plane; its bit; first plane of each column.

    A column of zeros keeps one empty plane.
    """
    rows, dims = y.shape
    width = [max(1, int(v).bit_length()) for v in y.max(axis=0)]
    first = np.concatenate([[0], np.cumsum(width)])
    packed = np.zeros((first[-1], -(-rows // 64) * 8), dtype=np.uint8)
    for b in range(max(width)):
        has = [d for d in range(dims) if width[d] > b]
        bits = np.packbits(((y[:, has] >> b) & 1).astype(np.uint8), axis=0)
        packed[first[has] + b, :bits.shape[0]] = bits.T
    bit = np.concatenate([np.arange(w) for w in width])
    return packed.view(np.uint64), bit, first


def cross_products(y: np.ndarray) -> np.ndarray:
    """Exact sums of products of the columns of ``y`` (not negative), the upper triangle."""
    words, bit, first = planes(y)
    dims = y.shape[1]
    exact = np.int64 if 2 * (int(bit.max()) + 1) + int(len(y)).bit_length() <= 62 else object
    out = np.zeros((dims, dims), dtype=exact)
    weight = np.array([1 << int(b) for b in bit], dtype=exact)
    for i in range(dims):
        rest = words[first[i]:]
        for p in range(first[i], first[i + 1]):
            counts = np.bitwise_count(rest & words[p]).sum(axis=1, dtype=np.int64).astype(exact)
            out[i, i:] += weight[p] * np.add.reduceat(counts * weight[first[i]:], first[i:-1] - first[i])
    return out


def _moments(dims: int):
    """One row per number: (-1, -1) the rows, (-1, j) sums, (i, j) with i <= j cross-products."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, cross = 0, np.zeros(dims, dtype=object), np.zeros((dims, dims), dtype=object)
        block = max(64, BLOCK_ENTRIES // dims)
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                x = integers(batch.slice(at, block), 0, dims)
                low = x.min(axis=0)
                # the differences are at most 2^63, so they are right as unsigned numbers
                y = x.astype(np.uint64) - low.astype(np.uint64)
                l = low.astype(object)
                # halves are added apart, as whole sums may not fit 64 bits
                s = (y >> np.uint64(32)).sum(axis=0).astype(object) * (1 << 32) + (y & np.uint64(0xFFFFFFFF)).sum(axis=0).astype(object)
                rows = len(x)
                cross += cross_products(y).astype(object) + np.outer(l, s) + np.outer(s, l) + rows * np.outer(l, l)
                sums += s + rows * l
                n += rows
        if not n:
            return
        i, j = np.triu_indices(dims)
        where = [(-1, -1), *[(-1, d) for d in range(dims)], *zip(i.tolist(), j.tolist())]
        value = [n, *sums.tolist(), *cross[i, j].tolist()]
        yield pa.RecordBatch.from_arrays([
            pa.array([w[0] for w in where], pa.int32()), pa.array([w[1] for w in where], pa.int32()),
            pa.array([str(v // PART) for v in value]), pa.array([v % PART for v in value], pa.int64())], ["i", "j", "hi", "lo"])
    return run


# ------------------------------------------------------------------ on the driver
def _finite(v: Column) -> Column:
    return v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))


def usable(rows: DataFrame, vector: str, dims: int | None = None) -> DataFrame:
    """The rows whose vector is finite throughout, of ``dims`` entries if given."""
    kept = rows.where(_finite(F.col(vector)))
    return kept if dims is None else kept.where(F.size(vector) == dims)


def refined(v: list[list[Fraction]], vectors: np.ndarray, rounds: int = 2) -> np.ndarray:
    """Eigenvectors of a symmetric matrix made better in extended precision, columns as given.

    A step of Ogita and Aishima's iteration: the vectors are corrected by
    E with E_ij = (S_ij + e_j R_ij) / (e_j - e_i), where S = X' V X and R = I - X' X.
    """
    high = np.array([[float(x) for x in row] for row in v], dtype=np.longdouble)
    low = np.array([[float(x - Fraction(float(x))) for x in row] for row in v], dtype=np.longdouble)
    a, x = high + low, vectors.astype(np.longdouble)
    for _ in range(rounds):
        r = np.eye(len(a), dtype=np.longdouble) - x.T @ x
        s = x.T @ a @ x
        e = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(np.diag(s))
        near = 2 * (np.abs(off).sum(axis=1).max() + np.abs(a).sum(axis=1).max() * np.abs(r).sum(axis=1).max())
        gap = e[None, :] - e[:, None]
        x = x + x @ np.where(np.abs(gap) > near, (s + e[None, :] * r) / np.where(gap == 0, 1, gap), r / 2)
    return x


def components(n: int, sums: list[int], cross: dict) -> Whitening:
    """The model of exact sums; ``cross`` has (i, j) with i <= j."""
    dims = len(sums)
    v = [[Fraction(0)] * dims for _ in range(dims)]
    for (i, j), p in cross.items():
        v[i][j] = v[j][i] = Fraction(n * p - sums[i] * sums[j], n * n)
    trace = sum(v[d][d] for d in range(dims))
    _, x = np.linalg.eigh(np.array([[float(c) for c in row] for row in v]))
    x = refined(v, x)
    a = np.array([[float(c) for c in row] for row in v], dtype=np.longdouble)
    e = np.einsum("ij,ij->j", x, a @ x) / np.einsum("ij,ij->j", x, x)
    order = np.argsort(-e, kind="stable")
    e, x = e[order], x[:, order] / np.sqrt(np.einsum("ij,ij->j", x, x))[order]
    x = x * np.where(x[np.argmax(np.abs(x), axis=0), np.arange(dims)] < 0, -1, 1)     # the largest entry is positive
    there = e > max(dims * 2.0 ** -52 * float(e[0]), 0.0)
    return Whitening(n, tuple(sums), x[:, there].astype(np.float64), e[there].astype(np.float64), float(trace))


def fit(rows: DataFrame, vector: str = "embedding") -> Whitening | None:
    """The whitening of all usable rows; None where there is none or the vectors have no entries."""
    common = usable(rows, vector).groupBy(F.size(vector).alias("d")).count() \
        .orderBy(F.desc("count"), F.desc("d")).first()
    if common is None or common["d"] == 0:
        return None
    dims = common["d"]
    parts = usable(rows, vector, dims).select(vector).mapInArrow(_moments(dims), "i int, j int, hi string, lo long")
    added = parts.groupBy("i", "j").agg(F.sum(F.col("hi").cast("decimal(38,0)")).alias("hi"),
                                        F.sum(F.col("lo").cast("decimal(38,0)")).alias("lo")).collect()
    got = {(r.i, r.j): int(r.hi) * PART + int(r.lo) for r in added}
    n = got.pop((-1, -1))
    sums = [got.pop((-1, d)) for d in range(dims)]
    return components(n, sums, got)


# ------------------------------------------------------------------ projecting rows
def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - sums, exact: of 64-bit integers where they do, else of Python's."""
    largest = n * (int(np.abs(x).max(initial=0))) + max(abs(int(s)) for s in sums)
    if largest < 2 ** 62:
        return x * np.int64(n) - sums.astype(np.int64)
    return x.astype(object) * n - sums


def _squares(d: np.ndarray) -> list[int | None]:
    """Sums of squares by row; null where one does not fit a long."""
    if d.dtype == np.int64 and float(np.abs(d).max(initial=0)) ** 2 * d.shape[1] < 2 ** 62:
        return (d * d).sum(axis=1).tolist()
    whole = [sum(int(v) ** 2 for v in row) for row in d]
    return [v if v < 2 ** 63 else None for v in whole]


def transform(rows: DataFrame, model: Whitening, top: int | None = None, key: str = "vec_id",
              vector: str = "embedding") -> DataFrame:
    """(key, deviation, whitened array) of every usable row, by the first ``top`` components.

    ``deviation`` is the sum over dimensions of (n x - S)^2; an entry of ``whitened`` is x - S / n
    projected on the component, over the root of its eigenvalue.
    """
    scaled = model.vectors[:, :top] / np.sqrt(model.values[:top])
    n, sums, dims = model.n, np.array(model.sums, dtype=object), model.dims

    def run(batches):
        block = max(64, BLOCK_ENTRIES // dims)
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                d = _deviations(integers(part, 1, dims), n, sums)
                z = (d / n).astype(np.float64) @ scaled
                ends = pa.array(np.arange(len(z) + 1) * z.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(_squares(d), pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(z.ravel(), pa.float64()))], [key, "deviation", "whitened"])

    kept = usable(rows, vector, dims).select(key, vector)
    kind = kept.schema[key].dataType.simpleString()
    return kept.mapInArrow(run, f"`{key}` {kind}, deviation long, whitened array<double>")


def identity_error(whitened: DataFrame, m: int) -> float:
    """Largest absolute entry of the covariance of ``whitened`` arrays minus the identity (divisor n, centred first)."""
    z = [F.get("whitened", F.lit(i)) for i in range(m)]
    mean = whitened.agg(*[F.avg(c) for c in z]).first()
    pairs = [(i, j) for i in range(m) for j in range(i, m)]
    cov = whitened.agg(*[F.avg((z[i] - mean[i]) * (z[j] - mean[j])) for i, j in pairs]).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(cov, pairs))


def whiten(rows: DataFrame, top: int = 8, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Per usable row and component up to ``top``: key, component (from 1), n, deviation, whitened, explained, identity_error."""
    out = f"`{key}` {rows.schema[key].dataType.simpleString()}, component int, n long, deviation long, whitened double, " \
          "explained double, identity_error double"
    model = fit(rows, vector)
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], out)
    m = min(top, len(model.values))
    done = cut_lineage(transform(rows, model, m, key, vector))
    explained = F.array(*[F.lit(float(e) / model.trace) for e in model.values[:m]])
    return done.select(key, "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        key, (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(identity_error(done, m)).alias("identity_error"))
