"""Whitening of embeddings by shifted CholeskyQR.

The centred rows Y are brought to Q R by passes over the data: each sums the Gram matrix of the rows
in the cluster, factors it by Cholesky on the driver, and the next pass takes the rows through one
more triangular solve. The first factor is of the Gram matrix plus a small multiple of the identity,
so that it exists however ill-conditioned the rows are; later passes repair what the shift bent.
The product of the factors is R, whose singular vectors are the components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import materialise

#: Rounded entries are 32-bit integers; rows with larger ones take no part.
MOST = 2.0 ** 31 - 1
#: A direction with less than this share of the largest singular value is no component.
FLAT = 1e-10
#: How far the orthogonalised rows may be from orthonormal, and passes after which that is an error.
CLOSE, PASSES = 1e-11, 16


def solved(y: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Q such that Q r is ``y``, for an upper triangular ``r``: forward substitution, column by column."""
    q = np.empty_like(y)
    for j in range(len(r)):
        q[:, j] = (y[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def factor(gram: np.ndarray, n: int, first: bool) -> np.ndarray:
    """The upper triangular Cholesky factor of ``gram``. The first is shifted by a multiple of the identity; a later
    one only where ``gram`` is flat, so that the directions that are orthonormal already stay so."""
    d = len(gram)
    shift = 11.0 * (n * d + d * (d + 1)) * np.finfo(float).eps / 2 * np.trace(gram)
    if first:
        return np.linalg.cholesky(gram + shift * np.eye(d)).T
    size, axes = np.linalg.eigh(gram)
    if size[0] < shift:
        gram = (axes * np.maximum(size, shift)) @ axes.T
    return np.linalg.cholesky(gram).T


class Centred:
    """Rows minus their mean: the mean is ``whole`` + ``rest`` / n, and only the second part rounds."""

    def __init__(self, sums: np.ndarray, n: int):
        self.n = n
        self.whole = np.array([int(s) // n for s in sums], np.int64)
        self.rest = np.array([int(s) % n for s in sums], np.int64)

    def rows(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest / self.n

    def deviation(self, x: np.ndarray) -> pa.Array:
        """The sum over dimensions of (n x - S) ** 2, exact; null where it is no 64-bit integer."""
        part = x - self.whole
        most = float(np.abs(part).max(initial=0)) * self.n + self.n
        if part.shape[1] * most * most < 2.0 ** 62:
            t = part * self.n - self.rest
            return pa.array((t * t).sum(1))
        each = [sum((int(p) * self.n - int(r)) ** 2 for p, r in zip(one, self.rest, strict=True)) for one in part]
        return pa.array([e if e < 2 ** 63 else None for e in each], pa.int64())


def unpacked(column: pa.Array, width: int) -> np.ndarray:
    """Packed rows of ``width`` 32-bit integers as 64-bit ones."""
    return np.frombuffer(b"".join(column.to_pylist()), np.int32).reshape(-1, width).astype(np.int64)


def rounded(vectors: DataFrame, vector: str, scale: float, carry: dict[str, str], most_square: float = np.inf) -> DataFrame:
    """The ``carry`` columns (name to type) and ``data``, floor(scale * entry) of every entry as packed 32-bit integers.

    Rows whose vector is null or empty, or has a null, non-finite or (by ``MOST``) too large entry, or whose
    rounded entries' squares add up to more than ``most_square``, are left out.
    """
    def valid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            ends, data = column.offsets.to_numpy(), column.values
            values = np.floor(scale * data.to_numpy(zero_copy_only=False).astype(np.float64))
            bad = ~(np.abs(values) <= MOST)
            if data.null_count:
                bad |= data.is_null().to_numpy(zero_copy_only=False)
            faults = np.concatenate([[0], np.cumsum(bad)])
            ok = np.flatnonzero((np.diff(ends) > 0) & (faults[ends[1:]] == faults[ends[:-1]]) & column.is_valid().to_numpy(zero_copy_only=False))
            values = np.where(bad, 0.0, values)
            if len(ok):
                squares = np.concatenate([values * values, np.zeros(1)])
                ok = ok[np.add.reduceat(squares, np.stack([ends[ok], ends[ok + 1]], 1).ravel())[::2] <= most_square]
            packed = values.astype(np.int32)
            rows = pa.array([packed[a:b].tobytes() for a, b in zip(ends[ok].tolist(), ends[ok + 1].tolist(), strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(i).take(pa.array(ok)) for i in range(len(carry))), rows], names=[*carry, "data"])

    columns = [F.col(f"`{c}`").cast(t).alias(c) for c, t in carry.items()]
    schema = "".join(f"`{c}` {t}, " for c, t in carry.items()) + "data binary"
    return vectors.select(*columns, F.col(f"`{vector}`").cast("array<double>").alias("__v")).mapInArrow(valid, schema)


def whitened(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = 16, scale: float = 64.0) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error): a row for each usable row and component.

    Entries become floor(``scale`` * entry) (any constant added to them changes nothing here). The fit list is each distinct vector
    once, ``n`` of them. Components are the unit eigenvectors of its covariance (divisor n), numbered
    from 1 by falling eigenvalue; ``whitened`` is the centred row along the component over the root of the
    eigenvalue, ``explained`` the eigenvalue over the sum of all, ``deviation`` the sum over dimensions of
    (n * entry - sum) ** 2, ``identity_error`` the largest absolute entry of the covariance of ``whitened`` minus the identity.

    Rows whose vector is null, empty, or has a null, non-finite or too large entry take no part, nor do rows
    of another length than most rows have (of equally frequent ones, the larger). Directions without
    variance are no components, so a table of one distinct vector, like an empty one, gives no rows. Repeated rows are
    answered as often as they occur, with any key, null too. Other columns are not read.
    """
    spark = vectors.sparkSession
    named = vectors.select(F.col(f"`{key}`").alias("id"), F.col(f"`{vector}`").alias("v"))
    rows = materialise(rounded(named, "v", scale, {"id": vectors.schema[key].dataType.simpleString()}), "whitening-rows")
    lengths = rows.groupBy(F.length("data").alias("bytes")).count().orderBy(F.desc("count"), F.desc("bytes")).first()
    schema = named.select(F.col("id").alias(key)).schema.add("component", "integer").add("n", "long").add("deviation", "long").add(
        "whitened", "double").add("explained", "double").add("identity_error", "double")
    if lengths is None:
        return spark.createDataFrame([], schema)
    d = lengths["bytes"] // 4
    rows = rows.where(F.length("data") == lengths["bytes"])
    fit = materialise(rows.select("data").distinct(), "whitening-fit")

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = np.zeros(d, np.int64), 0
        for batch in batches:
            sums += unpacked(batch.column(0), d).sum(0)
            n += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, d)), pa.array(np.concatenate([[n], sums]))], names=["i", "v"])

    # One row per dimension, whatever the number of rows.
    sums = {r["i"]: int(r["v"]) for r in fit.mapInArrow(total, "i long, v long").groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()}
    n = sums.pop(-1)
    centre = spark.sparkContext.broadcast(Centred(np.array([sums[i] for i in range(d)], object), n))

    def products(rs: list[np.ndarray], last: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Gram matrix and sums of the fit list, taken through the triangular solves ``rs`` and the matrix ``last``."""
        known = spark.sparkContext.broadcast((rs, last))
        width = d if last is None else last.shape[1]
        upper = np.triu_indices(width)

        def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rs, last = known.value
            out, sums = np.zeros((width, width)), np.zeros(width)
            for batch in batches:
                for a in range(0, batch.num_rows, 4096):
                    q = centre.value.rows(unpacked(batch.column(0).slice(a, 4096), d))
                    for r in rs:
                        q = solved(q, r)
                    if last is not None:
                        q = q @ last
                    out += q.T @ q
                    sums += q.sum(0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([upper[0], np.full(width, -1)])), pa.array(np.concatenate([upper[1], np.arange(width)])),
                 pa.array(np.concatenate([out[upper], sums]))], names=["i", "j", "v"])

        # One row per pair of dimensions, whatever the number of rows.
        summed = fit.mapInArrow(gram, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
        i, j, v = (summed.column(c).to_numpy() for c in "ijv")
        out, sums = np.zeros((width, width)), np.zeros(width)
        inner = i >= 0
        out[i[inner], j[inner]] = out[j[inner], i[inner]] = v[inner]
        sums[j[~inner]] = v[~inner]
        return out, sums

    rs, r = [], np.eye(d)
    for _ in range(PASSES):
        gram, _ = products(rs)
        if np.trace(gram) == 0.0:
            return spark.createDataFrame([], schema)
        left, size, right = np.linalg.svd(r)
        live = size > size[0] * FLAT
        if rs and np.abs(left[:, live].T @ gram @ left[:, live] - np.eye(live.sum())).max() <= CLOSE:
            break
        rs.append(factor(gram, n, not rs))
        r = rs[-1] @ r
    else:
        raise ArithmeticError(f"the rows are not orthogonal after {PASSES} passes")
    count = min(components, int(live.sum()))
    basis = right[:count].T / (size[:count] / np.sqrt(n))
    cross, sums = products([], basis)
    error = float(np.abs(cross / n - np.outer(sums / n, sums / n) - np.eye(count)).max())
    known = spark.sparkContext.broadcast((basis, size[:count] ** 2 / (size ** 2).sum(), error))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        basis, explained, error = known.value
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                part = batch.slice(a, 4096)
                x, m = unpacked(part.column(1), d), part.num_rows
                again = pa.array(np.repeat(np.arange(m), count))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(again), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), m)), pa.array(np.full(m * count, n)),
                     centre.value.deviation(x).take(again), pa.array((centre.value.rows(x) @ basis).ravel()), pa.array(np.tile(explained, m)),
                     pa.array(np.full(m * count, error))], names=schema.names)

    return rows.mapInArrow(project, schema)
