"""Near-duplicate vectors by spherical-cap filters from random product codes.

A filter is a direction, and takes the unit vectors in the cap around it. The directions are a
product: one of ``codes`` random unit vectors in the first half of the dimensions with one of
``codes`` in the second. So a vector finds all filters whose cap it is in from two short lists of
inner products, without trying them all. Before the dimensions are halved the vectors go through a
fixed random rotation, so that whatever dimensions a vector's norm lies in, both halves get about as
much of it. A vector in fewer than ``LIST`` caps takes its ``LIST`` nearest directions instead, so
every vector is compared. Vectors that share a filter are compared exactly, in
double precision; a pair is reported by the smallest filter it shares, so once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.components import components
from riskloom.session import materialise

#: Filters of a vector, at least; most exceed the threshold with as many.
LIST = 24
#: Vectors the threshold is fitted on: those with the smallest hashes of their ids.
FIT_ROWS = 1024
#: Members of a filter that one task compares; a filter with more is cut into blocks of half this.
FILTER_ROWS = 4096


def codebook(codes: int, width: int, half: int, seed: int) -> np.ndarray:
    """``codes`` random unit vectors, scaled so that two of them make a unit vector."""
    rows = np.random.default_rng((seed, codes, width, half)).standard_normal((codes, max(width, 1)))
    return rows / np.linalg.norm(rows, axis=1, keepdims=True) / np.sqrt(2)


@lru_cache(maxsize=4)
def rotation(width: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng((seed, width)).standard_normal((width, width)))
    return q * np.where(np.diag(r) < 0, -1.0, 1.0)


def halves(unit: np.ndarray, codes: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Inner products of the rotated vectors with the codes of either half."""
    unit = unit @ rotation(unit.shape[1], seed)
    cut = (unit.shape[1] + 1) // 2
    first, second = unit[:, :cut], unit[:, cut:] if unit.shape[1] > 1 else unit[:, :1]
    return first @ codebook(codes, cut, 0, seed).T, second @ codebook(codes, second.shape[1], 1, seed).T


def fit_threshold(unit: np.ndarray, codes: int, seed: int, size: int = LIST) -> float:
    """The threshold that nine in ten of these vectors exceed with ``size`` filters or more."""
    a, b = halves(unit, codes, seed)
    most = min(size, codes)
    a, b = -np.sort(-a, axis=1)[:, :most], -np.sort(-b, axis=1)[:, :most]
    sums = (a[:, :, None] + b[:, None, :]).reshape(len(unit), -1)
    sums.sort(axis=1)
    return float(np.quantile(sums[:, -min(size, sums.shape[1])], 0.1))


def list_decode(unit: np.ndarray, codes: int, seed: int, threshold: float, size: int = LIST) -> tuple[np.ndarray, np.ndarray]:
    """(row, filter) of all filters that the vectors exceed, by row, then filter; of a vector that
    exceeds fewer than ``size``, its ``size`` best."""
    a, b = halves(unit, codes, seed)
    row, first = np.nonzero(a + b.max(1, keepdims=True) >= threshold)
    found_row, found = [], []
    for s in range(0, len(row), max(1, (1 << 20) // codes)):
        r, f = row[s:s + max(1, (1 << 20) // codes)], first[s:s + max(1, (1 << 20) // codes)]
        hit, second = np.nonzero(a[r, f][:, None] + b[r] >= threshold)
        found_row.append(r[hit])
        found.append(f[hit].astype(np.int64) * codes + second)
    row = np.concatenate(found_row) if found else np.zeros(0, np.int64)
    found = np.concatenate(found) if found else np.zeros(0, np.int64)
    few = np.flatnonzero(np.bincount(row, minlength=len(unit)) < size)
    if len(few):
        most = min(size, codes)
        a_best, b_best = np.argsort(-a[few], axis=1)[:, :most], np.argsort(-b[few], axis=1)[:, :most]
        sums = np.take_along_axis(a[few], a_best, 1)[:, :, None] + np.take_along_axis(b[few], b_best, 1)[:, None, :]
        best = np.argsort(-sums.reshape(len(few), -1), axis=1)[:, :size]
        mine = np.take_along_axis(a_best, best // most, 1).astype(np.int64) * codes + np.take_along_axis(b_best, best % most, 1)
        others = ~np.isin(row, few)
        row = np.concatenate([row[others], np.repeat(few, mine.shape[1])])
        found = np.concatenate([found[others], mine.ravel()])
        order = np.lexsort((found, row))
        row, found = row[order], found[order]
    return row, found


def close_pairs(unit: np.ndarray, lists: list[np.ndarray], here: int, sides: np.ndarray | None, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (i, j, cosine) of at least ``least`` whose smallest shared filter is ``here``; with
    ``sides``, only across them."""
    found = [], [], []
    for s in range(0, len(unit), 512):
        cosine = unit[s:s + 512] @ unit.T
        i, j = np.nonzero(cosine >= least)
        ok = i + s < j if sides is None else sides[i + s] < sides[j]
        for o, v in zip(found, (i[ok] + s, j[ok], cosine[i, j][ok]), strict=True):
            o.append(v)
    i, j, cosine = (np.concatenate(o) for o in found)
    if not len(i):
        return i, j, cosine
    # Which of them already share a smaller filter: a product of 0/1 matrices.
    rows = np.unique(np.concatenate([i, j]))
    smaller = [one[one < here] for one in (lists[r] for r in rows.tolist())]
    owner = np.repeat(np.arange(len(rows)), [len(one) for one in smaller])
    names, column, times = np.unique(np.concatenate(smaller), return_inverse=True, return_counts=True)
    i_row, j_row = np.searchsorted(rows, i), np.searchsorted(rows, j)
    before = np.zeros(len(i), bool)
    useful = np.flatnonzero(times > 1)
    for s in range(0, len(useful), 1024):
        place = np.full(len(names), -1)
        place[useful[s:s + 1024]] = np.arange(len(useful[s:s + 1024]))
        hit = place[column] >= 0
        has = np.zeros((len(rows), len(useful[s:s + 1024])), np.float32)
        has[owner[hit], place[column[hit]]] = 1
        for p in range(0, len(rows), 512):
            shared = has[p:p + 512] @ has.T > 0
            mine = np.flatnonzero((i_row >= p) & (i_row < p + 512))
            before[mine] |= shared[i_row[mine] - p, j_row[mine]]
    return i[~before], j[~before], cosine[~before]


def near_duplicates(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", least: float = 0.95,
                    size: int = LIST, filter_rows: int = FILTER_ROWS, seed: int = 7) -> DataFrame:
    """``key``, n_links, component_id, kept for every row.

    A row links to another if their vectors' cosine is at least ``least`` and they are found: equal
    vectors always are, others by the filters. ``n_links`` counts the rows linked directly,
    ``component_id`` is the smallest key reachable, ``kept`` tells whether that is the row itself.
    A vector that is null, empty, zero or has a null or non-finite component links with nothing,
    nor do vectors of different lengths; a row with a null key links with nothing and is kept.
    Repeated rows are rows, and equal vectors are one member of a filter, with their number. An
    empty table gives an empty one; other columns are not read.

    The number of filters follows the number of different vectors, so filters keep their size as
    the table grows. A filter with more than ``filter_rows`` members is compared block by block.
    """
    spark = vectors.sparkSession
    source = vectors.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("v"))
    narrow = vectors.schema[vector].dataType.elementType.simpleString() == "float"
    kind = np.float32 if narrow else np.float64

    def valid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = []
            for row in batch.column(1):
                values = row.values
                one = None
                if values is not None and len(values) and not values.null_count:
                    x = values.to_numpy(zero_copy_only=False).astype(kind) + kind(0)  # -0.0 becomes 0.0
                    if np.isfinite(x).all() and x.any():
                        one = x.tobytes()
                data.append(one)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], names=["id", "data"])

    rows = source.mapInArrow(valid, "id long, data binary")
    rows = materialise(rows.withColumn("data", F.when(F.col("id").isNotNull(), F.col("data"))), "caps-vectors")
    members = materialise(rows.where("data is not null").groupBy("data").agg(F.min("id").alias("rep"), F.count("*").alias("n")), "caps-members")
    codes = max(16, int(np.ceil(np.sqrt(members.count()))))

    def units(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """By length: which rows, and their unit vectors."""
        data = column.to_pylist()
        lengths = np.array([len(d) for d in data], np.int64)
        out = {}
        for length in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == length)
            x = np.frombuffer(b"".join([data[i] for i in at]), kind).reshape(len(at), -1).astype(np.float64)
            x /= np.abs(x).max(1, keepdims=True)  # a norm that neither overflows nor vanishes
            out[length] = at, x / np.linalg.norm(x, axis=1, keepdims=True)
        return out

    sample = members.select("data", F.length("data").alias("size")).orderBy(F.xxhash64("data")).limit(FIT_ROWS).toArrow()
    thresholds = {n: fit_threshold(x, codes, seed, size) for n, (_, x) in units(sample.column("data").combine_chunks()).items()} if len(sample) else {}
    # A length that the sample misses is rare: its vectors all share one filter.

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 1024):
                part = batch.slice(s, 1024)
                rep, n, data = part.column(0).to_numpy(), part.column(1).to_numpy(), part.column(2)
                for length, (at, unit) in units(data).items():
                    if length in thresholds:
                        row, found = list_decode(unit, codes, seed, thresholds[length], size)
                    else:
                        row, found = np.arange(len(at)), np.zeros(len(at), np.int64)
                    per = np.bincount(row, minlength=len(at))
                    ends = np.cumsum(per)
                    lists = [found[e - c:e].tobytes() for e, c in zip(ends, per, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found), pa.array(np.full(len(found), length)), pa.array(rep[at][row]), pa.array(n[at][row]),
                         data.take(pa.array(at[row])), pa.array([lists[r] for r in row.tolist()], pa.binary())],
                        names=["filter", "length", "rep", "n", "data", "filters"])

    entries = members.select("rep", "n", "data").mapInArrow(
        decode, "filter long, length long, rep long, n long, data binary, filters binary")
    crowded = materialise(entries.groupBy("filter", "length").agg(F.count("*").alias("rows")).where(F.col("rows") > filter_rows).select(
        "filter", "length", F.ceil(2 * F.col("rows") / filter_rows).alias("blocks")), "caps-crowded")
    dealt = entries.join(crowded, ["filter", "length"], "left").withColumn("block", F.pmod(F.xxhash64("rep"), F.coalesce("blocks", F.lit(1))))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("blocks", F.lit(1)) - 1)))
    dealt = dealt.select("filter", "length", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                         (F.col("block") > F.col("other")).cast("int").alias("side"), "rep", "n", "data", "filters")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held = None, []

        def close() -> Iterator[pa.RecordBatch]:
            if len(held) < 2:
                return
            here, _, low, high = task
            rep, n = np.array([h[0] for h in held]), np.array([h[1] for h in held])
            _, unit = next(iter(units(pa.array([h[2] for h in held], pa.binary())).values()))
            sides = None if low == high else np.array([h[4] for h in held])
            i, j, cosine = close_pairs(unit, [np.frombuffer(h[3], np.int64) for h in held], here, sides, least)
            if len(i):
                yield pa.RecordBatch.from_arrays([pa.array(rep[i]), pa.array(rep[j]), pa.array(n[i]), pa.array(n[j]), pa.array(cosine)],
                                                 names=["a", "b", "n_a", "n_b", "cosine"])

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(9)]
            for f, length, low, high, side, rep, n, data, filters in zip(*columns, strict=True):
                if (f, length, low, high) != task:
                    yield from close()
                    task, held = (f, length, low, high), []
                held.append((rep, n, data, filters, side))
        yield from close()

    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    task = ["filter", "length", "low", "high"]
    pairs = materialise(dealt.repartition(width, *task).sortWithinPartitions(*task).mapInArrow(
        compare, "a long, b long, n_a long, n_b long, cosine double"), "caps-pairs")
    ends = pairs.select(F.col("a").alias("rep"), F.col("n_b").alias("n")).unionByName(pairs.select(F.col("b").alias("rep"), F.col("n_a").alias("n")))
    degrees = ends.groupBy("rep").agg(F.sum("n").alias("others"))
    labels = components(pairs.select("a", "b"), "caps-links").select(F.col("node").alias("rep"), F.col("component"))
    known = members.join(degrees, "rep", "left").join(labels, "rep", "left").select(
        "data", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    out = rows.join(known, "data", "left").select(
        F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(f"`{key}`") == F.col("component_id"), F.lit(True)))
