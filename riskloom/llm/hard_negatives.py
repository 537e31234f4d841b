"""Hard negatives for anchors, by secondary sort.

Pairs travel under the key (anchor, falling score, id): the shuffle deals them by anchor and sorts them by
the whole key, and an iterator walks an anchor's pairs from the best score down. A positive opens a window of scores
below its own; a negative is emitted for every open window it falls into. Only the few open windows are held.

Scores come from blocks: every group of rows meets every anchor once, as a product of matrices. A group sends
an anchor's first positives; once those of all groups are known, it sends the first negatives inside
each of their windows. The first few of all rows are among the first few of their groups, so nothing is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.llm.whitening import rounded
from riskloom.session import materialise

#: Bytes of packed vectors and rows in a group at most, and the fewest rows it is cut to for the sake of idle cores.
GROUP_BYTES, MOST_ROWS, LEAST_ROWS = 8 << 20, 1 << 15, 1024
#: Squares of a vector's rounded entries add up to this at most, so that a hundred times a score is a 64-bit integer.
MOST_SQUARE = 2.0 ** 56
#: Anchors that meet a group at a time.
TOGETHER = 128

PAIRS = "anchor long, id long, score long"


def exact_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of integer rows as 64-bit integers. Doubles give them exactly while no sum reaches 2 ** 53."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if top < 2.0 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def first_of(scores: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
    """Places of the ``count`` highest scores, equal ones by id."""
    if len(scores) > 4 * count:
        least = np.partition(scores, len(scores) - count)[len(scores) - count]
        some = np.flatnonzero(scores >= least)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))][:count]


def hard_negatives(vectors: DataFrame, anchors: Column, vector: str = "embedding", key: str = "vec_id", label: str = "label",
                   positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: float = 256.0,
                   most_rows: int = MOST_ROWS, least_rows: int = LEAST_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows of ``vectors`` that ``anchors``, a
    condition on ``key``, selects.

    Entries become floor(``scale`` * entry); a score is the inner product with the anchor, and higher scores come
    first, ties by smaller key. An anchor's positives are its first ``positives`` other rows of the same label.
    Per positive, the first ``negatives`` rows of another label with ``low`` * positive <= 100 * negative <= ``high`` * positive are
    returned, ``rank`` from 1.

    Rows with a null key, label or vector, an empty vector, or a null, non-finite or too large entry (a score must fit 64 bits)
    take no part; vectors of different lengths have no score. Of rows that share a key the one with the smallest label, then vector, counts.
    Anchors without positives, and positives without negatives, give no rows; an empty table gives none. Other columns are not read.
    """
    spark = vectors.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    named = vectors.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("label"),
                           F.coalesce(anchors, F.lit(False)).alias("anchor"), F.col(f"`{vector}`").alias("v"))
    usable = rounded(named.where("id is not null and label is not null"), "v", scale, {"id": "long", "label": "long", "anchor": "boolean"}, MOST_SQUARE)
    # Combined per task first, so that a key with many rows is one row per task.
    one = usable.groupBy("id").agg(F.min(F.struct("label", "data", "anchor")).alias("row")).select("id", "row.*")
    rows = materialise(one, "negatives-rows")
    whole = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("data")), F.lit(0)).alias("bytes")).first()
    groups = max(1, -(-whole["bytes"] // GROUP_BYTES), -(-whole["n"] // most_rows), min(2 * width, whole["n"] // least_rows))

    def met(asking: DataFrame, extra: str, answer) -> DataFrame:
        """Pairs from every group of rows and every row of ``asking`` (id, label, data, ``extra``): ``answer`` picks
        them from an anchor's label, extra, id and scores, the rows' labels and ids."""
        place = F.pmod(F.xxhash64("id"), F.lit(groups))
        none = F.lit(None).cast(f"array<{extra}>")
        sides = rows.select(place.alias("group"), F.lit(0).alias("kind"), "id", "label", "data", none.alias("extra")).unionByName(
            asking.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("group"), F.lit(1).alias("kind"), "id", "label", "data", "extra"))
        sides = sides.withColumn("length", F.length("data"))

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            here, held, asked, matrix = None, [], [], None

            def ask() -> Iterator[pa.RecordBatch]:
                nonlocal matrix
                if held and matrix is None:
                    ids, labels = (np.array([r[i] for r in held], np.int64) for i in range(2))
                    matrix = ids, labels, vectors_of([r[2] for r in held])
                if held and asked:
                    ids, labels, x = matrix
                    scores = exact_product(vectors_of([a[2] for a in asked]), x)
                    found = [(a[0], answer(a[1], a[3], a[0], s, labels, ids), s) for a, s in zip(asked, scores, strict=True)]
                    asked.clear()
                    who = np.concatenate([np.full(len(p), a) for a, p, _ in found]).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(who), pa.array(np.concatenate([ids[p] for _, p, _ in found])), pa.array(np.concatenate([s[p] for _, p, s in found]))],
                        names=["anchor", "id", "score"])

            for batch in batches:
                for length, group, kind, i, label, data, extra in zip(*(batch.column(c).to_pylist() for c in range(7)), strict=True):
                    if (length, group) != here:
                        yield from ask()
                        here, held, asked, matrix = (length, group), [], [], None
                    if kind == 0:
                        held.append((i, label, data))
                    else:
                        asked.append((i, label, data, extra))
                        if len(asked) >= TOGETHER:
                            yield from ask()
                            asked.clear()
            yield from ask()

        order = ["length", "group", "kind", "id"]
        return sides.select("length", "group", "kind", "id", "label", "data", "extra").repartition(width, "length", "group").sortWithinPartitions(
            *order).mapInArrow(compare, PAIRS)

    def same(label: int, _: None, own: int, scores: np.ndarray, labels: np.ndarray, ids: np.ndarray) -> np.ndarray:
        some = np.flatnonzero((labels == label) & (ids != own))
        return some[first_of(scores[some], ids[some], positives)]

    def other(label: int, windows: list[int], own: int, scores: np.ndarray, labels: np.ndarray, ids: np.ndarray) -> np.ndarray:
        hundred = 100 * scores
        found = []
        for p in set(windows):
            some = np.flatnonzero((labels != label) & (hundred >= low * p) & (hundred <= high * p))
            found.append(some[first_of(scores[some], ids[some], negatives)])
        return np.unique(np.concatenate(found))

    asking = materialise(rows.where("anchor").select("id", "label", "data"), "negatives-anchors")
    best = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    first = met(asking.withColumn("extra", F.lit(None).cast("array<long>")), "long", same)
    first = materialise(first.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives).drop("place"), "negatives-positives")
    windows = first.groupBy("anchor").agg(F.collect_list("score").alias("extra"))  # as many as ``positives``
    second = met(asking.join(windows.withColumnRenamed("anchor", "id"), "id"), "long", other)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, open_windows = None, []
        for batch in batches:
            out: list[tuple] = []
            for anchor, score, kind, i in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                if anchor != here:
                    here, open_windows = anchor, []
                if kind == 0:
                    open_windows.append([i, score, 0])
                    continue
                for window in open_windows:
                    if low * window[1] <= 100 * score <= high * window[1] and window[2] < negatives:
                        window[2] += 1
                        out.append((anchor, window[0], window[2], i, window[1], score))
                open_windows = [w for w in open_windows if w[2] < negatives and 100 * score >= low * w[1]]
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    pairs = first.select("anchor", "score", F.lit(0).alias("kind"), "id").unionByName(second.select("anchor", "score", F.lit(1).alias("kind"), "id"))
    # A positive of score 0 opens its window before the negatives of score 0: positives come first.
    return pairs.repartition(width, "anchor").sortWithinPartitions("anchor", F.desc("score"), "kind", "id").mapInArrow(
        walk, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


def vectors_of(data: list[bytes]) -> np.ndarray:
    """Packed rows of one length as 64-bit integers."""
    return np.frombuffer(b"".join(data), np.int32).reshape(len(data), -1).astype(np.int64)
