"""Category dictionaries: dense slots for the values that training saw, and the weights a model gave them.

A dictionary is a table with a row per (category, value), kept beside the model. A category has as
many slots as values, however far apart its codes are, and no list of values passes through an
expression. Values find their row by a join: while a category's part of the table is small Spark
broadcasts it, and beyond that shuffles, where its skew handling splits a value that many rows have.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.casts import missing_to_null
from riskloom.operators.ranking import running_totals
from riskloom.session import materialise

UNKNOWN_TEXT = "(unknown)"
SCHEMA = "feature int, code bigint, word string, slot bigint, weight double"


def value_name(category: str) -> str:
    return f"{category}__value"


def slot_name(category: str) -> str:
    return f"{category}_slot"


def code_value(category: str) -> Column:
    """An integer category's code; null, for the unknown slot, where it is null or negative."""
    code = F.col(f"`{category}`").cast("long")
    return F.when(code >= 0, code).alias(value_name(category))


def word_value(category: str) -> Column:
    """A text category's word; missing text is a word of its own."""
    return F.coalesce(missing_to_null(F.col(f"`{category}`").cast("string")), F.lit(UNKNOWN_TEXT)).alias(value_name(category))


def dictionary(rows: DataFrame, codes: Sequence[str], words: Sequence[str]) -> DataFrame:
    """``(feature, code, word, slot)`` of the values in ``rows``, for the categories ``codes`` and then ``words``.

    Codes take the slots from 1 in ascending order, 0 being the unknown slot; words take those from 0. Values are
    made distinct before the shuffle, sorted in ranges over all categories together, and numbered by the ranges' sizes.
    """
    none = F.lit(None)
    cells = [F.struct(F.lit(i).alias("feature"), F.col(value_name(c)).alias("code"), none.cast("string").alias("word")) for i, c in enumerate(codes)]
    cells += [F.struct(F.lit(len(codes) + i).alias("feature"), none.cast("bigint").alias("code"), F.col(value_name(c)).alias("word"))
              for i, c in enumerate(words)]
    found = rows.select(F.inline(F.array(*cells))).filter("code is not null or word is not null").distinct()
    counts = found.select("feature", F.struct("code", "word").alias("value"), F.lit(1).cast("long").alias("n"))
    first = F.when(F.col("feature") < len(codes), 1).otherwise(0)
    numbered = running_totals(counts, "feature", "value", ["n"])
    return materialise(numbered.select("feature", "value.code", "value.word", (F.col("n_before") + first).alias("slot")), "categories")


def slot_counts(table: DataFrame, codes: Sequence[str], words: Sequence[str]) -> list[int]:
    """Slots of each category: codes have the unknown one beside their own, words one for the unseen."""
    found = {r["feature"]: r["n"] for r in table.groupBy("feature").agg(F.count("*").alias("n")).collect()}  # one per category
    return [found.get(i, 0) + 1 for i in range(len(codes) + len(words))]


def _looked_up(rows: DataFrame, table: DataFrame, position: int, category: str, is_code: bool, wanted: str) -> DataFrame:
    side = table.filter(F.col("feature") == position).select(
        F.col("code" if is_code else "word").alias(value_name(category)), F.col(wanted).alias("_found"))
    return rows.join(side, value_name(category), "left")


def encode(rows: DataFrame, table: DataFrame, codes: Sequence[str], words: Sequence[str], sizes: Sequence[int]) -> DataFrame:
    """The value columns replaced by slots, as doubles. A value the table lacks takes the slot behind the last one
    that a code can have, which an encoder turns into zeros, or the unseen slot of a word."""
    for i, c in enumerate([*codes, *words]):
        is_code = i < len(codes)
        unseen = F.lit(sizes[i] if is_code else sizes[i] - 1)
        missing = F.when(F.col(value_name(c)).isNull(), F.lit(0)).otherwise(unseen) if is_code else unseen
        slot = F.coalesce("_found", missing).cast("double")
        rows = _looked_up(rows, table, i, c, is_code, "slot").withColumn(slot_name(c), slot).drop("_found", value_name(c))
    return rows


def with_weights(table: DataFrame, blocks: Sequence[Sequence[float]]) -> DataFrame:
    """The dictionary with each value's weight: ``blocks`` has a category's weights by slot."""
    sizes = [len(block) for block in blocks]
    given = table.sparkSession.createDataFrame(pa.table({
        "feature": pa.array(np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)),
        "slot": pa.array(np.concatenate([np.arange(n, dtype=np.int64) for n in sizes])),
        "weight": pa.array(np.concatenate([np.asarray(block, np.float64) for block in blocks]))}))
    return materialise(table.join(given, ["feature", "slot"]).select("feature", "code", "word", "slot", "weight"), "category-weights")


def weigh(rows: DataFrame, table: DataFrame, codes: Sequence[str], words: Sequence[str], blocks: Sequence[Sequence[float]]) -> tuple[DataFrame, list[Column]]:
    """``rows`` with a weight per category, and those weights: of the value, of the unknown or the unseen slot, or 0."""
    weights = []
    for i, c in enumerate([*codes, *words]):
        is_code = i < len(codes)
        missing = F.when(F.col(value_name(c)).isNull(), F.lit(float(blocks[i][0]))).otherwise(0.0) if is_code else F.lit(float(blocks[i][-1]))
        weight = F.coalesce("_found", missing)
        rows = _looked_up(rows, table, i, c, is_code, "weight").withColumn(f"{c}__weight", weight).drop("_found")
        weights.append(F.col(f"`{c}__weight`"))
    return rows, weights
