"""Slots, arrays and standard scores in SQL terms, and the key-stable split.

The fitted pipeline (``plans.pipeline``) uses Spark ML's own stages for the same work;
these forms serve inspection and hand-over to tools that do not read ML vectors.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.values import split_bucket


def active_slots(df: DataFrame, keys: Sequence[str], slots: Mapping[str, str], sizes: Sequence[int]) -> DataFrame:
    """``(keys, feature, slot)`` for the one slot each category sets, without building the
    vectors. ``slots`` maps feature to slot column and ``sizes`` are the fitted encoder's; a
    slot beyond the size is an unseen category, whose block is all zero: no row."""
    blocks = [F.struct(F.lit(f).alias("feature"), F.when(F.col(c) < size, F.col(c)).cast("long").alias("slot"))
              for (f, c), size in zip(slots.items(), sizes)]
    return df.select(*keys, F.inline(F.array(*blocks))).filter(F.col("slot").isNotNull())


def vector_as_array(df: DataFrame, vector: str, name: str) -> DataFrame:
    return df.withColumn(name, vector_to_array(vector))


def feature_width(df: DataFrame, vector: str) -> int:
    """Width of an assembled vector, from the column's metadata: no row is read."""
    return int(df.schema[vector].metadata["ml_attr"]["num_attrs"])


def standardise(df: DataFrame, columns: Sequence[str], moments: dict[str, tuple[float, float]]) -> DataFrame:
    """(value - mean) / sample deviation; 0.0 for a constant column."""
    def score(c: str) -> Column:
        mean, deviation = moments[c]
        return (F.col(c) - F.lit(mean)) / F.lit(deviation) if deviation else F.lit(0.0)

    return df.withColumns({c: score(c) for c in columns})


def hash_split(df: DataFrame, keys: Sequence[str], train_percent: int = 80) -> DataFrame:
    """Mark each row ``train`` or ``test`` by its key, whatever the partitioning."""
    in_train = split_bucket(*[F.col(k) for k in keys]) < train_percent
    return df.withColumn("part", F.when(in_train, "train").otherwise("test"))


def train_test(df: DataFrame, keys: Sequence[str], train_percent: int = 80) -> tuple[DataFrame, DataFrame]:
    marked = hash_split(df, keys, train_percent)
    return (marked.filter(F.col("part") == "train").drop("part"),
            marked.filter(F.col("part") == "test").drop("part"))

