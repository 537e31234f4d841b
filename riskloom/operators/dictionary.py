"""Code lists: label to code, code to label, and codes outside the list."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def code_dictionary(spark: SparkSession, lists: Mapping[str, Sequence[str]], first_code: int = 1) -> DataFrame:
    """``(attribute, code, label)`` from ordered label lists; codes count from ``first_code``."""
    entries = [F.struct(F.lit(name).alias("attribute"), F.lit(code).alias("code"), F.lit(label).alias("label"))
               for name, labels in lists.items() for code, label in enumerate(labels, first_code)]
    return spark.range(1).select(F.inline(F.array(*entries)))


def attach_label(df: DataFrame, dictionary: DataFrame, attribute: str, code_column: str, label_column: str) -> DataFrame:
    """Add the label of ``code_column``; null for a code the dictionary does not hold. Spark
    broadcasts the dictionary when its own size statistics show it to be small."""
    side = dictionary.filter(F.col("attribute") == attribute).select(
        F.col("code").alias("_code"), F.col("label").alias(label_column))
    return df.join(side, F.col(code_column) == F.col("_code"), "left").drop("_code")


def unknown_codes(df: DataFrame, dictionary: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """``(attribute, code, n)`` for codes outside the dictionary. ``columns`` maps attribute
    to column. Codes are counted first, so only distinct codes reach the join."""
    attributes = [F.struct(F.lit(a).alias("attribute"), F.col(c).cast("long").alias("code"))
                  for a, c in columns.items()]
    counted = df.select(F.inline(F.array(*attributes))).groupBy("attribute", "code").agg(F.count("*").alias("n"))
    known = dictionary.select("attribute", F.col("code").cast("long").alias("code"))
    return counted.join(known, ["attribute", "code"], "left_anti")


def encode_labels(df: DataFrame, lists: Mapping[str, Sequence[str]], first_code: int = 1, other: int = 0) -> DataFrame:
    """Replace the label in each named column by its code; a label outside the list, or
    none, becomes ``other``. The lists are literals, so this is one projection."""
    def code(column: str, labels: Sequence[str]):
        pairs = [F.lit(v) for i, label in enumerate(labels) for v in (label, i + first_code)]
        return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(f"`{column}`")), F.lit(other))

    return df.withColumns({c: code(c, labels) for c, labels in lists.items()})
