"""Small value expressions shared by the operators."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def pair_mean(left: str, right: str) -> Column:
    """Mean of two columns; null when either side is null."""
    return (F.col(left) + F.col(right)) / 2


def percent_text(ratio: Column) -> Column:
    return F.format_string("%.2f%%", ratio * 100)


def vector_element(vector: Column, position: int) -> Column:
    return vector_to_array(vector)[position]


def category_slot(code: Column) -> Column:
    """Slot of an integer category code: code + 1, or the unknown slot 0 for a null or
    negative code, which a one-hot encoder would otherwise refuse."""
    return F.when(code >= 0, code.cast("double") + 1.0).otherwise(0.0)


def split_bucket(*keys: Column) -> Column:
    """Bucket 0..99 from the key alone, the same under any partitioning."""
    text = F.concat_ws("|", *[k.cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % 100
