"""Target encoding with a fixed label order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.functions.casts import missing_to_null, strip


def is_labelled(target: Column) -> Column:
    return F.coalesce(missing_to_null(target.cast("string")).isNotNull(), F.lit(False))


def label_index(target: Column, label_order: Sequence[str], unknown: str = "null") -> Column:
    """Position of the label in ``label_order``.

    ``unknown`` says what a null or foreign label becomes: ``null``, one index past the
    last label (``keep``), or a failed job (``error``).
    """
    position = F.coalesce(*[F.when(target == v, F.lit(float(i))) for i, v in enumerate(label_order)])
    if unknown == "null":
        return position
    if unknown == "keep":
        return F.coalesce(position, F.lit(float(len(label_order))))
    if unknown == "error":
        message = F.concat(F.lit("unknown label: "), F.coalesce(target.cast("string"), F.lit("null")))
        return F.coalesce(position, F.raise_error(message).cast("double"))
    raise ValueError("unknown is 'null', 'keep' or 'error'")


def binary_label(target: Column, positive: str, negative: str) -> Column:
    """1.0 for the positive label, 0.0 for the negative one, null for every other value,
    so that an unlabelled row never counts as negative."""
    text = strip(target)
    return F.when(text == positive, F.lit(1.0)).when(text == negative, F.lit(0.0))


def recode(index: Column, positive_index: float) -> Column:
    """1.0 where the index is the positive one, 0.0 for any other index, null for null."""
    return F.when(index.isNull(), F.lit(None).cast("double")).when(index == positive_index, F.lit(1.0)).otherwise(0.0)
