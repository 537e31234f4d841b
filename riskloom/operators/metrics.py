"""Quality of binary predictions, without bringing rows to the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.ranking import running_totals


def classification_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", labels: Sequence[float] = (0.0, 1.0)
) -> DataFrame:
    """``(label, accuracy, precision, recall, f1, support)``, one row per label taken as the
    positive one. A ratio with nothing below the line is 0."""
    y, p = F.col(label), F.col(prediction)
    judged = df.filter(y.isNotNull() & p.isNotNull())
    counts = [F.count("*").alias("n"), F.count_if(y == p).alias("right")]
    for i, v in enumerate(labels):
        counts += [F.count_if((y == v) & (p == v)).alias(f"hit_{i}"),
                   F.count_if(p == v).alias(f"said_{i}"), F.count_if(y == v).alias(f"is_{i}")]

    def ratio(top, bottom):
        return F.when(bottom > 0, top / bottom).otherwise(0.0)

    rows = []
    for i, v in enumerate(labels):
        hit, said, actual = F.col(f"hit_{i}"), F.col(f"said_{i}"), F.col(f"is_{i}")
        rows.append(F.struct(
            F.lit(v).alias("label"),
            ratio(F.col("right"), F.col("n")).alias("accuracy"),
            ratio(hit, said).alias("precision"),
            ratio(hit, actual).alias("recall"),
            ratio(2 * hit, said + actual).alias("f1"),
            actual.alias("support")))
    return judged.agg(*counts).select(F.inline(F.array(*rows)))


def roc_auc(df: DataFrame, score: str, label: str = "label") -> DataFrame:
    """Exact area under the ROC curve, one row ``auc``; null unless both classes occur.

    The area is the share of (positive, negative) pairs the score puts in order, ties
    counted half, and so a sum over the distinct scores.
    """
    counts = (df.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
              .groupBy(F.lit("score").alias("variable"), F.col(score).cast("double").alias("value"))
              .agg(F.count_if(F.col(label) == 1.0).alias("pos"), F.count_if(F.col(label) != 1.0).alias("neg")))
    ranked = running_totals(counts, "variable", "value", ["neg"])
    ordered = F.sum(F.col("pos").cast("double") * (F.col("neg_before") + F.col("neg") / 2))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return ranked.agg(F.when(F.sum("pos") * F.sum("neg").cast("double") > 0, ordered / pairs).alias("auc"))
