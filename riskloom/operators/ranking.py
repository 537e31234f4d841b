"""Running totals over the distinct values of a column, without a global sort in one task.

Ranks with ties and the area under a ROC curve depend on the data only through the count
of each distinct value. Counting comes first, with partial counts before the shuffle, so a
value held by a third of all rows is one row here. The distinct values are then cut into
equal ranges; each range is summed by itself and shifted by the total of the ranges before
it, of which there are at most ``ranges`` per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import materialise


def running_totals(counts: DataFrame, group: str, value: str, totals: Sequence[str], ranges: int | None = None) -> DataFrame:
    """Add ``<total>_before`` for each total: its sum over the smaller values of the group.

    ``counts`` holds one row per (group, value). The ranges are cut once and written to the
    shared folder, so that a lost executor cannot change the cut half-way.
    """
    spark = counts.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = materialise(
        counts.repartitionByRange(ranges, group, value).withColumn("_range", F.spark_partition_id()), "ranges")

    per_range = cut.groupBy(group, "_range").agg(*[F.sum(t).alias(t) for t in totals])
    earlier = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = per_range.select(group, "_range", *[F.coalesce(F.sum(t).over(earlier), F.lit(0)).alias(f"_{t}_shift") for t in totals])

    smaller = Window.partitionBy(group, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    within = cut.withColumns({f"_{t}_within": F.coalesce(F.sum(t).over(smaller), F.lit(0)) for t in totals})
    joined = within.join(F.broadcast(shifts), [group, "_range"])  # at most ranges rows per group
    return joined.withColumns({f"{t}_before": F.col(f"_{t}_within") + F.col(f"_{t}_shift") for t in totals}).select(
        *counts.columns, *[f"{t}_before" for t in totals])
