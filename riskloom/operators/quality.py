"""Audits: nulls, class counts, moments, category sizes, rows a model cannot take."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.casts import usable_number
from riskloom.functions.labels import is_labelled


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def null_audit(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row with the null count of every column."""
    return df.agg(*[F.count_if(_quoted(c).isNull()).alias(c) for c in columns or df.columns])


def null_audit_long(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    counts = null_audit(df, columns)
    return counts.unpivot([], [_quoted(c) for c in counts.columns], "variable", "n_null")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def class_distribution(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def class_distribution_stages(stages: Mapping[str, DataFrame], column: str) -> DataFrame:
    """Class counts of several stages of one table, told apart by ``stage``."""
    counted = [class_distribution(df, column).withColumn("stage", F.lit(name)) for name, df in stages.items()]
    return reduce(DataFrame.unionByName, counted)


def labelled_exists(df: DataFrame, target: str) -> DataFrame:
    return df.agg(F.coalesce(F.max(is_labelled(F.col(target))), F.lit(False)).alias("any_labelled"))


def column_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and sample deviation, one row per column."""
    stats = [f(F.col(c)).alias(f"{i}_{k}") for i, c in enumerate(columns)
             for k, f in (("mean", F.avg), ("dev", F.stddev_samp))]
    rows = [F.struct(F.lit(c).alias("variable"), F.col(f"{i}_mean").alias("mean"), F.col(f"{i}_dev").alias("deviation"))
            for i, c in enumerate(columns)]
    return df.agg(*stats).select(F.inline(F.array(*rows)))


def category_sizes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Highest code + 1 of every category column, one row."""
    return df.agg(*[(F.max(c) + 1).cast("long").alias(c) for c in columns])


def quarantined(df: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """The rows a model cannot score, with the names of the columns at fault."""
    faults = F.array_compact(F.array(*[F.when(~usable_number(F.col(c)), F.lit(c)) for c in numeric]))
    return df.withColumn("faults", faults).filter(F.size("faults") > 0)


def category_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null and negative codes per category column: the values the unknown slot takes."""
    stats = [f.alias(f"{i}_{k}") for i, c in enumerate(columns)
             for k, f in (("null", F.count_if(F.col(c).isNull())), ("neg", F.count_if(F.col(c) < 0)))]
    rows = [F.struct(F.lit(c).alias("variable"), F.col(f"{i}_null").alias("n_null"), F.col(f"{i}_neg").alias("n_negative"))
            for i, c in enumerate(columns)]
    return df.agg(*stats).select(F.inline(F.array(*rows)))
