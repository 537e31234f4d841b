"""Feature screening: chi-square independence and Spearman rank correlation."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, FloatType, IntegralType

from riskloom.functions.casts import usable_numbers
from riskloom.functions.chi_square import chi_square_tail
from riskloom.operators.ranking import running_totals
from riskloom.session import materialise

#: A value that this share of the rows has, one in so many, gets its rank from a broadcast: there are no more such values per column.
HOT_SHARES = 1_000
_CATEGORY = ("_feature", "_whole", "_real", "_text")


def _cell(df: DataFrame, position: int, feature: str) -> Column:
    """One category of one feature, in the column of its kind: counting whole numbers and
    reals as they are spares a conversion to text for every row."""
    kind = df.schema[feature].dataType
    value = F.col(feature)
    whole = value.cast("long") if isinstance(kind, (IntegralType, BooleanType)) else F.lit(None).cast("long")
    real = value.cast("double") if isinstance(kind, (FloatType, DoubleType)) else F.lit(None).cast("double")
    other = not isinstance(kind, (IntegralType, BooleanType, FloatType, DoubleType))
    text = value.cast("string") if other else F.lit(None).cast("string")
    return F.struct(F.lit(position).alias("_feature"), whole.alias("_whole"), real.alias("_real"), text.alias("_text"))


def _category() -> Column:
    return F.coalesce(F.col("_text"), F.col("_whole").cast("string"), F.col("_real").cast("string"))


def _cells(df: DataFrame, features: Sequence[str], label: Column) -> DataFrame:
    """One row per (feature, category, label) that occurs, with its count: the table is read once, and counts are
    combined before the shuffle. Rows with a null label or category are left out."""
    each = F.array(*[_cell(df, i, f) for i, f in enumerate(features)])
    filled = F.col("_text").isNotNull() | F.col("_whole").isNotNull() | F.col("_real").isNotNull()
    return (df.select(label.alias("_label"), F.inline(each)).filter(F.col("_label").isNotNull() & filled)
            .groupBy(*_CATEGORY, "_label").agg(F.count("*").alias("n")))


def contingency_cells(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """``(variable, category, label, n)``: the cells of the contingency tables that are not empty, whatever the number of labels."""
    names = F.array(*[F.lit(f) for f in features])
    return _cells(df, features, F.col(label)).select(
        F.get(names, F.col("_feature")).alias("variable"), _category().alias("category"), F.col("_label").alias("label"), "n")


def contingency(df: DataFrame, features: Sequence[str], label: str, labels: Sequence | None = None) -> DataFrame:
    """The same with a column per label: one row per (variable, category) with a count per label in ``n_0``, ``n_1``, ...

    For a target of a few classes; without ``labels`` they are looked up, in ascending order.
    """
    if labels is None:
        labels = sorted(row[0] for row in df.select(label).distinct().filter(F.col(label).isNotNull()).collect())
    position = F.coalesce(*[F.when(F.col(label) == v, F.lit(i)) for i, v in enumerate(labels)])
    names = F.array(*[F.lit(f) for f in features])
    counts = [F.sum(F.when(F.col("_label") == i, F.col("n")).otherwise(0)).alias(f"n_{i}") for i in range(len(labels))]
    return _cells(df, features, position).groupBy(*_CATEGORY).agg(*counts).select(
        F.get(names, F.col("_feature")).alias("variable"), _category().alias("category"), *[f"n_{i}" for i in range(len(labels))])


def chi_square_stat(df: DataFrame, features: Sequence[str], label: str, labels: Sequence | None = None) -> DataFrame:
    """``(variable, statistic, dof)`` of Pearson's test of independence.

    The cells o that occur are compared with what the margins expect, e, by (o - e)^2 / e, which loses no
    digits in large tables as the sum of squares less N would. A cell that does not occur adds e, and all of these
    together are N less the e of the cells that do: that difference is taken in whole numbers. So only
    cells that occur are held, and neither labels nor categories are listed or limited. With ``labels`` only these count.
    """
    value = F.col(label)
    cells = _cells(df, features, value if labels is None else F.when(value.isin(*labels), value))
    alike = Window.partitionBy(*_CATEGORY)
    rows = cells.withColumn("_row", F.sum("n").over(alike)).withColumn(
        "_first", (F.row_number().over(alike.orderBy("_label")) == 1).cast("long"))
    columns = cells.groupBy("_feature", "_label").agg(F.sum("n").alias("_column"))
    totals = columns.groupBy("_feature").agg(F.sum("_column").alias("_all"), F.count("*").alias("_labels"))
    margins = columns.join(totals, "_feature")
    whole = "decimal(18,0)"
    expected = F.col("_row").cast("double") * F.col("_column") / F.col("_all")
    off = F.col("n") - expected
    sums = rows.join(margins, ["_feature", "_label"]).groupBy("_feature").agg(
        F.sum(off * off / expected).alias("_occurring"), F.sum(F.col("_row").cast(whole) * F.col("_column").cast(whole)).alias("_mass"),
        F.sum("_first").alias("_categories"), F.max("_all").alias("_all"), F.max("_labels").alias("_labels"))
    absent = (F.col("_all").cast(whole) * F.col("_all").cast(whole) - F.col("_mass")).cast("double") / F.col("_all")
    names = F.array(*[F.lit(f) for f in features])
    return sums.select(F.get(names, F.col("_feature")).alias("variable"), (F.col("_occurring") + absent).alias("statistic"),
                       ((F.col("_categories") - 1) * (F.col("_labels") - 1)).alias("dof"))


def chi_square_screen(df: DataFrame, features: Sequence[str], label: str, labels: Sequence | None = None) -> DataFrame:
    """The test with its p-value to five places, least likely under independence first."""
    tested = chi_square_stat(df, features, label, labels)
    return tested.withColumn("p_value", F.round(chi_square_tail(F.col("statistic"), F.col("dof")), 5)).orderBy("p_value", "variable")


def screen_by_chi_square(
    df: DataFrame, features: Sequence[str], label: str, alpha: float = 0.05, labels: Sequence | None = None
) -> DataFrame:
    """``(variable, p_value, keep)``: a feature whose p-value reaches ``alpha`` is dropped."""
    tested = chi_square_screen(df, features, label, labels)
    return tested.select("variable", "p_value", (F.col("p_value") < alpha).alias("keep"))


def average_ranks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(variable, value, n, rank)``: the mean rank of every distinct value of each column;
    ``variable`` is the column's position in ``columns``."""
    cells = F.array(*[F.struct(F.lit(i).alias("variable"), F.col(c).alias("value")) for i, c in enumerate(columns)])
    counts = df.select(F.inline(cells)).groupBy("variable", "value").agg(F.count("*").alias("n"))
    ranked = running_totals(counts, "variable", "value", ["n"])
    return ranked.select("variable", "value", "n", (F.col("n_before") + (F.col("n") + 1) / 2).alias("rank"))


def _with_ranks(rows: DataFrame, ranks: DataFrame, columns: Sequence[str], hot: int) -> DataFrame:
    """``_0``, ``_1``, ...: the ranks of every row's values, a row per ``_id``.

    Values that ``hot`` rows have get their ranks from a broadcast of those few, without a shuffle, so a value that a third of the
    rows has fills no task. All other cells of all columns go through one join by (column, value), and what it finds
    comes back to its row by one aggregate, whatever the number of columns.
    """
    frequent, seldom = ranks.filter(F.col("n") >= hot), ranks.filter(F.col("n") < hot)
    known = rows
    for i, c in enumerate(columns):  # at most HOT_SHARES values of a column
        side = frequent.filter(F.col("variable") == i).select(F.col("value").alias(c), F.col("rank").alias(f"_{i}"))
        known = known.join(F.broadcast(side), c, "left")
    if seldom.isEmpty():
        return known.select("_id", *[f"_{i}" for i in range(len(columns))])
    cells = F.array(*[F.when(F.col(f"_{i}").isNull(), F.struct(F.lit(i).alias("variable"), F.col(c).alias("value"))) for i, c in enumerate(columns)])
    asked = known.select("_id", F.inline(F.filter(cells, lambda x: x.isNotNull())))
    found = asked.join(seldom.select("variable", "value", "rank"), ["variable", "value"]).select(
        "_id", *[F.when(F.col("variable") == i, F.col("rank")).alias(f"_{i}") for i in range(len(columns))])
    both = known.select("_id", *[f"_{i}" for i in range(len(columns))]).unionByName(found)
    return both.groupBy("_id").agg(*[F.max(f"_{i}").alias(f"_{i}") for i in range(len(columns))])


def spearman_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature_x, feature_y, rho)`` for every ordered pair of columns, ties given their
    mean rank, over the rows where all columns hold a usable number.

    The usable rows are written once, numbered. Ranks come from the counts of the distinct values of all columns
    together; the rows then need a lookup and one pass that sums the products of ranks.
    """
    columns = list(columns)
    numbers = df.select(*[(F.col(c).cast("double") + 0.0).alias(f"_c{i}") for i, c in enumerate(columns)])  # -0.0 becomes 0.0
    named = [f"_c{i}" for i in range(len(columns))]
    numbers = numbers.filter(usable_numbers([F.col(c) for c in named])).withColumn("_id", F.monotonically_increasing_id())
    numbers = materialise(numbers, "ranked-rows")
    ranks = materialise(average_ranks(numbers, named), "ranks")
    total = ranks.filter(F.col("variable") == 0).agg(F.sum("n")).head()[0] or 0
    hot = max(2, math.ceil(total / HOT_SHARES))
    off = [F.col(f"_{i}") - F.lit((total + 1) / 2) for i in range(len(columns))]
    pairs = list(combinations_with_replacement(range(len(columns)), 2))
    sums = _with_ranks(numbers, ranks, named, hot).agg(*[F.sum(off[i] * off[j]).alias(f"{i}_{j}") for i, j in pairs])

    def rho(i: int, j: int) -> Column:
        i, j = sorted((i, j))
        if i == j:
            return F.when(F.col(f"{i}_{i}") > 0, F.lit(1.0))
        spread = F.sqrt(F.col(f"{i}_{i}")) * F.sqrt(F.col(f"{j}_{j}"))
        return F.when(spread > 0, F.col(f"{i}_{j}") / spread)

    cells = [F.struct(F.lit(x).alias("feature_x"), F.lit(y).alias("feature_y"), rho(i, j).alias("rho"))
             for i, x in enumerate(columns) for j, y in enumerate(columns)]
    return sums.select(F.inline(F.array(*cells)))


def screen_by_correlation(
    df: DataFrame, features: Sequence[str], target: str, weak: float = 0.05, strong: float = 0.7
) -> DataFrame:
    """``(variable, r_target, redundant_with, keep)``.

    A feature is dropped when its correlation with the target is below ``weak``, or when a
    kept feature, more strongly tied to the target, correlates with it above ``strong``.
    The rank matrix is the distributed work; the choice runs on its d x d cells.
    """
    matrix = spearman_matrix(df, [*features, target]).collect()
    rho = {(r["feature_x"], r["feature_y"]): r["rho"] for r in matrix}

    def size(x: str, y: str) -> float:
        return abs(rho[x, y] or 0.0)

    kept: list[str] = []
    rows = []
    for f in sorted(features, key=lambda f: (-size(f, target), f)):
        rival = next((k for k in kept if size(f, k) > strong), None)
        keep = size(f, target) >= weak and rival is None
        rows.append((f, rho[f, target], rival, keep))
        if keep:
            kept.append(f)
    return df.sparkSession.createDataFrame(rows, "variable string, r_target double, redundant_with string, keep boolean")


def keep_screened(df: DataFrame, decisions: DataFrame) -> DataFrame:
    """Drop the columns a screening turned down; there is one decision row per feature."""
    dropped = [r["variable"] for r in decisions.filter(~F.col("keep")).select("variable").collect()]
    return df.drop(*dropped)
