"""Logistic regression on categories of more values than the driver should hold weights of.

Spark ML's fit keeps some two dozen vectors of all weights on the driver. Here the weights, and all else that there is one of per
weight, are a table with a row per (feature, slot), and the driver gets sums only. The method is nonlinear conjugate
gradients (Polak and Ribiere's) on steps divided by each slot's own curvature, with a line search on the rows' margins. It starts
from each slot's own log odds, which is the optimum where there is one category.

The intercept stays at the log odds of all rows: every row has one slot of each category, so the weights take up any shift of it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.session import materialise

#: Rows that a slot with one class only is taken to have of the other, where the fit starts.
TINY = 1e-8
#: A slot's longest step, before the line search.
LONGEST = 4.0
LENGTHS = (0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 4.0, 8.0)


def fit(rows: DataFrame, slots: Sequence[str], label: str, weight: str, max_iter: int, tolerance: float) -> tuple[float, DataFrame, list[float]]:
    """The intercept, the weights (feature, slot, weight) of the slots that ``rows`` have, and the mean loss at the start and after
    every step. ``slots`` are columns of whole numbers; ``label`` is 0.0 or 1.0, and both occur."""
    def of(value: float) -> Column:
        return F.sum(F.when(F.col(label) == value, F.col(weight)).otherwise(0.0))

    whole = [F.col(f"`{c}`").cast("long").alias(f"s{i}") for i, c in enumerate(slots)]
    names = [f"s{i}" for i in range(len(slots))]
    cells = materialise(rows.select(*whole, label, weight).groupBy(*names).agg(of(1.0).alias("ones"), of(0.0).alias("zeros")), "wide-rows")
    total = cells.agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros")).head()
    n, intercept = total["ones"] + total["zeros"], math.log(total["ones"] / total["zeros"])

    def by_slot(df: DataFrame, *sums: str) -> DataFrame:
        parts = [F.struct(F.lit(i).alias("feature"), F.col(s).alias("slot"), *sums) for i, s in enumerate(names)]
        return df.select(F.inline(F.array(*parts))).groupBy("feature", "slot").agg(*[F.sum(s).alias(s) for s in sums])

    def summed(df: DataFrame, state: DataFrame, value: str, name: str) -> DataFrame:
        """``df`` with the sum of ``value`` over the slots of each row."""
        terms = []
        for i, s in enumerate(names):
            side = state.where(F.col("feature") == i).select(F.col("slot").alias(s), F.col(value).alias(f"_{s}"))
            df = df.join(side, s)
            terms.append(F.col(f"_{s}"))
        return df.withColumn(name, sum(terms[1:], terms[0])).drop(*[f"_{s}" for s in names])

    def loss(margin: Column) -> Column:
        def soft(x: Column) -> Column:  # log(1 + exp(x))
            return F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))

        return F.sum(F.col("ones") * soft(-margin) + F.col("zeros") * soft(margin)) / F.lit(n)

    def slope(margin: Column) -> Column:
        p = 1.0 / (1.0 + F.exp(-margin))
        return F.sum(F.col("move") * (F.col("zeros") * p - F.col("ones") * (1.0 - p))) / F.lit(n)

    def tried(moved: DataFrame, lengths: Sequence[float]) -> list[tuple[float, float, float]]:
        """(length, loss, slope) of each step length, from one pass."""
        at = [F.col("margin") + F.lit(float(a)) * F.col("move") for a in lengths]
        got = moved.agg(*[loss(m) for m in at], *[slope(m) for m in at]).head()
        return list(zip(lengths, got[:len(at)], got[len(at):], strict=True))

    odds = F.log((F.col("ones") + TINY) / (F.col("zeros") + TINY)) - F.lit(intercept)
    none = F.lit(0.0)
    state = by_slot(cells, "ones", "zeros").select(
        "feature", "slot", (odds / len(slots)).alias("weight"), none.alias("move"), none.alias("step"), none.alias("slope"))
    state = materialise(state, "wide-weights")
    margins = materialise(summed(cells, state, "weight", "margin").withColumn("margin", F.col("margin") + F.lit(intercept)), "wide-margins")
    history = [margins.agg(loss(F.col("margin"))).head()[0]]
    plain = True  # the next direction does without the last one
    while len(history) <= max_iter:
        p = 1.0 / (1.0 + F.exp(-F.col("margin")))
        pulls = by_slot(margins.withColumn("pull", F.col("zeros") * p - F.col("ones") * (1.0 - p)).withColumn(
            "curve", (F.col("ones") + F.col("zeros")) * p * (1.0 - p)), "pull", "curve")
        step = F.greatest(F.lit(-LONGEST), F.least(F.lit(LONGEST), F.col("pull") / F.greatest("curve", F.lit(1e-12))))
        now = materialise(state.select("feature", "slot", "weight", "move", F.col("step").alias("last_step"), F.col("slope").alias("last_slope"))
                          .join(pulls, ["feature", "slot"]).withColumn("step", step), "wide-step")
        at = now.agg(*[F.sum(F.col(a) * F.col(b)) for a, b in (
            ("pull", "step"), ("pull", "last_step"), ("last_slope", "last_step"), ("pull", "move"))]).head()
        beta = 0.0 if plain or at[2] <= 0 else max(0.0, (at[0] - at[1]) / at[2])
        if beta * at[3] >= at[0]:  # uphill
            beta = 0.0
        if at[0] <= 1e-15 * n:
            break
        state = now.select("feature", "slot", "weight", (F.lit(beta) * F.col("move") - F.col("step")).alias("move"), "step", F.col("pull").alias("slope"))
        moved = materialise(summed(margins, state, "move", "move"), "wide-moves")
        found = tried(moved, LENGTHS)
        low = max((x for x in found if x[2] < 0), default=(0.0, history[-1], (beta * at[3] - at[0]) / n))
        high = min((x for x in found if x[2] >= 0), default=None)
        if high is not None:
            between = low[0] + (high[0] - low[0]) * (0.5 if high[2] == low[2] else low[2] / (low[2] - high[2]))
            finer = [low[0] + (high[0] - low[0]) * x for x in ((1 / 256, 1 / 64, 1 / 16, 1 / 4, 1 / 2) if low[0] == 0 else (1 / 4, 1 / 2, 3 / 4))]
            found += tried(moved, [between, *finer])
        length, best, _ = min(found, key=lambda x: x[1])
        if best >= history[-1]:
            length, best = 0.0, history[-1]
        state = state.withColumn("weight", F.col("weight") + F.lit(float(length)) * F.col("move"))
        margins = moved.withColumn("margin", F.col("margin") + F.lit(float(length)) * F.col("move")).drop("move")
        gain, was_plain = history[-1] - best, beta == 0.0
        history.append(best)
        plain = gain <= tolerance * best
        if plain and was_plain:
            break
    return intercept, materialise(state.select("feature", "slot", "weight"), "wide-weights"), history
