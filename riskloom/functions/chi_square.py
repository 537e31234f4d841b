"""Upper tail of the chi-square distribution as a Spark expression."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


SUMMED_DOF = 100_000


def _normal_tail(z: Column) -> Column:
    """P(Z >= z), by the rational approximation of the error function with five terms."""
    t = 1.0 / (1.0 + 0.2316419 * F.abs(z))
    # The published coefficients of the approximation.
    b = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
    poly = t * (b[0] + t * (b[1] + t * (b[2] + t * (b[3] + t * b[4]))))
    upper = F.exp(-z * z / 2.0) / math.sqrt(2 * math.pi) * poly
    return F.when(z >= 0, upper).otherwise(1.0 - upper)


def chi_square_tail(statistic: Column, dof: Column) -> Column:
    """P(X >= statistic) for a chi-square variable with ``dof`` degrees of freedom.

    With h = statistic/2 and a = dof/2 it is 1 minus the sum of h^b e^-h / Gamma(b + 1) over
    b = a, a + 1, ...; each term's logarithm follows from the one before. Good to about
    1e-13 in absolute terms. Far out in the tail the answer is 0 without summing. Beyond
    ``SUMMED_DOF`` degrees of freedom the cube root of statistic / dof is taken as normal, which
    is good to about 1e-7 there.
    """
    half, shape = statistic / 2.0, dof / 2.0
    start = F.when(dof % 2 == 0, 0.0).otherwise(0.5)
    log_gamma = F.when(dof % 2 == 0, 0.0).otherwise(math.log(math.sqrt(math.pi) / 2))  # of start + 1
    steps = F.sequence(F.lit(0), F.least(F.ceil(half + dof + 12 * F.sqrt(half) + 60), F.lit(8 * SUMMED_DOF)).cast("int"))
    first = F.struct((start * F.ln(half) - half - log_gamma).alias("term"), F.lit(0.0).alias("total"))
    below = F.aggregate(
        steps, first,
        lambda acc, i: F.struct(
            (acc["term"] + F.ln(half) - F.ln(start + i + 1.0)).alias("term"),
            (acc["total"] + F.when(start + i >= shape, F.exp(acc["term"])).otherwise(0.0)).alias("total")),
        lambda acc: acc["total"])
    spread = 2.0 / (9.0 * dof)
    many = _normal_tail((F.cbrt(statistic / dof) - (1.0 - spread)) / F.sqrt(spread))
    return (F.when((dof <= 0) | (statistic <= 0), 1.0)
            .when(dof > SUMMED_DOF, many)
            .when(half > shape + 40 * F.sqrt(shape) + 400, 0.0)
            .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1.0 - below))))
