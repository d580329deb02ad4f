"""Two-sided Student t p-value as a plain column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def t_two_sided(t: Column, dof: Column) -> Column:
    """P(|T| > |t|) for integer ``dof`` >= 1; NULL if either input is.

    With x = dof / (dof + t^2) the value is the regularized incomplete beta
    I_x(dof/2, 1/2).  For x < 1/2 it is the series
    x^a / B(a,1/2) * sum_j (1/2)_j / j! * x^j / (a + j), whose terms are all
    positive, so far tails keep full relative precision.  Otherwise it is one
    minus the finite trigonometric sum (Abramowitz and Stegun 26.7.3-26.7.4).
    """
    dof = dof.cast("int")
    a = dof / F.lit(2.0)
    x = dof / (dof + t * t)
    odd = dof % 2
    none = F.array().cast("array<int>")
    steps = F.floor((dof - 1) / 2).cast("int")
    # B(a,1/2): from B(1,1/2) = 2 or B(1/2,1/2) = pi, upwards by a/(a + 1/2).
    first = F.when(odd == 1, F.lit(0.5)).otherwise(F.lit(1.0))
    beta = F.aggregate(
        F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(none),
        F.when(odd == 1, F.pi()).otherwise(F.lit(2.0)),
        lambda acc, j: acc * (first + j - 1) / (first + j - F.lit(0.5)),
    )
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(60)),
        F.struct(F.lit(1.0).alias("coef"), (F.lit(1.0) / a).alias("total")),
        lambda acc, j: F.struct(
            (acc["coef"] * (j - F.lit(0.5)) / j * x).alias("coef"),
            (acc["total"] + acc["coef"] * (j - F.lit(0.5)) / j * x / (a + j)).alias("total"),
        ),
        lambda acc: acc["total"],
    )
    tail = F.pow(x, a) / beta * series

    theta = F.atan(F.abs(t) / F.sqrt(dof.cast("double")))
    sin, cos = F.sin(theta), F.cos(theta)
    # Partial sums of cos^2j terms; even dof starts at 1, odd dof at cos.
    more = F.floor((dof - 2) / 2).cast("int")
    start = F.when(odd == 1, cos).otherwise(F.lit(1.0))
    inner = F.aggregate(
        F.when(more > 0, F.sequence(F.lit(1), more)).otherwise(none),
        F.struct(start.alias("term"), start.alias("total")),
        lambda acc, j: F.struct(
            (acc["term"] * cos * cos * (2 * j - 1 + odd) / (2 * j + odd)).alias("term"),
            (acc["total"] + acc["term"] * cos * cos * (2 * j - 1 + odd) / (2 * j + odd)).alias("total"),
        ),
        lambda acc: acc["total"],
    )
    even_area = sin * inner
    odd_area = F.lit(2.0) / F.pi() * (theta + F.when(dof == 1, F.lit(0.0)).otherwise(sin * inner))
    area = F.when(odd == 1, odd_area).otherwise(even_area)
    body = F.greatest(F.lit(1.0) - area, F.lit(0.0))
    return F.when(t.isNull() | dof.isNull(), F.lit(None).cast("double")).when(x < 0.5, tail).otherwise(body)
