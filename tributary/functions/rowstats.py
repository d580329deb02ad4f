"""Statistics across the columns of one row, missing values skipped.

Each step is its own projection: the planner keeps a shared intermediate (mean,
squared deviation) as one value per row instead of repeating its expression.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ratios import ratio


def _add(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, cols)


def row_sum(cols: list[str]) -> Column:
    return _add([F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols])


def row_count(cols: list[str]) -> Column:
    return _add([F.col(c).isNotNull().cast("int") for c in cols])


def row_mean(cols: list[str]) -> Column:
    return ratio(row_sum(cols), row_count(cols))


def _with_moments(df: DataFrame, cols: list[str], fourth: bool) -> tuple[DataFrame, list[str]]:
    """Adds ``__n``, ``__m2`` (and ``__m4``): count and centred power sums."""
    squares = [f"__e{i}" for i in range(len(cols))]
    centred = df.withColumns({"__n": row_count(cols), "__mu": row_mean(cols)})
    centred = centred.withColumns(
        {e: F.coalesce(F.col(c).cast("double") - F.col("__mu"), F.lit(0.0)) for e, c in zip(squares, cols)}
    )
    centred = centred.withColumns({e: F.col(e) * F.col(e) for e in squares})
    sums = {"__m2": _add([F.col(e) for e in squares])}
    if fourth:
        sums["__m4"] = _add([F.col(e) * F.col(e) for e in squares])
    return centred.withColumns(sums), ["__n", "__mu", *squares, *sums]


def with_row_std(df: DataFrame, cols: list[str], out: str) -> DataFrame:
    """Sample standard deviation; NULL below two values."""
    made, helpers = _with_moments(df, cols, fourth=False)
    n = F.col("__n")
    return made.withColumn(out, F.when(n > 1, F.sqrt(F.col("__m2") / (n - 1)))).drop(*helpers)


def with_row_kurtosis(df: DataFrame, cols: list[str], out: str) -> DataFrame:
    """Bias-corrected excess kurtosis; NULL below four values, 0 without spread."""
    made, helpers = _with_moments(df, cols, fourth=True)
    n, m2, m4 = F.col("__n").cast("double"), F.col("__m2"), F.col("__m4")
    excess = n * m4 / (m2 * m2) - 3.0
    corrected = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * excess + 6.0)
    value = F.when(n < 4, F.lit(None).cast("double")).when(m2 == 0, F.lit(0.0)).otherwise(corrected)
    return made.withColumn(out, value).drop(*helpers)
