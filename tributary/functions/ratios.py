"""Row-wise ratios, logs and payment features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .nulls import _c


def ratio(num: Column | str, den: Column | str) -> Column:
    """``num / den`` in doubles; NULL where the denominator is zero.

    A guard rather than ``try_divide``, which raises and catches per zero row.
    """
    den = _c(den).cast("double")
    return F.when(den != 0, _c(num).cast("double") / den)


def product(*cols: Column | str) -> Column:
    out = _c(cols[0])
    for c in cols[1:]:
        out = out * _c(c)
    return out


def safe_log10(col: Column | str) -> Column:
    """``log10``; NULL for non-positive input."""
    return F.log10(_c(col))


def global_value(df: DataFrame, expr: Column) -> Column:
    """A one-row aggregate of ``df`` as a scalar subquery.

    Spark runs it once, merges sibling subqueries over the same table into one
    scan, and hands tasks a constant: no join and no driver round trip.
    """
    return df.agg(expr.alias("v")).scalar()


def shifted(fitted: DataFrame, col: str) -> Column:
    """``x + |min(x)|`` with the minimum over the rows of ``fitted``."""
    return F.col(col) + F.abs(global_value(fitted, F.min(col)))


def shifted_ratio(fitted: DataFrame, num: str, den: str) -> Column:
    """``num / (den + |min(den)|)``; NULL on the row that holds a negative minimum."""
    return ratio(num, shifted(fitted, den))


def positive_part(col: Column) -> Column:
    """``max(x, 0)`` with missing treated as 0."""
    return F.when(col > 0, col).otherwise(F.lit(0))


def payment_features(due_day: str, paid_day: str, due: str, paid: str) -> dict[str, Column]:
    """Paid share, shortfall, days past due and days before due."""
    late = F.col(paid_day) - F.col(due_day)
    return {
        "PAYMENT_PERC": ratio(paid, due),
        "PAYMENT_DIFF": F.col(due) - F.col(paid),
        "DPD": positive_part(late),
        "DBD": positive_part(-late),
    }
