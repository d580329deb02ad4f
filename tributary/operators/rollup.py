"""Two-level aggregations: grandchild -> child -> entity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import ranked


def child_rollup(df: DataFrame, child_key: str, month: str, indicators: list[str]) -> DataFrame:
    """Min, max and count of the month plus the share of each indicator, per child."""
    return df.groupBy(child_key).agg(
        F.min(month).alias(f"{month}_MIN"),
        F.max(month).alias(f"{month}_MAX"),
        F.count(F.lit(1)).alias(f"{month}_SIZE"),
        *[F.avg(c).alias(f"{c}_MEAN") for c in indicators],
    )


def category_share(df: DataFrame, key: str, column: str, values: list[str], prefix: str = "") -> DataFrame:
    """Share of each category among an entity's rows."""
    return df.groupBy(key).agg(
        *[F.avg(F.col(column).eqNullSafe(F.lit(v)).cast("int")).alias(f"{prefix}{column}_{v}_MEAN") for v in values]
    )


def category_share_long(df: DataFrame, key: str, column: str) -> DataFrame:
    """``key, value, share`` of each value that an entity has; needs no vocabulary.

    Two counts by hash, the second over pre-aggregated rows.
    """
    counts = df.groupBy(key, F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("__n"))
    totals = counts.groupBy(key).agg(F.sum("__n").alias("__all"))
    return counts.join(totals, on=key).select(key, "value", (F.col("__n") / F.col("__all")).alias("share"))


def max_then_sum(df: DataFrame, key: str, child_key: str, value: str, out: str) -> DataFrame:
    per_child = df.groupBy(key, child_key).agg(F.max(value).alias("__v"))
    return per_child.groupBy(key).agg(F.coalesce(F.sum("__v"), F.lit(0)).alias(out))


def nonzero_then_mean(df: DataFrame, key: str, child_key: str, value: str, out: str) -> DataFrame:
    """Rows whose value is not zero (missing counts) per child, averaged per entity."""
    hit = (F.col(value).isNull() | (F.col(value) != 0)).cast("int")
    per_child = df.groupBy(key, child_key).agg(F.sum(hit).alias("__v"))
    return per_child.groupBy(key).agg(F.avg("__v").alias(out))


def missed_payment_pct(df: DataFrame, key: str, due: str, paid: str, out: str) -> DataFrame:
    """Percent of all rows where less than the minimum was paid."""
    missed = F.when(F.col(paid) < F.col(due), F.lit(1)).otherwise(F.lit(0))
    return df.groupBy(key).agg((F.lit(100.0) * F.sum(missed) / F.count(F.lit(1))).alias(out))


def trend_slope(df: DataFrame, key: str, order: str, tie_break: str, value: str, out: str) -> DataFrame:
    """Slope of the degree-1 fit of position (0..n-1 in time order) on value, per entity; order keys may be timestamps or names."""
    placed = ranked(df.select(key, order, tie_break, value), [key], order, tie_break, "__pos")
    return placed.groupBy(key).agg(F.regr_slope(F.col("__pos").cast("double"), F.col(value)).alias(out))
