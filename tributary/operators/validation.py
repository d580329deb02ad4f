"""Fold assignment and exact AUC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ratios import ratio
from .ordered import ranked, running_total


def _digest(key: Column | str, seed: int) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}_"), key.cast("string")))


def hash_order(key: Column | str, seed: int) -> Column:
    """A shuffled order: 52 bits of md5, exact as a double and portable across engines."""
    return F.conv(F.substring(_digest(key, seed), 1, 13), 16, 10).cast("bigint")


def hash_fold(key: Column | str, folds: int, seed: int) -> Column:
    """Fold of a row from its key alone: no shuffle, stable under retries and appends."""
    return (F.conv(F.substring(_digest(key, seed), 1, 8), 16, 10).cast("bigint") % folds).cast("int")


def exact_folds(df: DataFrame, key: str, folds: int, seed: int, stratify: str | None = None, out: str = "fold") -> DataFrame:
    """Folds whose sizes differ by at most one (per class when stratified); keys of any type."""
    mixed = df.withColumn("__h", hash_order(key, seed))
    placed = ranked(mixed, [stratify] if stratify else [], "__h", key, "__r")
    return placed.withColumn(out, (F.col("__r") % folds).cast("int")).drop("__h", "__r")


def auc(df: DataFrame, label: str, score: str, by: list[str] | None = None, out: str = "auc") -> DataFrame:
    """Area under the ROC curve with ties counted half; NULL with a single class.

    Rows collapse to counts per distinct score before anything is ordered.
    """
    by = by or []
    rows = df.where(F.col(label).isNotNull() & F.col(score).isNotNull()).select(
        *by,
        F.col(label).cast("bigint").alias("__p"),
        (1 - F.col(label)).cast("bigint").alias("__n"),
        F.col(score).cast("double").alias("__score"),
    )
    counts = rows.groupBy(*by, "__score").agg(F.sum("__p").alias("__p"), F.sum("__n").alias("__n"))
    ranked = running_total(counts, by, "__score", "__n", out="__below", source=rows)
    area = F.sum(F.col("__p") * (F.col("__below") + F.col("__n") / 2.0))
    pairs = F.sum("__p").cast("double") * F.sum("__n").cast("double")
    grouped = ranked.groupBy(*by) if by else ranked
    return grouped.agg(
        F.sum(F.col("__p") + F.col("__n")).alias("rows"), ratio(area, pairs).alias(out)
    )
