"""Importance tables: ``(feature, fold, importance)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mean_importance(importance: DataFrame) -> DataFrame:
    return importance.groupBy("feature").agg(F.avg("importance").alias("importance"))


def top_features(importance: DataFrame, top: int = 40) -> DataFrame:
    """Per-fold rows of the ``top`` features by mean importance (names break ties)."""
    best = (
        mean_importance(importance)
        .orderBy(F.col("importance").desc(), F.col("feature"))
        .limit(top)
        .select("feature")
    )
    return importance.join(best, on="feature", how="left_semi")


def above_threshold(importance: DataFrame, threshold: float = 10.0) -> DataFrame:
    return mean_importance(importance).where(F.col("importance") > threshold)


def to_wide(importance: DataFrame, folds: int) -> DataFrame:
    """``(f, fold0, fold1, ...)``, the file layout of the selection step."""
    return (
        importance.groupBy(F.col("feature").alias("f"))
        .pivot("fold", list(range(folds)))
        .agg(F.first("importance"))
        .select("f", *[F.col(str(i)).alias(f"fold{i}") for i in range(folds)])
    )


def to_long(wide: DataFrame, run: str) -> DataFrame:
    folds = [c for c in wide.columns if c.startswith("fold")]
    return wide.select(
        F.lit(run).alias("run"),
        F.col("f").alias("feature"),
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(int(c[4:])).alias("fold"), F.col(c).cast("double").alias("importance")
                    )
                    for c in folds
                ]
            )
        ),
    )


def split_counts(nodes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """How often each feature splits, per fold (and further columns)."""
    return (
        nodes.where(F.col("feature").isNotNull())
        .groupBy("feature", "fold", *by)
        .agg(F.count(F.lit(1)).cast("double").alias("importance"))
    )
