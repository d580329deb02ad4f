"""Outputs of a run: submission, out-of-fold scores, importances, metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.importance import mean_importance


def write_submission(scores: DataFrame, key: str, path: str, label: str = "TARGET") -> None:
    """``(key, mean score)`` as a CSV directory."""
    scores.groupBy(key).agg(F.avg("score").alias(label)).write.mode("error").option("header", True).csv(path)


def write_oof(oof: DataFrame, path: str) -> None:
    """Scores with key, model and fold, one directory per model."""
    oof.write.mode("error").partitionBy("model").parquet(path)


def write_mean_importance(importance: DataFrame, path: str) -> None:
    mean_importance(importance).write.mode("error").option("header", True).csv(path)


def write_table(df: DataFrame, path: str) -> None:
    """Importance or selection table as CSV with a header."""
    df.write.mode("error").option("header", True).csv(path)


def append_metrics(metrics: DataFrame, path: str) -> None:
    """Append ``(run, model, fold, auc)`` rows to the metric log."""
    metrics.select("run", "model", "fold", F.round("auc", 6).alias("auc")).write.mode("append").parquet(path)
