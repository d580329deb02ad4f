"""Helpers for Arrow-batched map functions over text columns."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: UTF-8 bytes of text that one step of a map function holds as Python objects.
STEP_BYTES = 2 << 20


def text_steps(batches: Iterator[pa.RecordBatch], text: str, step_bytes: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of about ``step_bytes`` of text, one row at least."""
    for batch in batches:
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0).to_pylist()
        begin = held = 0
        for i, n in enumerate(lengths):
            if i > begin and held + n > step_bytes:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += n
        if begin < batch.num_rows:
            yield batch.slice(begin)


def on_workers(spark: SparkSession) -> None:
    """Let Python workers on machines that share this folder import the package; other clusters ship it with --py-files."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))


def map_arrow(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    on_workers(df.sparkSession)
    return df.mapInArrow(function, schema)


def text_key(text: Column) -> Column:
    """16-byte identity of a text (null counts as empty): the first half of its SHA-256."""
    return F.unhex(F.substring(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256), 1, 32))


def distinct_texts(df: DataFrame, text: str, *weights: Column) -> DataFrame:
    """One row (key, text, copies, ...) per distinct text; copies collapse before the shuffle.

    A text shared by any share of all rows is one row here, so later steps see no hot copy.
    """
    rows = df.select(text_key(F.col(text)).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"), *weights)
    extra = [F.sum(c).alias(c) for c in rows.columns[2:]]
    return rows.groupBy("key").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"), *extra)
