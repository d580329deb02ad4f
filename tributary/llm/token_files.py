"""Token ids as Parquet lists: dictionary-coded ids, delta-coded metadata, small row groups and pages with indexes.

One row per document, in ascending id order over the files: ``shard, seq`` (file and place in it), the document's id,
``n_tokens``, ``shard_start`` (ids before it in its shard) and ``ids``. Because rows are sorted, row-group and page
statistics let a reader fetch the ids of some documents, and the metadata columns can be read without any id.

Nulls: a null text has only the end id; null ids come first. Rows with equal ids are ordered by text. An empty table gives no files with rows.
Very long texts are one row each. Other columns of the input are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .arrow import map_arrow, text_steps
from .bpe import UNSPACED, encoder, lists


@dataclass(frozen=True)
class Layout:
    """Sizes of the format. A page index entry covers one page, so small pages make reads selective."""

    row_group_bytes: int = 16 << 20
    page_bytes: int = 64 << 10
    dictionary_bytes: int = 1 << 20

    def options(self, id_col: str) -> dict[str, str]:
        return {
            "parquet.block.size": str(self.row_group_bytes),
            "parquet.page.size": str(self.page_bytes),
            "parquet.dictionary.page.size": str(self.dictionary_bytes),
            "parquet.writer.version": "v2",
            "parquet.enable.dictionary": "true",
            **{f"parquet.enable.dictionary#{c}": "false" for c in (id_col, "seq", "n_tokens", "shard_start")},
            "compression": "zstd",
        }


def write_tokens(df: DataFrame, path: str, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, layout: Layout = Layout()) -> None:
    """Encode every whole text, append ``end_id`` and write the files under ``path`` in ascending id order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, shard, seq, start = encoder(tokenizer_file, UNSPACED), TaskContext.get().partitionId(), 0, 0
        for step in text_steps(batches, "text"):
            flat, counts = bpe.encode(pa.compute.ascii_lower(pa.compute.fill_null(step.column("text"), "")))
            flat = np.insert(flat, np.cumsum(counts), end_id)
            counts = counts + 1
            n = len(counts)
            upto = start + np.cumsum(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, shard, np.int32)), pa.array(np.arange(seq, seq + n)), step.column("id"), pa.array(counts), pa.array(upto - counts), lists(flat, counts, pa.int32())],
                ["shard", "seq", "id", "n_tokens", "shard_start", "ids"],
            )
            seq, start = seq + n, int(upto[-1])

    kind = df.schema[id_col].dataType.simpleString()
    source = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    ordered = source.repartitionByRange("id").sortWithinPartitions(F.col("id").asc_nulls_first(), "text")
    coded = map_arrow(ordered, run, f"shard int, seq bigint, id {kind}, n_tokens bigint, shard_start bigint, ids array<int>")
    coded.withColumnRenamed("id", id_col).write.options(**layout.options(id_col)).parquet(path)


def read_metadata(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """``shard, seq, id_col, start, n_tokens``; ``start`` counts the ids of all documents before. No id list is read.

    The only rows that meet in one task are one total per shard.
    """
    rows = spark.read.parquet(path).select("shard", "seq", id_col, "n_tokens", "shard_start")
    totals = rows.groupBy("shard").agg(F.sum("n_tokens").alias("tokens"))
    before = totals.select("shard", (F.sum("tokens").over(Window.orderBy("shard")) - F.col("tokens")).alias("before"))
    return rows.join(before, "shard").select("shard", "seq", id_col, (F.col("before") + F.col("shard_start")).alias("start"), "n_tokens")


def read_tokens(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """Rows of the files with their ids; a condition on the id column reaches row groups and pages."""
    rows = spark.read.parquet(path)
    return rows if where is None else rows.where(where)


def id_checksums(tokens: DataFrame, name: str = "ids_crc32") -> DataFrame:
    """``shard, seq`` and the unsigned CRC-32 of each list as little-endian 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column("ids")
            flat = held.values.to_numpy().astype("<u4").view(np.uint8)
            bounds = held.offsets.to_numpy().astype(np.int64) * 4
            sums = [zlib.crc32(flat[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("shard"), batch.column("seq"), pa.array(sums, pa.int64())], ["shard", "seq", name])

    return map_arrow(tokens.select("shard", "seq", "ids"), run, f"shard int, seq bigint, `{name}` bigint")
