"""CSV scans, zipped archives and small metadata files."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.nulls import nan_to_null

_BATCH = 50_000
# Fields that mean a missing value, in plain and in zipped CSV alike.
MISSING = ["", "NaN", "nan", "NA", "null"]


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType | None = None, rows: int | None = None) -> DataFrame:
    """CSV with a header; empty fields and those of ``MISSING`` become NULL in every column.

    With a schema the scan is lazy and pruned; without one Spark infers types in
    an extra pass.  ``rows`` is the debugging cap.
    """
    if path.endswith(".zip"):
        raise ValueError("Spark reads .zip as plain text: stage the archive first with stage_zip")
    reader = spark.read.option("header", True).option("nanValue", "nan")
    if schema is None:
        df = reader.option("inferSchema", True).csv(path)
    else:
        df = reader.option("enforceSchema", False).schema(schema).csv(path)
    df = nan_to_null(df)
    text = [c for c, t in df.dtypes if t == "string"]
    df = df.withColumns({c: F.when(~F.col(f"`{c}`").isin(MISSING), F.col(f"`{c}`")) for c in text}) if text else df
    return df.limit(rows) if rows else df


def stage_zip(spark: SparkSession, archives: str | list[str], schema: str | T.StructType, out: str) -> DataFrame:
    """Unpack zipped CSVs into Parquet once; later jobs scan the Parquet.

    A zip cannot be split, so there is one task per archive, but rows leave it in
    batches: an unpacked file is never held whole.
    """
    target = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = target.fieldNames()
    text = ", ".join(f"`{n}` string" for n in names)

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for member in archive.namelist():
                        if not member.endswith(".csv"):
                            continue
                        with archive.open(member) as stream:
                            chunks = pd.read_csv(
                                stream, dtype=str, chunksize=_BATCH, keep_default_na=False
                            )
                            for chunk in chunks:
                                yield chunk.reindex(columns=names).astype(object)

    files = spark.read.format("binaryFile").load(archives).select("content")
    rows = files.mapInPandas(unpack, text)
    typed = rows.select(
        *[
            F.when(F.col(f.name).isin(MISSING), F.lit(None)).otherwise(F.col(f.name)).try_cast(f.dataType).alias(f.name)
            for f in target.fields
        ]
    )
    typed.write.mode("error").option("maxRecordsPerFile", 1_000_000).parquet(out)
    return spark.read.schema(target).parquet(out)


def read_names(spark: SparkSession, path: str) -> list[str]:
    """Feature names, one per line: columns of a plan, so they are read when it is made."""
    rows = spark.read.text(path).where(F.trim("value") != "").collect()
    return [r["value"].strip() for r in rows]


def read_importance(spark: SparkSession, path: str) -> DataFrame:
    """Mean importances ``(feature, importance)``."""
    return read_csv(spark, path, "feature string, importance double")


def read_fold_importance(spark: SparkSession, path: str) -> DataFrame:
    """Wide importances ``(f, fold0, ...)``; an unnamed row-number column is dropped."""
    df = read_csv(spark, path)
    return df.select("f", *[F.col(c).cast("double").alias(c) for c in df.columns if c.startswith("fold")])


def read_predictions(spark: SparkSession, paths: list[str], key: str, model: str) -> DataFrame:
    """External scores (train and test files) as ``(key, model, score)``.

    The first column is the key and the last the score, whatever they are called;
    a fold column between them is ignored.
    """
    out = None
    for path in paths:
        df = read_csv(spark, path)
        part = df.select(
            F.col(f"`{df.columns[0]}`").cast("bigint").alias(key),
            F.lit(model).alias("model"),
            F.col(f"`{df.columns[-1]}`").cast("double").alias("score"),
        )
        out = part if out is None else out.unionByName(part)
    return out
