"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", app: str = "tributary", partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where nothing is named, a folder under ``spark.sql.warehouse.dir``, which executors share
    like any table.  Spark's own checkpoints go there too.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints"
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def materialize(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Iterative work (tree fitting) starts from this table, so a lost executor
    re-reads files instead of recomputing joins, and nondeterministic upstream
    expressions are evaluated exactly once.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tributary/{label}-{uuid.uuid4().hex}"
    writer = df.write.mode("error")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def map_batches(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with a function of this package; workers that share its folder can import it, other clusters ship it with --py-files."""
    environment = df.sparkSession.sparkContext.environment
    root = str(Path(__file__).resolve().parents[1])
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))
    return df.mapInArrow(function, schema)
