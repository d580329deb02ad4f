"""The supplied parquet tables and the roles they play."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.recency import day_offset

# The day the histories are looked back from.
ORDER_ANCHOR = "2001-08-02"
EVENT_ANCHOR = "2024-01-31"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a credit history: one offset in days per row."""
    return table(spark, sf_dir, "orders").withColumn("DAYS_CREDIT", day_offset("o_orderdate", ORDER_ANCHOR))


def line_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order's customer, price and dates."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_totalprice", "o_orderdate"
    )
    joined = lines.join(orders, on="l_orderkey")
    return joined.withColumns(
        {
            "DAYS_INSTALMENT": day_offset("o_orderdate", ORDER_ANCHOR) + 30,
            "DAYS_ENTRY_PAYMENT": day_offset("l_shipdate", ORDER_ANCHOR),
            "AMT_INSTALMENT": F.col("l_extendedprice"),
            "AMT_PAYMENT": F.col("l_extendedprice") * (1 - F.col("l_discount")),
        }
    )


def event_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("DAYS_EVENT", day_offset("ts", EVENT_ANCHOR))


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a label where one exists; the others are the test rows."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("TARGET"))
    return table(spark, sf_dir, "documents").join(labels, on="doc_id", how="left")
