"""The corpus pipeline over ``documents``: toxicity, near duplicates, repeated passages, packing.

Every stage takes all rows that its predecessor kept and returns the columns of ``documents``, but for the last, which returns
one row for each packed piece. ``n_chars`` follows the text where a stage changes it. Nulls, empty and very long texts, repeated rows,
empty tables and further columns go through as the operators' docstrings state: a null or empty text is
neither toxic, nor a duplicate, nor cut, and is packed as one end mark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import minhash, packing, passages, toxicity
from tributary.session import materialize
from tributary.sources.tables import table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.3 under a model of the labelled rows of ``docs``; the others go."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")), threshold=0.3)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.75 or more over five-word shingles."""
    return minhash.one_of_each(docs, minhash.near_duplicates(docs))


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that a 400-byte string which starts twice covers."""
    cut = passages.without_passages(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document's words, with one end mark, lie in sequences of the permitted lengths."""
    return packing.pack(docs.select("doc_id", packing.word_length().alias("length")))


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", one_of_near_duplicates),
    ("passages", cut_passages),
    ("packing", pack_sequences),
]

#: A learned score and run-length indexes have no SQL form; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
