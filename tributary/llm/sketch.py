"""Threshold-scaled document fingerprints; DataFrame functions only.

A document's sketch holds every shingle hash below a fixed fraction of the hash range. The rule looks at one hash at
a time, so the sketch of a union is the union of the sketches, and two sketches of very unequal documents still
estimate how much of the small one lies in the large one. A document none of whose hashes is below the fraction keeps its
smallest hash; ``merge`` drops such a hash again once another document brings one below the fraction.

Shingles are five lower-cased words; fewer words are one shingle; without words the sketch is empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .urls import LOWER, UPPER

SHINGLE_WORDS = 5
FRACTION = 1 / 8
LOWEST = -(1 << 63)


def words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased, parted by blanks and the control characters 9 to 13; null has none."""
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def shingle_hashes(df: DataFrame, text_col: str, name: str, size: int = SHINGLE_WORDS) -> DataFrame:
    """Add ``name``: the 64-bit hash of every shingle in order, repeats included."""
    hashed = df.withColumn(name, F.transform(words(F.col(text_col)), lambda w: F.xxhash64(w)))
    own = F.col(name)
    # Each word is hashed once; a shingle's hash is made of its words' hashes.
    long = F.transform(F.sequence(F.lit(0), F.size(own) - size), lambda i: F.xxhash64(*(own[i + k] for k in range(size))))
    short = F.array(F.xxhash64(own, F.lit("short")))
    return hashed.withColumn(name, F.when(F.size(own) >= size, long).when(F.size(own) > 0, short).otherwise(F.array().cast("array<bigint>")))


def threshold(fraction: float) -> int:
    return LOWEST + int(fraction * (1 << 64)) if fraction < 1 else (1 << 63) - 1


def scaled(hashes: Column, fraction: float = FRACTION) -> Column:
    """Sorted distinct hashes below the fraction, or the smallest hash when none is."""
    low = F.filter(hashes, lambda h: h <= F.lit(threshold(fraction)))
    return F.when(F.size(low) > 0, F.sort_array(F.array_distinct(low))).otherwise(F.when(F.size(hashes) > 0, F.array(F.array_min(hashes))).otherwise(F.array().cast("array<bigint>")))


def merge(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """The sketch of the two documents' shingles taken together."""
    return scaled(F.array_union(a, b), fraction)


def resemblance(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity; two empty sketches are alike, an empty and another are not."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(union, F.lit(1)))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has; an empty sketch is contained in everything."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(F.size(a), F.lit(1)))


def as_text(sketch: Column, fraction: float = FRACTION) -> Column:
    """``<1/fraction>:`` and 16 hexadecimal digits for each hash."""
    return F.concat(F.lit(f"{round(1 / fraction)}:"), F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), ""))


def with_sketch(df: DataFrame, text_col: str, name: str, fraction: float = FRACTION) -> DataFrame:
    return shingle_hashes(df, text_col, name).withColumn(name, scaled(F.col(name), fraction))


def following_ids(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, longest, next_id`` for each distinct id that is not null; after the last comes the first.

    Ids are dealt out by range and written once; each range is then numbered on its own, and the only rows that meet in
    one task are the first ids of the ranges. ``longest`` is the greatest text length of the id in characters.
    """
    ids = df.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(F.length(text_col)).alias("longest"))
    ranged = materialize(ids.repartitionByRange("id").withColumn("part", F.spark_partition_id()), "ids")
    heads = ranged.groupBy("part").agg(F.min("id").alias("head"))
    ends = heads.select("part", F.coalesce(F.lead("head").over(Window.orderBy("part")), F.min("head").over(Window.partitionBy())).alias("head"))
    inner = ranged.withColumn("next_id", F.lead("id").over(Window.partitionBy("part").orderBy("id")))
    return inner.join(ends, "part").select("id", "longest", F.coalesce("next_id", "head").alias("next_id"))


def tail_swapped(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", fraction: float = FRACTION) -> DataFrame:
    """Each text's sketch beside that of an edited copy and of the next document.

    Returns ``id_col, text, sketch, edited, edited_sketch, next_sketch``. The edited text has its last floor(n/4) characters
    replaced by the first as many of the next document (all, if it has fewer), in ascending id order; after
    the last comes the first, and a single document is followed by itself. Null texts are empty. Among rows of one id the
    smallest text stands for the id as a next document. A row without an id has no next document: its tail is cut off
    and ``next_sketch`` is null. The text is shuffled once, with its sketch; only the heads move again.
    A very long text is one row, whose hashes take eight bytes a word. Other columns are not read.
    """
    source = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    sketched = with_sketch(source, "text", "sketch", fraction)
    # Both uses of the rows filter alike, so that Spark deals them out once.
    dealt = sketched.where("id is not null").repartition("id")
    links = following_ids(source, "id", "text")
    heads = (
        dealt.groupBy("id")
        .agg(F.min(F.struct("text", "sketch")).alias("row"))
        .join(links.select(F.col("next_id").alias("id"), F.col("id").alias("of"), F.floor(F.col("longest") / 4).alias("n")), "id")
        .select(F.col("of").alias("id"), F.expr("left(row.text, cast(n as int))").alias("head"), F.col("row.sketch").alias("next_sketch"))
    )
    quarter = F.expr("cast(floor(length(text) / 4) as int)")
    edited = F.concat(F.expr("left(text, length(text) - cast(floor(length(text) / 4) as int))"), F.left(F.coalesce("head", F.lit("")), quarter))
    alone = sketched.where("id is null").select("*", F.lit(None).cast("string").alias("head"), F.lit(None).cast("array<bigint>").alias("next_sketch"))
    pairs = dealt.join(heads, "id", "left").unionByName(alone).withColumn("edited", edited)
    return with_sketch(pairs, "edited", "edited_sketch", fraction).select(F.col("id").alias(id_col), "text", "sketch", "edited", "edited_sketch", "next_sketch")
