"""Null-importance selection: permuted labels, t-test, Bonferroni."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.pvalue import t_two_sided
from ..functions.ratios import ratio
from .ordered import ranked
from .validation import hash_order


def permute_label(df: DataFrame, key: str, label: str, seed: int) -> DataFrame:
    """Seeded permutation of the label over its rows; label counts stay exact. Keys may have any orderable type.

    The row at rank r by key takes the label of the row at rank r by hash.
    """
    rows = ranked(df.where(F.col(label).isNotNull()), [], key, None, "__r")
    mixed = df.where(F.col(label).isNotNull()).select(
        F.col(key).alias("__k"), F.col(label).alias("__y"), hash_order(key, seed).alias("__h")
    )
    donors = ranked(mixed, [], "__h", "__k", "__r").select("__r", "__y")
    columns = [F.col("__y").alias(label) if c == label else F.col(c) for c in df.columns]
    return rows.join(donors, on="__r").select(*columns)


def permute_labels(df: DataFrame, key: str, label: str, seeds: Sequence[int]) -> DataFrame:
    """``key, labels``: for each seed, in order, what ``permute_label`` gives, all from one ordering by key and one by (seed, hash)."""
    known = df.where(F.col(label).isNotNull()).select(F.col(key).alias("__k"), F.col(label).alias("__y"))
    if not seeds:
        return known.select(F.col("__k").alias(key), F.array().cast(f"array<{df.schema[label].dataType.simpleString()}>").alias("labels"))
    hashes = F.array(*[F.struct(F.lit(p).alias("__p"), hash_order("__k", s).alias("__h")) for p, s in enumerate(seeds)])
    mixed = known.select("__k", "__y", F.inline(hashes))
    donors = ranked(mixed, ["__p"], "__h", "__k", "__r")
    labels = F.transform(F.array_sort(F.collect_list(F.struct("__p", "__y"))), lambda e: e["__y"])
    rows = ranked(known, [], "__k", None, "__r")
    return rows.join(donors.groupBy("__r").agg(labels.alias("labels")), on="__r").select(F.col("__k").alias(key), "labels")


def importance_ttest(importance: DataFrame, actual: str = "actual", null: str = "null") -> DataFrame:
    """Pooled two-sample t-test per feature over ``(run, feature, fold, importance)``."""

    def arm(name: str, tag: str):
        x = F.when(F.col("run") == name, F.col("importance"))
        return [F.count(x).alias(f"n_{tag}"), F.avg(x).alias(f"m_{tag}"), F.var_samp(x).alias(f"v_{tag}")]

    stats = importance.groupBy("feature").agg(*arm(actual, "a"), *arm(null, "0"))
    dof = F.col("n_a") + F.col("n_0") - 2
    pooled = ((F.col("n_a") - 1) * F.col("v_a") + (F.col("n_0") - 1) * F.col("v_0")) / F.nullif(dof, F.lit(0))
    t = ratio(
        F.col("m_a") - F.col("m_0"), F.sqrt(pooled * (1 / F.col("n_a") + 1 / F.col("n_0")))
    )
    tested = stats.where((F.col("n_a") > 0) & (F.col("n_0") > 0)).select(
        "feature", t.alias("t"), t_two_sided(t, dof).alias("pvalues"),
        ratio("m_a", "m_0").alias("fc"),
    )
    # Every compared feature counts as a test, also one whose p-value is undefined.
    tests = tested.agg(F.count(F.lit(1))).scalar()
    return tested.select(
        "feature",
        "t",
        "pvalues",
        "fc",
        F.log2(F.when(F.col("fc") > 0, F.col("fc"))).alias("log2fc"),
        (-F.log10(F.col("pvalues"))).alias("log10pvalues"),
        F.when(F.col("pvalues").isNotNull(), F.least(F.lit(1.0), F.col("pvalues") * tests)).alias("padj"),
    )


def select_features(tested: DataFrame, alpha: float = 0.05, require_gain: bool = False) -> DataFrame:
    """Features whose corrected p-value is below ``alpha``.

    The test is two-sided: a feature significantly worse than its null is kept too
    unless ``require_gain`` is set.
    """
    picked = tested.where(F.col("padj") < alpha)
    return picked.where(F.col("t") > 0) if require_gain else picked
