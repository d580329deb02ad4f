"""Group statistics mapped back to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .ordered import exact_median


def lookup_join(df: DataFrame, lookup: DataFrame, keys: list[str]) -> DataFrame:
    """Left join to a table with one row per key.

    A plain equi-join whatever the sizes: adaptive execution broadcasts a lookup that turns out
    small, and splits the rows of a hot key where it does not.
    """
    return df.join(lookup, on=keys, how="left")


def group_stats(
    df: DataFrame, categories: list[str], values: list[str], source: DataFrame | None = None
) -> DataFrame:
    """Mean and sample std of each value by each category, mapped to every row.

    All categories and values are aggregated in one scan with grouping sets.
    ``source`` supplies the rows to aggregate when they are not those of ``df``.
    """
    source = df if source is None else source
    aggregates = [
        made for v in values for made in (F.avg(v).alias(f"__m_{v}"), F.stddev_samp(v).alias(f"__s_{v}"))
    ]
    stats = source.groupingSets([[c] for c in categories], *categories).agg(
        *aggregates, F.grouping_id().alias("__set")
    )
    out = df
    for i, c in enumerate(categories):
        only = (1 << len(categories)) - 1 - (1 << (len(categories) - 1 - i))
        named = [
            F.col(f"__{tag}_{v}").alias(f"{c}_{v}_f1_{name}") for v in values for tag, name in (("m", "mean"), ("s", "std"))
        ]
        mine = stats.where((F.col("__set") == only) & F.col(c).isNotNull()).select(c, *named)
        out = lookup_join(out, mine, [c])
    return out


def group_median(
    df: DataFrame, category: str, value: str, out: str, source: DataFrame | None = None
) -> DataFrame:
    """Exact median of ``value`` by category mapped to every row."""
    source = df if source is None else source
    found = exact_median(source.where(F.col(category).isNotNull()), value, [category], out)
    return lookup_join(df, found, [category])


def target_encode(
    df: DataFrame, category: str, label: str, fold: str, folds: int, prefix: str | None = None
) -> DataFrame:
    """Mean and std of the label by category, from the other folds only.

    Rows without a label or fold (test rows) get statistics over all train rows.
    Per-fold partials are merged, so the label is aggregated once.
    """
    prefix = prefix or category
    y = F.col(label).cast("double")
    partial = (
        df.where(F.col(label).isNotNull() & F.col(fold).isNotNull() & F.col(category).isNotNull())
        .groupBy(category, F.col(fold).alias("__own"))
        .agg(F.count(y).alias("__n"), F.avg(y).alias("__m"), (F.var_pop(y) * F.count(y)).alias("__q"))
    )
    whole = W.partitionBy(category)
    centred = partial.withColumn(
        "__c", F.sum(F.col("__n") * F.col("__m")).over(whole) / F.sum("__n").over(whole)
    )
    # Fold -1 stands for test rows: nothing is held out.
    serves = F.array_except(F.sequence(F.lit(-1), F.lit(folds - 1)), F.array(F.col("__own").cast("int")))
    d = F.col("__m") - F.col("__c")
    merged = (
        centred.withColumn("__fold", F.explode(serves))
        .groupBy(category, "__fold")
        .agg(
            F.sum("__n").alias("__n"),
            F.sum(F.col("__n") * d).alias("__d"),
            F.sum(F.col("__q") + F.col("__n") * d * d).alias("__q"),
            F.first("__c").alias("__c"),
        )
    )
    n, shift = F.col("__n"), F.col("__d")
    spread = F.greatest(F.col("__q") - shift * shift / n, F.lit(0.0))
    table = merged.select(
        category,
        "__fold",
        (F.col("__c") + shift / n).alias(f"{prefix}_{label}_avg"),
        F.when(n > 1, F.sqrt(spread / (n - 1))).alias(f"{prefix}_{label}_std"),
    )
    held_out = F.when(F.col(label).isNull(), F.lit(-1)).otherwise(F.coalesce(F.col(fold).cast("int"), F.lit(-1)))
    return lookup_join(df.withColumn("__fold", held_out), table, [category, "__fold"]).drop("__fold")
