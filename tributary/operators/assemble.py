"""Wide tables: feature matrices, stacked predictions, column selection."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns that are never features, and the name parts of the blacklist.
NON_FEATURES = ("TARGET", "SK_ID_CURR", "SK_ID_BUREAU", "SK_ID_PREV", "index")
WINDOW_PREFIXES = ("90_", "180_", "270_", "360_", "3_", "6_", "9_", "12_")
BLOCK_PREFIXES = ("bb_", "prevapp_", "poscash_", "instpay_", "credditcard_")


def union_train_test(train: DataFrame, test: DataFrame, flag: str = "is_train") -> DataFrame:
    """Rows of both tables by column name; columns missing on one side are NULL."""
    return train.withColumn(flag, F.lit(1)).unionByName(
        test.withColumn(flag, F.lit(0)), allowMissingColumns=True
    )


def split_train_test(df: DataFrame, label: str = "TARGET") -> tuple[DataFrame, DataFrame]:
    return df.where(F.col(label).isNotNull()), df.where(F.col(label).isNull())


def feature_matrix(entity: DataFrame, key: str, blocks: Sequence[DataFrame]) -> DataFrame:
    """Left join of per-entity blocks.

    Every block is already hash-partitioned by the key after its own aggregation,
    so the entity is shuffled once and the joins reuse that partitioning.
    """
    out = entity
    for block in blocks:
        out = out.join(block, on=key, how="left")
    return out


def stack_features(entity: DataFrame, key: str, predictions: DataFrame, models: Sequence[str]) -> DataFrame:
    """Predictions ``(key, model, score)`` as one column per model; repeats are averaged."""
    wide = predictions.groupBy(key).pivot("model", list(models)).agg(F.avg("score"))
    return entity.join(wide, on=key, how="left")


def family(columns: Iterable[str], contains: str, without: Sequence[str] = ()) -> list[str]:
    return [c for c in columns if contains in c and not any(w in c for w in without)]


def document_flags(df: DataFrame) -> list[str]:
    return family(df.columns, "FLAG_DOC")


def contact_flags(df: DataFrame) -> list[str]:
    """Numeric ``FLAG_*`` columns that are neither document flags nor ``*_FLAG_*``."""
    strings = {c for c, t in df.dtypes if t == "string"}
    return [c for c in family(df.columns, "FLAG_", ("FLAG_DOC", "_FLAG_")) if c not in strings]


def feature_columns(df: DataFrame, extra: Sequence[str] = ()) -> list[str]:
    return [c for c in df.columns if c not in NON_FEATURES and c not in extra]


def blacklisted(names: Iterable[str]) -> set[str]:
    """Every window and block spelling of the given names."""
    return {w + b + n for w in WINDOW_PREFIXES for b in BLOCK_PREFIXES for n in names if n}


def drop_blacklist(df: DataFrame, names: Iterable[str]) -> DataFrame:
    doomed = blacklisted(names)
    return df.select(*[c for c in df.columns if c not in doomed])


def keep_features(df: DataFrame, features: Sequence[str], keys: Sequence[str]) -> DataFrame:
    present = set(df.columns)
    return df.select(*keys, *[f for f in features if f in present and f not in keys])
