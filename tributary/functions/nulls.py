"""Missing-value policy: NaN, sentinels and invalid categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The date sentinel of the credit tables and the tree-model filler.
MISSING_DATE = 365243
MISSING_FILL = -999.0


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every floating column, so aggregates skip it."""
    floating = {
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.select(
        *[
            F.when(F.isnan(c), F.lit(None)).otherwise(F.col(c)).alias(c) if c in floating else F.col(c)
            for c in df.columns
        ]
    )


def sentinel_to_null(col: Column | str, sentinel: float = MISSING_DATE) -> Column:
    return F.nullif(_c(col), F.lit(sentinel))


def is_not(col: Column | str, invalid: str) -> Column:
    """Predicate that drops one invalid value and keeps missing ones."""
    return ~_c(col).eqNullSafe(F.lit(invalid))


def fill_for_trees(df: DataFrame, columns: list[str], filler: float = MISSING_FILL) -> DataFrame:
    """Doubles without NULL, NaN or infinity: tree vectors accept nothing else."""
    wanted = set(columns)

    def clean(c: str) -> Column:
        x = F.col(c).cast("double")
        bad = x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
        return F.when(bad, F.lit(filler)).otherwise(x).alias(c)

    return df.select(*[clean(c) if c in wanted else F.col(c) for c in df.columns])


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col
