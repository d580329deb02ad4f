"""Aggregation specs: ``{column: [functions]}`` turned into named columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Spec = Mapping[str, Sequence[str]]

# The six functions of the level-2 blocks and the five of the blanket block.
ALL6 = ("max", "mean", "sum", "min", "var", "count")
BLANKET5 = ("min", "max", "mean", "sum", "var")


def feature_name(column: str, fn: str, prefix: str = "") -> str:
    return f"{prefix}{column}_{'MEAN' if fn == 'share' else fn.upper()}"


def feature_names(spec: Spec, prefix: str = "") -> list[str]:
    return [feature_name(c, fn, prefix) for c, fns in spec.items() for fn in fns]


def aggregate_column(column: str, fn: str) -> Column:
    x = F.col(column)
    if fn == "sum":
        return F.coalesce(F.sum(x), F.lit(0))
    if fn == "size":
        return F.count(F.lit(1))
    makers = {
        "min": F.min,
        "max": F.max,
        "mean": F.avg,
        "share": F.avg,
        "var": F.var_samp,
        "std": F.stddev_samp,
        "count": F.count,
        "nunique": F.count_distinct,
    }
    return makers[fn](x)


def aggregate(df: DataFrame, keys: list[str], spec: Spec, prefix: str = "", size: str | None = None) -> DataFrame:
    """One grouped aggregation with ``PREFIX_COL_FN`` names."""
    exprs = [
        aggregate_column(c, fn).alias(feature_name(c, fn, prefix)) for c, fns in spec.items() for fn in fns
    ]
    if size:
        exprs.append(F.count(F.lit(1)).alias(size))
    return df.groupBy(*keys).agg(*exprs)


def blanket_spec(df: DataFrame, skip: Sequence[str], fns: Sequence[str] = BLANKET5) -> dict[str, Sequence[str]]:
    """Every numeric column except ``skip``, each with every function."""
    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    dropped = set(skip)
    return {c: fns for c, t in df.dtypes if c not in dropped and (t in numeric or t.startswith("decimal"))}
