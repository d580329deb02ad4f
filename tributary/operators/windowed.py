"""Recency-windowed, sliced aggregation in one pass over the history.

Functions: those of ``aggspec`` plus ``share``, the mean of a never-missing 0/1
indicator (named ``_MEAN``), which needs one sum instead of a sum and a count.

Windows are nested (a row 40 days old is in the 90-, 180- and all-time window),
so rows are not copied into windows.  Each row falls into one disjoint bucket
(its smallest window) and one slice class, the shuffle carries one partial
aggregate per (entity, bucket, class), and only those few partials fan out to the
windows and slices they belong to.  The fan-out and the merge run after one
repartition by entity, which later joins on the entity reuse.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.ratios import ratio
from ..functions.recency import within
from .aggspec import Spec, feature_name

ALL_WINDOW = "False"  # fixed value: how the unlimited window is spelled in feature names


@dataclass(frozen=True)
class Windows:
    """Nested limits on an offset column (negative = past)."""

    offset: str
    limits: tuple[int, ...] = ()
    unlimited: bool = True
    strict: bool = False

    def labels(self) -> list[str]:
        out = [str(n) for n in sorted(self.limits)]
        return out + [ALL_WINDOW] if self.unlimited else out

    def bucket(self) -> Column:
        """Index of the smallest window a row falls into; NULL if none."""
        found = None
        for i, limit in enumerate(sorted(self.limits)):
            hit = within(self.offset, limit, self.strict)
            found = F.when(hit, F.lit(i)) if found is None else found.when(hit, F.lit(i))
        rest = F.lit(len(self.limits) if self.unlimited else None).cast("int")
        return rest if found is None else found.otherwise(rest)


@dataclass(frozen=True)
class Slices:
    """Named subsets of the rows: ``None`` takes every row, a value takes equals."""

    column: str | None = None
    names: Mapping[str, str | None] = field(default_factory=lambda: {"": None})

    def classes(self) -> list[str]:
        return [v for v in self.names.values() if v is not None]

    def row_class(self) -> Column:
        out = F.lit(0)
        for i, value in enumerate(self.classes(), start=1):
            out = F.when(F.col(self.column) == value, F.lit(i)).otherwise(out)
        return out

    def members(self) -> Column:
        """Names of the slices that take a partial of class ``__cls``."""
        classes = self.classes()
        everyone = [n for n, v in self.names.items() if v is None]
        out = F.array(*[F.lit(n) for n in everyone])
        for i, value in enumerate(classes, start=1):
            names = everyone + [n for n, v in self.names.items() if v == value]
            out = F.when(F.col("__cls") == i, F.array(*[F.lit(n) for n in names])).otherwise(out)
        return out


def _partials(column: str, fns: set[str]) -> list[Column]:
    x = F.col(column)
    out = []
    if fns & {"mean", "var", "count"}:
        out.append(F.count(x).alias(f"{column}__n"))
    if fns & {"mean", "sum", "var", "share"}:
        out.append(F.sum(x).alias(f"{column}__s"))
    if "var" in fns:
        out.append((F.var_pop(x) * F.count(x)).alias(f"{column}__q"))
    if "min" in fns:
        out.append(F.min(x).alias(f"{column}__lo"))
    if "max" in fns:
        out.append(F.max(x).alias(f"{column}__hi"))
    return out


def _merged(column: str, fn: str) -> Column:
    n, s = F.sum(f"{column}__n"), F.sum(f"{column}__s")
    if fn == "count":
        return n
    if fn == "sum":
        return F.coalesce(s, F.lit(0))
    if fn == "min":
        return F.min(f"{column}__lo")
    if fn == "max":
        return F.max(f"{column}__hi")
    if fn == "size":
        return F.sum("__size")
    if fn == "nunique":
        return F.coalesce(F.sum(f"{column}__d"), F.lit(0))
    if fn == "share":
        return ratio(s, F.sum("__size"))
    if fn == "mean":
        return ratio(s, n)
    if fn == "var":
        # Spread around the entity mean, moved to the window's own mean.
        moved = F.sum(f"{column}__r") - n * F.pow(ratio(s, n) - F.first(f"{column}__c"), F.lit(2.0))
        return F.when(n > 1, F.greatest(moved, F.lit(0.0)) / (n - 1))
    raise ValueError(f"cannot merge {fn}")


def windowed_agg(
    df: DataFrame,
    key: str,
    spec: Spec,
    windows: Windows,
    slices: Slices | None = None,
    prefix: str = "",
    size: str | None = None,
) -> DataFrame:
    """Long form ``(key, window, slice, PREFIX_COL_FN...)``.

    An entity without rows in a window has no row there, so joins yield NULL.
    """
    slices = slices or Slices()
    labels = windows.labels()
    needed = {c: set(fns) - {"nunique"} for c, fns in spec.items()}
    needed = {c: fns for c, fns in needed.items() if fns}
    distinct = [c for c, fns in spec.items() if "nunique" in fns]

    if not windows.unlimited:
        df = df.where(within(windows.offset, max(windows.limits), windows.strict))
    tagged = df.select(
        key,
        *spec.keys(),
        windows.bucket().alias("__bucket"),
        slices.row_class().alias("__cls"),
    )
    partials = tagged.groupBy(key, "__bucket", "__cls").agg(
        F.count(F.lit(1)).alias("__size"), *[p for c, fns in needed.items() for p in _partials(c, fns)]
    )
    partials = partials.withColumn("__slices", slices.members()).drop("__cls")
    for column in distinct:
        counted = _distinct_partials(tagged, key, column, slices)
        partials = partials.unionByName(counted, allowMissingColumns=True)

    # One move by entity: the merge here and every later join on the key reuse it.
    moved = _recentred(partials.repartition(F.col(key)), key, needed)
    every = F.array(*[F.lit(n) for n in labels])
    fanned = moved.withColumn(
        "window", F.explode(F.slice(every, F.col("__bucket") + 1, F.lit(len(labels))))
    ).withColumn("slice", F.explode("__slices"))
    merged = fanned.groupBy(key, "window", "slice").agg(
        *[_merged(c, fn).alias(feature_name(c, fn, prefix)) for c, fns in spec.items() for fn in fns],
        F.sum("__size").alias(size or "__size"),
    )
    return merged if size else merged.drop("__size")


def _recentred(partials: DataFrame, key: str, needed: Mapping[str, set[str]]) -> DataFrame:
    """Adds each column's entity mean and its squared spread around that mean."""
    varied = [c for c, fns in needed.items() if "var" in fns]
    if not varied:
        return partials
    entity = W.partitionBy(key)
    centred = partials.withColumns(
        {
            f"{c}__c": ratio(F.sum(F.col(f"{c}__s").cast("double")).over(entity), F.sum(f"{c}__n").over(entity))
            for c in varied
        }
    )
    return centred.withColumns(
        {
            f"{c}__r": F.col(f"{c}__q")
            + F.col(f"{c}__n") * F.pow(ratio(f"{c}__s", f"{c}__n") - F.col(f"{c}__c"), F.lit(2.0))
            for c in varied
        }
    )


def _distinct_partials(tagged: DataFrame, key: str, column: str, slices: Slices) -> DataFrame:
    """Distinct values as partials: a value counts once, in its most recent bucket.

    Windows are nested, so summing these counts over a window's buckets gives the
    number of distinct values seen in it.
    """
    classes = slices.classes()
    recent = [
        F.min(F.col("__bucket") if value is None else F.when(F.col("__cls") == classes.index(value) + 1, F.col("__bucket")))
        for value in slices.names.values()
    ]
    seen = (
        tagged.where(F.col(column).isNotNull())
        .groupBy(key, column)
        .agg(*[m.alias(f"__m{i}") for i, m in enumerate(recent)])
    )
    marks = F.array(
        *[
            F.struct(F.array(F.lit(name)).alias("__slices"), F.col(f"__m{i}").alias("__bucket"))
            for i, name in enumerate(slices.names)
        ]
    )
    stacked = seen.select(key, F.inline(marks)).where(F.col("__bucket").isNotNull())
    return stacked.groupBy(key, "__slices", "__bucket").agg(
        F.count(F.lit(1)).alias(f"{column}__d"), F.lit(0).cast("bigint").alias("__size")
    )


def spread(
    long: DataFrame,
    key: str,
    windows: list[str],
    slices: list[str] | None = None,
    name=lambda window, slice_, feature: f"{window}_{feature}",
    keep=None,
) -> DataFrame:
    """Long form to one wide row per entity.

    Cells of one entity (at most windows x slices of them) are gathered in a map
    and projected, which avoids one conditional aggregate per output column.
    ``keep`` filters wide names before they are built.
    """
    slices = slices or [""]
    features = [c for c in long.columns if c not in (key, "window", "slice")]
    wanted = [
        (w, s, f, name(w, s, f)) for w in windows for s in slices for f in features
    ]
    if keep is not None:
        wanted = [item for item in wanted if keep(item[3])]
    if not wanted:
        return long.select(key).distinct()
    used = [f for f in features if any(item[2] == f for item in wanted)]
    cell = F.struct(F.concat_ws("|", "window", "slice").alias("tag"), F.struct(*used).alias("body"))
    gathered = long.groupBy(key).agg(F.map_from_entries(F.collect_list(cell)).alias("__cells"))
    tags = {(w, s): f"__w{i}" for i, (w, s) in enumerate(dict.fromkeys((x[0], x[1]) for x in wanted))}
    opened = gathered.select(key, *[F.col("__cells")[f"{w}|{s}"].alias(t) for (w, s), t in tags.items()])
    return opened.select(key, *[F.col(tags[(w, s)])[f].alias(n) for w, s, f, n in wanted])


def trend_ratio(wide: DataFrame, recent: str, base: str, prefix: str = "fc_") -> DataFrame:
    """``fc_*`` = recent window / base window for every feature both windows have."""
    short = {c[len(recent) + 1 :] for c in wide.columns if c.startswith(f"{recent}_")}
    long_ = {c[len(base) + 1 :] for c in wide.columns if c.startswith(f"{base}_")}
    added = {
        f"{prefix}{f}": ratio(f"{recent}_{f}", f"{base}_{f}")
        for f in sorted(short & long_)
    }
    return wide.withColumns(added) if added else wide
