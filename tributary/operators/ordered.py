"""Global order without a global sort task: running totals and exact quantiles.

Both need positions in an ordering.  A window over the whole group would put one
hot group into one task, so the ordering is cut into cells: approximate quantiles
of the order column (a bounded sketch) give cell bounds, per-cell totals give each
cell's offset, and a window inside one cell gives the rest.  Bounds only affect
balance, never the result, and they are literals, so a retried task agrees with
the first attempt.
"""

from __future__ import annotations

from collections import Counter

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

_INF = float("inf")
#: Rows that one cell, and so one window task, is meant to hold.
ROWS_PER_CELL = 1_000_000


def default_cells(df: DataFrame) -> int:
    """Cells for about ``ROWS_PER_CELL`` rows each, and at least two for each shuffle partition; no upper limit."""
    shuffles = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(64, 2 * shuffles, -(-df.count() // ROWS_PER_CELL))


def cell_bounds(df: DataFrame, columns: list[str], cells: int) -> dict[str, list[float]]:
    """Approximate cut points per column, one pass; repeats mark heavy values."""
    probs = [i / cells for i in range(1, cells)]
    row = df.agg(
        *[
            F.percentile_approx(F.col(c).cast("double"), probs, 10 * cells).alias(c)
            for c in columns
        ]
    ).first()
    return {c: list(row[c] or []) for c in columns}


def with_interval(df: DataFrame, column: str, bounds: list[float], out: str) -> DataFrame:
    """Index of the half-open interval [b_i, b_i+1) that holds ``column``.

    Adding zero turns -0.0 into 0.0: grouping treats them as one value, a binary
    search would not.
    """
    edges = sorted({b + 0.0 for b in bounds})
    if not edges:
        return df.withColumn(out, F.lit(0))
    cut = Bucketizer(
        splits=[-_INF, *edges, _INF], inputCol="__x", outputCol="__i", handleInvalid="keep"
    )
    marked = cut.transform(df.withColumn("__x", F.col(column).cast("double") + F.lit(0.0)))
    return marked.withColumn(out, F.coalesce(F.col("__i").cast("int"), F.lit(len(edges) + 1))).drop(
        "__x", "__i"
    )


def running_total(
    df: DataFrame,
    by: list[str],
    order: str,
    value: Column | str,
    *,
    out: str = "below",
    total: str | None = None,
    tie_break: str | None = None,
    cells: int | None = None,
    source: DataFrame | None = None,
) -> DataFrame:
    """Sum of ``value`` over earlier rows of the same group, ordered by (order, tie_break).

    ``order`` and ``tie_break`` must be numbers that a double represents exactly
    (ids, micros, 52-bit hash keys, scores).  A value of ``order`` heavy enough to
    fill a cell alone gets cells of its own, cut along ``tie_break``.
    ``total`` optionally names the group's grand total.  ``source`` is a cheaper
    frame with the same totals (for instance the rows ``df`` was grouped from),
    used for bounds and cell totals.  Both are read more than once and must be
    deterministic.
    """
    source = df if source is None else source
    cells = cells or default_cells(source)
    cuts = cell_bounds(source, [order] + ([tie_break] if tie_break else []), cells)
    heavy = [v for v, n in Counter(b + 0.0 for b in cuts[order]).items() if n > 1] if tie_break else []

    def tag(frame: DataFrame) -> DataFrame:
        tagged = frame.withColumn("__v", F.col(value) if isinstance(value, str) else value)
        tagged = with_interval(tagged, order, cuts[order], "__c")
        if not heavy:
            return tagged.withColumn("__t", F.lit(0))
        alone = F.coalesce((F.col(order).cast("double") + F.lit(0.0)).isin(heavy), F.lit(False))
        tagged = with_interval(tagged, tie_break, cuts[tie_break], "__t")
        return tagged.withColumn("__c", 2 * F.col("__c") + (~alone).cast("int")).withColumn(
            "__t", F.when(alone, F.col("__t")).otherwise(F.lit(0))
        )

    tagged = tag(df)
    cell = ["__c", "__t"]
    per_cell = tag(source).groupBy(*by, *cell).agg(F.sum("__v").alias("__s"))
    group = W.partitionBy(*[F.col(c) for c in by]) if by else W.partitionBy(F.lit(0))
    before = group.orderBy(*cell).rowsBetween(W.unboundedPreceding, -1)
    offsets = per_cell.select(
        *[F.col(c).alias(f"__k{i}") for i, c in enumerate(by)],
        F.col("__c").alias("__oc"),
        F.col("__t").alias("__ot"),
        F.coalesce(F.sum("__s").over(before), F.lit(0)).alias("__off"),
        F.sum("__s").over(group).alias("__tot"),
    )
    inside = W.partitionBy(*by, *cell).orderBy(*([order, tie_break] if tie_break else [order]))
    ranked = tagged.withColumn(
        "__in", F.coalesce(F.sum("__v").over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    )
    same = [F.col(c).eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate(by)]
    same += [F.col("__c") == F.col("__oc"), F.col("__t") == F.col("__ot")]
    joined = ranked.join(offsets, on=same, how="inner")
    keep = [F.col(c) for c in df.columns] + [(F.col("__off") + F.col("__in")).alias(out)]
    if total:
        keep.append(F.col("__tot").alias(total))
    return joined.select(*keep)


def numbered(df: DataFrame, order: list[str], out: str, by: list[str] | None = None) -> DataFrame:
    """Number from 0 of each row of its group in the order of columns of any orderable type, nulls first.

    Spark deals the rows into ranges of (group, order), sorts each and writes them once with their place in the range; counts per
    range, one row for each, give the offsets. A hot group spreads over ranges, and a hot value along the further columns. Rows equal
    in all of them are numbered in any order, but once.
    """
    by = by or []
    ranges = df.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order)
    # Partition in the upper bits, place in the partition in the lower 33.
    placed = materialize(ranges.withColumn("__at", F.monotonically_increasing_id()), "numbered")
    placed = placed.withColumns({"__range": F.shiftrightunsigned("__at", 33), "__in": F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))})
    counts = placed.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    before = counts.select("__range", (F.sum("__n").over(W.orderBy("__range")) - F.col("__n")).alias("__before"))
    every = placed.join(before, "__range").withColumn(out, F.col("__before") + F.col("__in"))
    if not by:
        return every.select(*df.columns, out)
    first = every.groupBy(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(by)]).agg(F.min(out).alias("__first"))
    same = [F.col(c).eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate(by)]
    return every.join(first, same).select(*df.columns, (F.col(out) - F.col("__first")).alias(out))


def ranked(df: DataFrame, by: list[str], order: str, tie_break: str | None, out: str) -> DataFrame:
    """Number from 0 of each row of its group by (order, tie_break): in cells of numbers, or in ranges where a column has another type."""
    plain = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
    columns = [order, *([tie_break] if tie_break else [])]
    if all(isinstance(df.schema[c].dataType, plain) for c in columns):
        return running_total(df, by, order, F.lit(1), out=out, tie_break=tie_break)
    return numbered(df, columns, out, by)


def exact_quantiles(
    df: DataFrame,
    value: str,
    parts: int,
    by: list[str] | None = None,
    only: list[int] | None = None,
    cells: int | None = None,
) -> DataFrame:
    """Exact interpolated quantiles k/parts per group: rows ``(by..., k, q)``.

    Three narrow passes instead of one big sort.  A sketch gives cell bounds, counts
    per cell show which cells hold the wanted ranks, and only the values of those
    cells are ranked.  A hot group or value shrinks to counts before it moves.
    """
    by = by or []
    rows = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("__value"))
    cuts = cell_bounds(rows, ["__value"], cells or default_cells(rows))
    tagged = with_interval(rows, "__value", cuts["__value"], "__c")

    group = W.partitionBy(*[F.col(c) for c in by]) if by else W.partitionBy(F.lit(0))
    until = group.orderBy("__c").rowsBetween(W.unboundedPreceding, W.currentRow)
    per_cell = tagged.groupBy(*by, "__c").agg(F.count(F.lit(1)).alias("__n"))
    placed = per_cell.select(
        *by, "__c", "__n", (F.sum("__n").over(until) - 1).alias("__hi"), (F.sum("__n").over(group) - 1).alias("__m")
    ).withColumn("__lo", F.col("__hi") - F.col("__n") + 1)
    wanted = placed.where(_near(parts, only)).select(
        *[F.col(c).alias(f"__k{i}") for i, c in enumerate(by)],
        F.col("__c").alias("__wc"), F.col("__lo").alias("__base"), "__m",
    )
    same = [F.col(c).eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate(by)] + [F.col("__c") == F.col("__wc")]
    count = F.count(F.lit(1)).alias("__n")
    # Repeated values collapse before they are shuffled, and only cells with a wanted rank go on.
    counts = tagged.groupBy(*by, "__c", "__value").agg(count).join(wanted, on=same)
    inside = W.partitionBy(*by, "__c").orderBy("__value").rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = counts.withColumn("__hi", F.col("__base") + F.sum("__n").over(inside) - 1).withColumn(
        "__lo", F.col("__hi") - F.col("__n") + 1
    )
    first, last = _rank_range(parts)
    near = ranked.withColumn("k", F.explode(F.when(first <= last, F.sequence(first, last))))
    if only is not None:
        near = near.where(F.col("k").isin(only))
    # Integer arithmetic keeps floor and remainder of the rank exact.
    floor_rank = F.expr(f"(cast(k as bigint) * __m) div {parts}")
    rest = (F.col("k").cast("bigint") * F.col("__m")) % parts
    ceil_rank = floor_rank + (rest > 0).cast("bigint")

    def at(rank: Column) -> Column:
        return F.when((rank >= F.col("__lo")) & (rank <= F.col("__hi")), F.col("__value"))

    edges = near.groupBy(*by, "k").agg(
        F.max(at(floor_rank)).alias("__a"),
        F.max(at(ceil_rank)).alias("__b"),
        F.max(rest / F.lit(float(parts))).alias("__w"),
    )
    return edges.select(*by, "k", (F.col("__a") + (F.col("__b") - F.col("__a")) * F.col("__w")).alias("q"))


def _rank_range(parts: int) -> tuple[Column, Column]:
    """First and last k whose rank k*m/parts lies strictly between lo-1 and hi+1."""
    first = F.expr(f"if(__m = 0 or __lo = 0, 0, ((__lo - 1) * {parts}) div __m + 1)")
    last = F.expr(f"if(__m = 0, {parts}, least({parts}, ((__hi + 1) * {parts} - 1) div __m))")
    return first.cast("int"), last.cast("int")


def _near(parts: int, only: list[int] | None) -> Column:
    """Whether ranks lo..hi touch a wanted quantile."""
    first, last = _rank_range(parts)
    if only is None:
        return first <= last
    hit = F.lit(False)
    for k in only:
        hit = hit | ((first <= k) & (last >= k))
    return hit


def exact_median(df: DataFrame, value: str, by: list[str] | None = None, out: str = "median") -> DataFrame:
    found = exact_quantiles(df, value, 2, by, only=[1])
    return found.select(*(by or []), F.col("q").alias(out))
