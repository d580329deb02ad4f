"""Encoders: one-hot, ordinal codes, quantile bins and integer narrowing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import exact_quantiles, numbered, with_interval

MAX_CATEGORIES = 1000


def string_columns(df: DataFrame, skip: list[str] | None = None) -> list[str]:
    skip = skip or []
    return [c for c, t in df.dtypes if t == "string" and c not in skip]


def vocabulary(df: DataFrame, columns: list[str], limit: int = MAX_CATEGORIES) -> dict[str, list[str]]:
    """Sorted values per string column from the full table, in one pass.

    Only for encodings with a column for each value: more than ``limit`` of them is
    an error, never truncated.  Ordinal codes and long shares need no vocabulary.
    """
    if not columns:
        return {}
    pairs = df.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in columns]))
    ).where(F.col("v").isNotNull())
    rows = pairs.distinct().limit(limit * len(columns) + 1).collect()
    found: dict[str, list[str]] = {c: [] for c in columns}
    for row in rows:
        found[row["c"]].append(row["v"])
    for c, values in found.items():
        if len(values) > limit or len(rows) > limit * len(columns):
            raise ValueError(f"column {c!r} (or a sibling) has more than {limit} categories")
    return {c: sorted(v) for c, v in found.items()}


def indicator_name(column: str, value: str) -> str:
    """``<column>_<value>``; dots and backticks would not survive as column names."""
    return f"{column}_{value}".replace(".", "_").replace("`", "_")


def indicator_names(
    columns: list[str], vocab: dict[str, list[str]], missing_column: bool, taken: list[str] | None = None
) -> dict[tuple[str, str | None], str]:
    """A name of its own for every (column, value), None standing for missing.

    Names that differ in case only, or meet after dots are replaced, are one name to
    Spark.  The missing columns have theirs first; the others follow in sorted order,
    and one that finds its name taken gets the suffix ``__2``, ``__3`` and so on.
    """
    used = {c.lower() for c in taken or []}
    names: dict[tuple[str, str | None], str] = {}
    wanted: list[tuple[str, str | None, str]] = [(c, None, f"{c}_nan") for c in columns] if missing_column else []
    wanted += [(c, v, indicator_name(c, v)) for c in columns for v in vocab[c]]
    for c, v, name in wanted:
        chosen, n = name, 1
        while chosen.lower() in used:
            n += 1
            chosen = f"{name}__{n}"
        used.add(chosen.lower())
        names[c, v] = chosen
    return names


def one_hot(
    df: DataFrame,
    columns: list[str] | None = None,
    missing_column: bool = True,
    vocab: dict[str, list[str]] | None = None,
) -> tuple[DataFrame, list[str]]:
    """Replace string columns by 0/1 columns ``<col>_<value>`` (and ``<col>_nan``).

    Every value of the vocabulary has a column, whatever its name clashes with.
    """
    columns = string_columns(df) if columns is None else columns
    vocab = vocabulary(df, columns) if vocab is None else vocab
    kept = [c for c in df.columns if c not in set(columns)]
    names = indicator_names(columns, vocab, missing_column, kept)
    added = {}
    for c in columns:
        for v in vocab[c]:
            added[names[c, v]] = F.col(c).eqNullSafe(F.lit(v)).cast("int")
        if missing_column:
            added[names[c, None]] = F.col(c).isNull().cast("int")
    return df.select(*kept, *[e.alias(n) for n, e in added.items()]), list(added)


def ordinal_encode(df: DataFrame, columns: list[str], vocab: dict[str, list[str]] | None = None) -> DataFrame:
    """Alphabetical 0-based codes; missing (or unseen) values become -1.

    Without ``vocab`` the distinct values are ranked and joined back, however many they are.
    """
    if vocab is None:
        for c in columns:
            own = df.select(F.col(c)).where(F.col(c).isNotNull()).distinct()
            df = df.join(numbered(own, [c], "__code"), on=c, how="left").select(
                *[F.coalesce("__code", F.lit(-1)).cast("int").alias(c) if n == c else F.col(n) for n in df.columns]
            )
        return df

    def code(c: str):
        place = F.array_position(F.array(*[F.lit(v) for v in vocab[c]]).cast("array<string>"), F.col(c))
        return (F.coalesce(place, F.lit(0)) - 1).cast("int")

    return df.withColumns({c: code(c) for c in columns})


def quantile_edges(df: DataFrame, columns: list[str], parts: int) -> dict[str, list[float]]:
    """Distinct exact quantile edges (at most ``parts`` + 1 numbers) of each column, in one job."""
    stacked = df.select(
        F.inline(
            F.array(
                *[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns]
            )
        )
    )
    found: dict[str, set[float]] = {c: set() for c in columns}
    for row in exact_quantiles(stacked, "x", parts, ["column"]).collect():
        found[row["column"]].add(row["q"])
    return {c: sorted(v) for c, v in found.items()}


def quantile_bin(
    df: DataFrame, columns: dict[str, str], parts: int, edges: dict[str, list[float]] | None = None
) -> DataFrame:
    """0-based right-closed quantile bins, ``columns`` maps input to output names.

    The first bin includes the minimum, repeated edges collapse, missing stays
    missing, and values outside given edges have no bin.
    """
    edges = quantile_edges(df, list(columns), parts) if edges is None else edges
    for column, out in columns.items():
        df = _bin(df, column, out, edges[column])
    return df


def _bin(df: DataFrame, column: str, out: str, edges: list[float]) -> DataFrame:
    if len(edges) < 2:
        return df.withColumn(out, F.lit(None).cast("int"))
    inner = edges[1:-1]
    # Counting negated edges <= -x turns Bucketizer's left-closed bins into right-closed ones.
    marked = with_interval(
        df.withColumn("__neg", -F.col(column).cast("double")), "__neg", [-e for e in inner], "__above"
    )
    inside = F.col(column).between(edges[0], edges[-1])
    code = F.when(inside, F.lit(len(inner)) - F.col("__above"))
    return marked.withColumn(out, code.cast("int")).drop("__neg", "__above")


def narrow_types(df: DataFrame, skip: str = "SK_ID_", floats: bool = False) -> DataFrame:
    """Smallest integer type whose open range holds the column; values unchanged.

    ``floats=True`` also stores doubles as 32-bit floats, which loses digits.
    """
    integer = [c for c, t in df.dtypes if t in ("smallint", "int", "bigint") and skip not in c]
    double = [c for c, t in df.dtypes if floats and t == "double" and skip not in c]
    if not integer and not double:
        return df
    row = df.agg(
        *[F.min(c).alias(f"lo_{c}") for c in integer + double],
        *[F.max(c).alias(f"hi_{c}") for c in integer + double],
    ).first()
    target = {}
    for c in integer:
        lo, hi = row[f"lo_{c}"], row[f"hi_{c}"]
        if lo is None:
            continue
        for name, bits in (("tinyint", 8), ("smallint", 16), ("int", 32), ("bigint", 64)):
            if lo > -(2 ** (bits - 1)) and hi < 2 ** (bits - 1) - 1:
                target[c] = name
                break
    for c in double:
        lo, hi = row[f"lo_{c}"], row[f"hi_{c}"]
        if lo is not None and max(abs(lo), abs(hi)) < 3.4e38:
            target[c] = "float"
    return df.select(*[F.col(c).cast(target[c]).alias(c) if c in target else F.col(c) for c in df.columns])
