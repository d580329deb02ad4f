"""Whitening of embeddings on exact components.

An entry ``c`` becomes the integer ``x = floor(64 c) + 1000000``. Counts, sums and the scatter ``n sum(x x') - S S'`` are exact integers: tasks
multiply blocks of rows, in parts short enough that floating-point products are exact, and partial totals are added by Spark in limbs.
The scatter is the covariance times ``n * n``, centred without any rounding. ``charpoly`` then gives its eigenvalues from the exact characteristic polynomial,
modulo one prime a row, and its eigenvectors, one root a row.

Dropped: vectors that are null, hold null or non-finite entries or such whose ``x`` is beyond 2 ** 62, or have
another length than most (of equally frequent lengths the longest counts). Repeated rows and ids are rows of their own; null ids are kept. Only the id and vector
columns are read, so others cannot clash. No remaining row gives an empty result. A component without variance has null values
and explains 0. Long vectors: rows are never gathered; work on the matrix grows with the fourth power of the dimension
(about 5 CPU seconds at 64), so this is meant for up to some 200.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import charpoly
from .arrow import map_arrow

# Scale and shift of an entry.
SCALE, SHIFT = 64.0, 1_000_000

#: Bits of a part of an integer whose products over ``ROWS`` rows stay exact in floating point, and bits of a limb of a total.
PART_BITS, ROWS, LIMB_BITS = 19, 1 << 14, 40


@dataclass(frozen=True)
class Whitening:
    """What ``fit`` found: rows, vector length, sums of ``x - SHIFT``, eigenvalue shares and one column a component."""

    n: int
    d: int
    sums: list[int]
    explained: list[float]
    #: Unit eigenvectors over the roots of the scatter's eigenvalues; a column without variance is NaN.
    directions: np.ndarray


def _vector(column: str, df: DataFrame) -> Column:
    kind = df.schema[column].dataType.simpleString()
    return F.col(column) if kind in ("array<float>", "array<double>") else F.col(column).cast("array<double>")


def _integers(vectors: pa.ListArray, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the vectors that remain, and their entries as ``x - SHIFT``."""
    offsets = vectors.offsets.to_numpy()
    flat = vectors.values.to_numpy(zero_copy_only=False)
    full = (np.diff(offsets) == d) & vectors.is_valid().to_numpy(zero_copy_only=False)
    at = np.flatnonzero(full)
    y = np.floor(SCALE * flat[offsets[at, None] + np.arange(d)].astype(np.float64))
    kept = (np.abs(y) <= 2.0**62).all(axis=1)  # false for NaN and infinities
    return at[kept], y[kept].astype(np.int64)


def _limbs(value: int) -> list[int]:
    out = []
    while not -(1 << LIMB_BITS) < value < 1 << LIMB_BITS:
        out.append(value & (1 << LIMB_BITS) - 1)
        value >>= LIMB_BITS
    return [*out, value]


def _products(y: np.ndarray) -> np.ndarray:
    """Exact ``y' y`` of at most ``ROWS`` rows as Python integers."""
    parts, rest = [], y
    while True:
        if -(1 << PART_BITS) <= rest.min() and rest.max() < 1 << PART_BITS:
            parts.append(rest.astype(np.float64))
            break
        parts.append((rest & (1 << PART_BITS) - 1).astype(np.float64))
        rest = rest >> PART_BITS
    total = np.zeros((y.shape[1],) * 2, dtype=object)
    for i, a in enumerate(parts):
        for j, b in enumerate(parts):
            total += (a.T @ b).astype(np.int64).astype(object) << PART_BITS * (i + j)
    return total


def scatter(df: DataFrame, vector_col: str, d: int) -> tuple[int, list[int], list[list[int]]]:
    """Rows, sums of ``x - SHIFT`` and the scatter matrix over all remaining vectors, exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, total = 0, np.zeros(d, dtype=object), np.zeros((d, d), dtype=object)
        for batch in batches:
            _, y = _integers(batch.column("v"), d)
            for a in range(0, len(y), ROWS):
                block = y[a : a + ROWS]
                n += len(block)
                high = block >> 32
                sums += (high.sum(axis=0).astype(object) << 32) + (block - (high << 32)).sum(axis=0).astype(object)
                total += _products(block)
        if n:
            cells = [(-1, -1, n), *((i, -1, s) for i, s in enumerate(sums)), *((i, j, total[i, j]) for i in range(d) for j in range(i, d))]
            rows = [(i, j, k, limb) for i, j, value in cells for k, limb in enumerate(_limbs(int(value)))]
            kinds = [("i", pa.int32()), ("j", pa.int32()), ("k", pa.int32()), ("limb", pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, (_, t) in enumerate(kinds)], [name for name, _ in kinds])

    partial = map_arrow(df.select(_vector(vector_col, df).alias("v")), run, "i int, j int, k int, limb bigint")
    found: dict[tuple[int, int], int] = {}
    for r in partial.groupBy("i", "j", "k").agg(F.sum("limb").alias("limb")).collect():  # a number of rows that d bounds
        found[r.i, r.j] = found.get((r.i, r.j), 0) + (r.limb << LIMB_BITS * r.k)
    n = found.get((-1, -1), 0)
    sums = [found.get((i, -1), 0) for i in range(d)]
    cell = lambda i, j: n * found.get((min(i, j), max(i, j)), 0) - sums[i] * sums[j]
    return n, sums, [[cell(i, j) for j in range(d)] for i in range(d)]


def common_length(df: DataFrame, vector_col: str) -> int:
    """The most frequent length of the vectors that are not null, 0 without any."""
    sizes = df.where(F.col(vector_col).isNotNull()).groupBy(F.size(vector_col).alias("d")).agg(F.count(F.lit(1)).alias("rows"))
    best = sizes.agg(F.max(F.struct("rows", "d")).alias("best")).first()["best"]
    return best["d"] if best else 0


def _polynomial(df: DataFrame, matrix: list[list[int]]) -> list[int]:
    """The characteristic polynomial of the scatter, one prime a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.column("p").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([charpoly.polynomial_mod(matrix, p)], pa.list_(pa.int64()))], ["p", "residues"])

    primes = charpoly.primes_for(matrix)
    rows = df.sparkSession.createDataFrame([(p,) for p in primes], "p bigint").repartition(min(len(primes), 32), "p")
    found = {r.p: r.residues for r in map_arrow(rows, run, "p bigint, residues array<bigint>").collect()}
    return charpoly.remainder_lift([found[p] for p in primes], primes)


def _vectors(df: DataFrame, matrix: list[list[int]], roots: list[tuple[int, int]], bits: int) -> list[np.ndarray]:
    """Eigenvectors of the scatter, one root a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in batch.column("at").to_pylist():
                found = charpoly.eigenvectors(matrix, roots[at][0], bits, roots[at][1])
                yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([pickle.dumps(found)], pa.binary())], ["at", "columns"])

    rows = df.sparkSession.createDataFrame([(i,) for i in range(len(roots))], "at bigint").repartition(len(roots), "at")
    found = {r.at: pickle.loads(r.columns) for r in map_arrow(rows, run, "at bigint, columns binary").collect()}
    return [found[i] for i in range(len(roots))]


def fit(df: DataFrame, vector_col: str = "embedding", components: int = 32) -> Whitening:
    """Components by falling eigenvalue, at most as many as entries; the largest entry of each is positive."""
    d = common_length(df, vector_col)
    n, sums, matrix = scatter(df, vector_col, d) if d else (0, [], [])
    if not n:
        return Whitening(0, d, sums, [], np.zeros((d, 0)))
    k = min(components, d)
    roots, bits = charpoly.largest_roots(_polynomial(df, matrix), k)
    units = np.hstack(_vectors(df, matrix, roots, bits))[:, :k]
    units = units * np.sign(units[np.abs(units).argmax(axis=0), np.arange(k)])
    each = [root for root, multiplicity in roots for _ in range(multiplicity)][:k]
    trace = sum(matrix[i][i] for i in range(d)) << bits
    explained = [root / trace if trace else 0.0 for root in each]
    spread = np.array([(root / (1 << bits)) ** 0.5 if root else np.nan for root in each])
    return Whitening(n, d, sums, explained, units / spread)


def _centred(y: np.ndarray, model: Whitening) -> np.ndarray:
    """``n x - S``, exact; Python integers where 64 bits might not do."""
    top = int(np.abs(y).max(initial=0))
    wide = model.n * top + max(map(abs, model.sums), default=0) >= 1 << 62
    sums = np.array(model.sums, dtype=object if wide else np.int64)
    return (y.astype(object) if wide else y) * model.n - sums


def _deviation(centred: np.ndarray) -> list[int | None]:
    """Sums of squares of the rows, null beyond 64 bits."""
    top = int(np.abs(centred).max(initial=0))
    if centred.shape[1] * top * top < 1 << 63:
        return (centred.astype(np.int64) ** 2).sum(axis=1).tolist()
    return [int(s) if s < 1 << 63 else None for s in (centred.astype(object) ** 2).sum(axis=1)]


def transform(df: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id_col, deviation, whitened`` for every remaining row; ``whitened`` has one value a component.

    ``deviation`` is the sum of ``(n x - S) ** 2``, exact, or null where 64 bits cannot hold it.
    """
    d, k = model.d, model.directions.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, y = _integers(batch.column("v"), d)
            centred = _centred(y, model)
            values = (centred.astype(np.float64) @ model.directions).ravel()
            nested = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * k), pa.array(values, pa.float64(), from_pandas=True))
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(at)), pa.array(_deviation(centred), pa.int64()), nested], ["id", "deviation", "whitened"])

    kind = df.schema[id_col].dataType.simpleString()
    source = df.select(F.col(id_col).alias("id"), _vector(vector_col, df).alias("v"))
    if not model.n:
        source = source.limit(0)
    return map_arrow(source, run, f"id {kind}, deviation bigint, whitened array<double>").withColumnRenamed("id", id_col)


def identity_error(df: DataFrame, model: Whitening, vector_col: str = "embedding") -> float:
    """Largest absolute entry of the whitened values' covariance minus the identity, over components that have variance."""
    good = np.flatnonzero(~np.isnan(model.directions).any(axis=0))
    directions, k = model.directions[:, good], len(good)
    if not k:
        return 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            _, y = _integers(batch.column("v"), model.d)
            z = _centred(y, model).astype(np.float64) @ directions
            sums, products = sums + z.sum(axis=0), products + z.T @ z
        i, j = np.triu_indices(k)
        cells = np.concatenate([products[i, j], sums])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([i, np.arange(k)])), pa.array(np.concatenate([j, np.full(k, -1)])), pa.array(cells)], ["i", "j", "value"])

    partial = map_arrow(df.select(_vector(vector_col, df).alias("v")), run, "i bigint, j bigint, value double")
    found = {(r.i, r.j): r.value for r in partial.groupBy("i", "j").agg(F.sum("value").alias("value")).collect()}
    mean = [found[i, -1] / model.n for i in range(k)]
    return max(abs(v / model.n - mean[i] * mean[j] - (i == j)) for (i, j), v in found.items() if j >= 0)
