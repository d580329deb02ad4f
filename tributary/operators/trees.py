"""Boosted trees as tables: binned feature codes, a node table, and scoring by arrays of codes.

A feature's code is 0 where the value is missing (null, NaN or infinite), else one more than the number of its cuts below the value,
so ``value <= cut[i]`` and ``code <= i + 1`` say the same. Nodes are numbered as in a heap: 1 is the root, ``2 i``
and ``2 i + 1`` are the children of ``i``. A symmetric tree has one split per level, and the outcomes of its levels are the bits of the leaf.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import map_batches
from .encode import quantile_edges

#: Most cuts of a feature: codes are single bytes.
MOST_CUTS = 254

NODES = "model string, run int, fold int, tree int, node int, left int, right int, feature string, cut double, missing_left boolean, value double, gain double, rows long, cover double"


@dataclass
class Tree:
    """One tree over codes; arrays are indexed by node."""

    depth: int
    symmetric: bool = False
    feature: np.ndarray = field(init=False)
    cut: np.ndarray = field(init=False)
    missing_left: np.ndarray = field(init=False)
    value: np.ndarray = field(init=False)

    def __post_init__(self):
        size = 2 << self.depth
        self.feature = np.full(size, -1, np.int32)
        self.cut = np.zeros(size, np.int32)
        self.missing_left = np.zeros(size, bool)
        self.value = np.zeros(size)

    def split(self, node: int, feature: int, cut: int, missing_left: bool) -> None:
        self.feature[node], self.cut[node], self.missing_left[node] = feature, cut, missing_left

    def nodes_of(self, codes: np.ndarray) -> np.ndarray:
        """The node in which each row of ``codes`` ends up, in the tree as grown so far."""
        return self._by_bits(codes) if self.symmetric else self._by_steps(codes)

    def _by_steps(self, codes: np.ndarray) -> np.ndarray:
        node, row = np.ones(len(codes), np.int64), np.arange(len(codes))
        for _ in range(self.depth):
            feature = self.feature[node]
            code = codes[row, feature]
            right = np.where(code == 0, ~self.missing_left[node], code > self.cut[node])
            node = np.where(feature >= 0, 2 * node + right, node)
        return node

    def _by_bits(self, codes: np.ndarray) -> np.ndarray:
        levels = 1 << np.arange(self.depth)
        levels = levels[self.feature[levels] >= 0]  # the first node of each level carries its split
        code = codes[:, self.feature[levels]]
        right = np.where(code == 0, ~self.missing_left[levels], code > self.cut[levels])
        return (1 << len(levels)) + right @ (1 << np.arange(len(levels))[::-1])

    def scores(self, codes: np.ndarray) -> np.ndarray:
        return self.value[self.nodes_of(codes)]


def clean(column: str, fill: float | None = None):
    """A feature as a double; NaN and infinities are missing, and ``fill`` stands for missing values where it is given."""
    x = F.col(f"`{column}`").cast("double")
    x = F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(None)).otherwise(x)
    return x if fill is None else F.coalesce(x, F.lit(fill))


def feature_cuts(df: DataFrame, features: Sequence[str], bins: int = MOST_CUTS) -> list[list[float]]:
    """Cuts of each feature: its distinct exact quantiles without the largest; at most ``bins`` of them."""
    if not 1 <= bins <= MOST_CUTS:
        raise ValueError(f"bins are from 1 to {MOST_CUTS}, not {bins}")
    edges = quantile_edges(df, list(features), bins)
    return [edges[c][:-1] for c in features]


def with_codes(df: DataFrame, features: Sequence[str], cuts: Sequence[Sequence[float]], keep: Sequence[str]) -> DataFrame:
    """``keep`` and ``codes``: one byte a feature, as one binary value a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = [np.array(c, np.float64) for c in cuts]
        for batch in batches:
            codes = np.zeros((batch.num_rows, len(bounds)), np.uint8)
            for i, edge in enumerate(bounds):
                x = batch.column(f"x{i}").to_numpy(zero_copy_only=False).astype(np.float64)
                codes[:, i] = np.where(np.isnan(x), 0, np.searchsorted(edge, x) + 1)
            columns = [batch.column(f"k{i}") for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, packed_rows(codes)], [*(f"k{i}" for i in range(len(keep))), "codes"])

    source = df.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], *[clean(c).alias(f"x{i}") for i, c in enumerate(features)])
    kinds = [f"k{i} {df.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)]
    made = map_batches(source, run, ", ".join([*kinds, "codes binary"]))
    return made.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "codes")


def packed_rows(matrix: np.ndarray) -> pa.Array:
    """Each row of a matrix as one binary value."""
    width = matrix.shape[1] * matrix.itemsize
    bounds = pa.py_buffer((np.arange(len(matrix) + 1) * width).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(matrix), [None, bounds, pa.py_buffer(np.ascontiguousarray(matrix).tobytes())])


def unpacked_rows(column: pa.Array, kind: type = np.uint8) -> np.ndarray:
    """The matrix that ``packed_rows`` was given."""
    n = len(column)
    if not n:
        return np.zeros((0, 0), kind)
    bounds = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + n + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[bounds[0] : bounds[-1]].view(kind).reshape(n, -1)


def add_margins(codes: np.ndarray, margins: np.ndarray, trees: Sequence[Mapping[int, Tree]]) -> np.ndarray:
    """``margins`` (rows by models) plus the scores of the trees, in their order."""
    margins = margins.copy()
    for each in trees:
        for m, tree in each.items():
            margins[:, m] += tree.scores(codes)
    return margins


def with_margins(df: DataFrame, trees: Sequence[Mapping[int, Tree]], starts: Sequence[float], chunk: int = 2000) -> DataFrame:
    """``df`` (with ``codes``) and ``margins``, an array with one sum per model.

    Trees travel with the tasks, ``chunk`` rounds at a time, so what a task holds is bounded however many there are.
    """
    columns = df.columns
    out = df.withColumn("margins", F.array(*map(F.lit, starts)).cast("array<double>"))
    for a in range(0, len(trees), chunk):
        some = trees[a : a + chunk]

        def run(batches: Iterator[pa.RecordBatch], some=some) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    before = batch.column("margins").flatten().to_numpy().reshape(batch.num_rows, -1)
                    margins = add_margins(unpacked_rows(batch.column("codes")), before, some)
                    nested = pa.ListArray.from_arrays(pa.array(np.arange(len(margins) + 1, dtype=np.int32) * margins.shape[1]), pa.array(margins.ravel()))
                    yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), nested], [*columns, "margins"])

        out = map_batches(out, run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema.fields))
    return out


# --- reports over the node table ---------------------------------------------


def paths(nodes: DataFrame, longest: int = 3, trees: int = 200) -> DataFrame:
    """Runs of 1 to ``longest`` successive splits on a way down from the root: ``model, run, fold, tree, features, gain, rows, share``.

    ``features`` is sorted. ``gain`` sums the gains of the splits of a run; ``rows`` reached its last split, ``share`` is their part of the
    rows of the tree. In a heap the node above ``i`` is ``i div 2``, so a run is joined by ancestry, one join a step.
    """
    key = ["model", "run", "fold", "tree"]
    splits = nodes.where(F.col("feature").isNotNull() & (F.col("tree") < trees)).select(*key, "node", "feature", "gain", "rows")
    roots = splits.where("node = 1").select(*key, F.col("rows").alias("all_rows"))
    above = splits.select(*key, F.col("node").alias("over"), F.col("feature").alias("upper"), F.col("gain").alias("upper_gain"))
    runs = splits.select(*key, "rows", F.floor(F.col("node") / 2).alias("over"), F.array("feature").alias("features"), "gain")
    found = runs
    for _ in range(longest - 1):
        runs = runs.join(above, [*key, "over"]).select(
            *key, "rows", F.floor(F.col("over") / 2).alias("over"), F.array_append("features", F.col("upper")).alias("features"), (F.col("gain") + F.col("upper_gain")).alias("gain")
        )
        found = found.unionByName(runs)
    return found.join(roots, key).select(*key, F.array_sort("features").alias("features"), "gain", "rows", (F.col("rows") / F.col("all_rows")).alias("share"))


def interactions(nodes: DataFrame, longest: int = 3, trees: int = 200, top: int = 300) -> DataFrame:
    """Feature combinations of the first ``trees`` trees of each fold: ``gain, times, weighted_times, rows`` and their place by gain.

    ``times`` counts runs of splits, ``weighted_times`` counts each by the share of rows that reach it. Only the report is limited, to
    the ``top`` combinations of each size and fold; equal gains are ordered by the names.
    """
    sums = (
        paths(nodes, longest, trees)
        .groupBy("model", "run", "fold", F.size("features").alias("order"), F.array_join("features", "|").alias("features"))
        .agg(F.sum("gain").alias("gain"), F.count(F.lit(1)).alias("times"), F.sum("share").alias("weighted_times"), F.sum("rows").alias("rows"))
    )
    place = F.row_number().over(Window.partitionBy("model", "run", "fold", "order").orderBy(F.desc("gain"), "features"))
    return sums.withColumn("place", place).where(F.col("place") <= top)
