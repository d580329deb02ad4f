"""k-fold out-of-fold scoring with second-order histogram boosting.

All models of a run (one per fold, and one per fold and permuted label) grow together. A level is two Spark jobs whatever their number:
tasks sum gradients and Hessians per (model, node, feature, bin) over the binned rows they read, one shuffle adds the partial
histograms, windows over bins turn them into gains, and only the best split of each node comes to the driver. The histogram of a larger
child is its parent's minus its sibling's, so every level scans at most half of the rows. Missing values have a bin of their own that
is tried on both sides of every cut.

Gradients are rounded to multiples of 2^-24 and summed as integers. Sums are then exact, so trees do not depend on
partitioning, retries or the order of rows.

Rows and their margins are written again every ``block`` rounds, and a lost executor recomputes from there. The
same pass yields the margins after each round for held-out rows; their exact AUCs decide where each fold's model stops.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import map_batches, materialize, shared_dir
from .importance import split_counts
from .trees import NODES, Tree, add_margins, clean, feature_cuts, unpacked_rows, with_codes, with_margins
from .validation import auc, hash_fold, hash_order

#: Gradients are whole multiples of one over this; sums of 1e10 rows fit 64 bits.
SCALE = 1 << 24


@dataclass(frozen=True)
class Preset:
    """Booster settings. ``growth`` is ``leaf`` (best leaf first), ``level`` (all nodes of a level) or ``symmetric`` (one split a level)."""

    name: str
    growth: str
    depth: int
    leaves: int
    step: float
    rounds: int
    patience: int
    row_share: float
    column_share: float
    positive_weight: float
    min_child_weight: float
    l1: float
    l2: float
    min_gain: float
    fold_seed: int
    fill: float | None = None
    average_start: bool = False
    bins: int = 254
    seed: int = 27


# The three published configurations.
LEAFWISE = Preset("lgb", "leaf", 8, 32, 0.01, 100_000, 200, 0.8715623, 0.9497036, 1.0, 39.3259775, 0.04, 0.073, 0.0222415, 1001, average_start=True)
DEPTHWISE = Preset("xgb", "level", 4, 16, 0.01, 10_000, 200, 0.8, 0.8, 2.0, 5.0, 0.0, 1.0, 0.0, 2018)
SYMMETRIC = Preset("cat", "symmetric", 6, 64, 0.01, 5_000, 45, 0.7, 1.0, 5.0, 0.0, 0.0, 40.0, 0.0, 2018, fill=-999.0)


@dataclass
class CrossValidation:
    """Results of one k-fold run; every table is keyed, nothing is positional."""

    oof: DataFrame  # key, fold, label, model, score
    test: DataFrame  # key, model, score (mean over the fold models)
    importance: DataFrame  # model, feature, fold, importance (gain share)
    splits: DataFrame  # model, feature, fold, importance (how often a feature splits, 0 where it never does)
    nodes: DataFrame  # one row per tree node, see ``trees.NODES``
    staged: DataFrame  # run, fold, round, auc of the held-out rows after each round trained
    kept: list[list[int]]  # trees kept, by label and fold
    features: list[str]
    preset: Preset

    def predictions(self, key: str) -> DataFrame:
        """Train and test scores in one table, ready to be stacked."""
        return self.oof.select(key, "model", "score").unionByName(self.test)


@dataclass(frozen=True)
class Sums:
    """Gradients, Hessians and rows; the first two in units of one over ``SCALE``."""

    g: int
    h: int
    n: int

    def minus(self, other: Sums) -> Sums:
        return Sums(self.g - other.g, self.h - other.h, self.n - other.n)


NOTHING = Sums(0, 0, 0)


@dataclass(frozen=True)
class Split:
    gain: float
    feature: int
    cut: int
    missing_left: bool
    left: Sums
    total: Sums


def soft(g: float, l1: float) -> float:
    """The gradient sum moved towards zero by the L1 penalty."""
    return math.copysign(max(abs(g) - l1 * SCALE, 0.0), g)


def leaf_value(total: Sums, preset: Preset) -> float:
    below = total.h + preset.l2 * SCALE
    return -soft(float(total.g), preset.l1) / below * preset.step if below > 0 else 0.0


def quality(g: str, h: str, preset: Preset) -> str:
    """SQL of what a node with these sums gains over a score of zero."""
    lim, below = f"{preset.l1 * SCALE!r}D", f"(double({h}) + {preset.l2 * SCALE!r}D)"
    top = f"double({g})" if not preset.l1 else f"(signum(double({g})) * greatest(abs(double({g})) - {lim}, 0D))"
    return f"if({below} > 0, {top} * {top} / {below} / {float(SCALE)!r}D, 0D)"


def sampled_features(count: int, preset: Preset, tree: int) -> list[int]:
    """The features of a tree: the smallest md5 of (seed, tree, feature), at least one."""
    order = sorted(range(count), key=lambda j: hashlib.md5(f"{preset.seed}_{tree}_{j}".encode()).hexdigest())
    return sorted(order[: max(1, round(preset.column_share * count))])


def sampled_row(key: str, preset: Preset, tree: int) -> Column:
    """Whether a row takes part in a tree; decided by its key alone."""
    if preset.row_share >= 1:
        return F.lit(True)
    return hash_order(key, f"{preset.seed}_{tree}") < F.lit(int(preset.row_share * (1 << 52)))


# --- one level: histograms and gains -------------------------------------------


def gradients(y: np.ndarray, margin: np.ndarray, positive_weight: float) -> tuple[np.ndarray, np.ndarray]:
    p = 1.0 / (1.0 + np.exp(-margin))
    w = np.where(y == 1, positive_weight, 1.0)
    return np.rint(w * (p - y) * SCALE), np.rint(w * p * (1.0 - p) * SCALE)


@dataclass(frozen=True)
class Round:
    """What the tasks of one round need: trees not yet in the margins, the trees being grown, active models and features."""

    block: list[dict[int, Tree]]
    growing: dict[int, Tree]
    features: list[int]
    sizes: list[int]  # bins of every feature, the missing one included
    folds: int
    positive_weight: float


def histograms(rows: DataFrame, at: Round, scan: dict[int, list[int]], less: dict[tuple[int, int], int]) -> DataFrame:
    """Partial sums ``model, node, feature, bin, g, h, n`` of the nodes in ``scan`` (by model).

    Where ``less`` names a sibling for (model, node), the same sums are also taken away from it. Rows hold
    ``fold, ys, margins, codes, used``. A task holds models x nodes x bins of all features x 24 bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = np.concatenate([[0], np.cumsum([at.sizes[j] for j in at.features])])
        held = {m: np.zeros((3, len(nodes), starts[-1]), np.int64) for m, nodes in scan.items()}
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = unpacked_rows(batch.column("codes"))
            fold = batch.column("fold").to_numpy()
            used = batch.column("used").to_numpy(zero_copy_only=False)
            ys = batch.column("ys").flatten().to_numpy().reshape(batch.num_rows, -1)
            before = batch.column("margins").flatten().to_numpy().reshape(batch.num_rows, -1)
            for m, nodes in scan.items():
                place = np.full(2 << at.growing[m].depth, -1)
                place[nodes] = np.arange(len(nodes))
                row = np.flatnonzero(used & (fold != m % at.folds))
                own = codes[row]
                slot = place[at.growing[m].nodes_of(own)]
                row, own, slot = row[slot >= 0], own[slot >= 0], slot[slot >= 0]
                margin = add_margins(own, before[row, m : m + 1], [{0: trees[m]} for trees in at.block if m in trees])[:, 0]
                g, h = gradients(ys[row, m // at.folds], margin, at.positive_weight)
                for j, begin in zip(at.features, starts, strict=False):
                    cell, size = slot * at.sizes[j] + own[:, j], len(nodes) * at.sizes[j]
                    for k, weights in enumerate((g, h, None)):
                        sums = np.bincount(cell, weights, minlength=size).reshape(len(nodes), -1)
                        held[m][k][:, begin : begin + at.sizes[j]] += sums.astype(np.int64)
        for m, nodes in scan.items():
            for i, node in enumerate(nodes):
                found = np.flatnonzero(held[m][2][i])
                feature = np.searchsorted(starts, found, "right") - 1
                g, h, n = held[m][:, i, found]
                for target, sign in ((node, 1), (less.get((m, node)), -1)):
                    if target is not None and len(found):
                        columns = [np.full(len(found), m), np.full(len(found), target), np.array(at.features)[feature], found - starts[feature], sign * g, sign * h, sign * n]
                        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["model", "node", "feature", "bin", "g", "h", "n"])

    return map_batches(rows, run, "model bigint, node bigint, feature bigint, bin bigint, g bigint, h bigint, n bigint")


def summed(partial: DataFrame) -> DataFrame:
    """Whole histograms without empty cells, dealt by (model, node, feature) for the windows that follow."""
    dealt = partial.repartition("model", "node", "feature")
    return dealt.groupBy("model", "node", "feature", "bin").agg(F.expr("sum(g) AS g"), F.expr("sum(h) AS h"), F.expr("sum(n) AS n")).where("n > 0")


def candidates(histogram: DataFrame, preset: Preset) -> DataFrame:
    """Every cut after a bin, with the missing rows right and, where there are any, left: sums of the left side, of the node, and the gain.

    The gain is null where a side is too light.
    """
    sums = ("g", "h", "n")
    group, upto = "OVER (PARTITION BY model, node, feature)", "OVER (PARTITION BY model, node, feature ORDER BY bin ROWS UNBOUNDED PRECEDING)"
    running = histogram.selectExpr(
        "model", "node", "feature", "bin",
        *[f"sum(if(bin > 0, {c}, 0L)) {upto} AS below_{c}" for c in sums],
        *[f"sum(if(bin > 0, 0L, {c})) {group} AS missing_{c}" for c in sums],
        *[f"sum({c}) {group} AS total_{c}" for c in sums],
    )
    right = "struct(false AS missing_left, below_g AS left_g, below_h AS left_h, below_n AS left_n)"
    left = "struct(true AS missing_left, below_g + missing_g AS left_g, below_h + missing_h AS left_h, below_n + missing_n AS left_n)"
    # Nodes that share a split are compared in both directions, also those without missing rows.
    sides = f"array({right}, {left})" if preset.growth == "symmetric" else f"if(missing_n > 0, array({right}, {left}), array({right}))"
    cuts = running.selectExpr("model", "node", "feature", "bin", *[f"total_{c}" for c in sums], f"inline({sides})")
    if preset.growth == "symmetric":  # a split that all nodes share may leave one of them empty
        fits = "bin > 0"
    else:
        light = f"{preset.min_child_weight * SCALE!r}D"
        fits = f"bin > 0 AND left_n > 0 AND left_n < total_n AND left_h >= {light} AND total_h - left_h >= {light}"
    gain = f"{quality('left_g', 'left_h', preset)} + {quality('(total_g - left_g)', '(total_h - left_h)', preset)} - {quality('total_g', 'total_h', preset)}"
    return cuts.selectExpr("model", "node", "feature", "bin", "missing_left", *SIDES, f"if({fits}, {gain}, NULL) AS gain")


SIDES = [f"{which}_{c}" for which in ("left", "total") for c in ("g", "h", "n")]
#: Order of candidates: gain, then the first feature, the first bin, missing rows right. A null gain comes last.
ORDER = "struct(gain IS NOT NULL AS fits, gain, -feature AS f, -bin AS b, NOT missing_left AS r)"
CHOSEN = ["best.o.gain AS gain", "-best.o.f AS feature", "-best.o.b AS bin", "NOT best.o.r AS missing_left"]


def best_splits(cuts: DataFrame) -> DataFrame:
    """The best candidate of each node; its gain is null where none fits."""
    best = cuts.groupBy("model", "node").agg(F.expr(f"max(struct({ORDER} AS o, struct({', '.join(SIDES)}) AS s)) AS best"))
    return best.selectExpr("model", "node", *CHOSEN, "best.s.*")


def best_shared_splits(histogram: DataFrame, sizes: Sequence[int], preset: Preset) -> DataFrame:
    """One candidate for all nodes of a model, by the sum of their gains; a row for each node.

    Bins without rows are filled in, because a cut after one may be the best for other nodes. Gains are summed as multiples of 2^-20, in any order alike.
    """
    spark = histogram.sparkSession
    grid = spark.createDataFrame(list(enumerate(sizes)), "feature bigint, bins bigint").select("feature", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("bins") - 1)).alias("bin"))
    nodes = histogram.select("model", "node", "feature").distinct().join(F.broadcast(grid), "feature")
    dense = nodes.join(histogram, ["model", "node", "feature", "bin"], "left").fillna(0, ["g", "h", "n"])
    shared = (
        candidates(dense, preset)
        .groupBy("model", "feature", "bin", "missing_left")
        .agg(F.expr("double(sum(cast(round(gain * 1048576) AS decimal(38, 0)))) / 1048576 AS gain"), F.expr(f"collect_list(struct(node, {', '.join(SIDES)})) AS nodes"))
    )
    best = shared.groupBy("model").agg(F.expr(f"max(struct({ORDER} AS o, nodes)) AS best"))
    return best.selectExpr("model", *CHOSEN, "inline(best.nodes)")


# --- growing -------------------------------------------------------------------


@dataclass
class Grower:
    """One tree of one model while it grows: splits known of its nodes, and which of them were taken."""

    preset: Preset
    tree: Tree
    known: dict[int, Split] = field(default_factory=dict)
    expanded: set[int] = field(default_factory=set)

    def worth(self, node: int) -> bool:
        split = self.known.get(node)
        return split is not None and split.gain is not None and split.gain > self.preset.min_gain and node < 1 << self.preset.depth

    def expand(self) -> list[int]:
        """Nodes whose children's splits are needed next.

        Best leaf first: the order of splits is played through with what is known; a leaf that is not reached while unknown
        children count for nothing can never be reached, so all leaves reached with unknown children are needed, at once.
        """
        needed = [n for n in self.order() if n not in self.expanded and n < 1 << (self.preset.depth - 1)]
        for n in needed:
            self.expanded.add(n)
            self.split(n)
        return needed

    def split(self, node: int) -> None:
        """Apply a node's split to the tree; in a symmetric tree the first node of a level carries it."""
        s = self.known[node]
        at = 1 << (node.bit_length() - 1) if self.tree.symmetric else node
        self.tree.split(at, s.feature, s.cut, s.missing_left)

    def order(self) -> list[int]:
        """Nodes in the order in which they split, as far as known."""
        if self.preset.growth != "leaf":
            return sorted(n for n in self.known if self.worth(n))
        taken, frontier = [], {1}
        while len(taken) < self.preset.leaves - 1:
            best = max((n for n in frontier if self.worth(n)), key=lambda n: (self.known[n].gain, -n), default=None)
            if best is None:
                break
            taken.append(best)
            frontier = frontier - {best} | {2 * best, 2 * best + 1}
        return taken

    def finish(self, root: Sums | None) -> list[tuple]:
        """Set splits and leaf values; node rows ``(node, left, right, feature, cut, missing_left, value, gain, rows, cover)``."""
        self.tree = Tree(self.preset.depth, self.tree.symmetric)
        if root is None:
            return []
        rows, sums, inner = [], {1: root}, {n: self.known[n] for n in self.order()}
        if self.tree.symmetric:  # nodes without rows split as their level does
            for first, s in list(inner.items()):
                level = first.bit_length() - 1
                for n in range(1 << level, 2 << level):
                    inner.setdefault(n, Split(0.0, s.feature, s.cut, s.missing_left, NOTHING, NOTHING))
        for n in sorted(inner):
            s = inner[n]
            self.tree.split(n, s.feature, s.cut, s.missing_left)
            sums[2 * n], sums[2 * n + 1] = s.left, s.total.minus(s.left)
            rows.append((n, 2 * n, 2 * n + 1, s.feature, s.cut, s.missing_left, None, s.gain, s.total.n, s.total.h / SCALE))
        for n, total in sums.items():
            if n not in inner:
                self.tree.value[n] = leaf_value(total, self.preset)
                rows.append((n, None, None, None, None, None, float(self.tree.value[n]), None, total.n, total.h / SCALE))
        return rows


def _where(keys: Iterable[tuple[int, int]], bits: int) -> Column:
    return (F.col("model") * F.lit(1 << bits) + F.col("node")).isin([m * (1 << bits) + n for m, n in keys])


def grow(rows: DataFrame, at: Round, preset: Preset) -> dict[int, list[tuple]]:
    """Grow one tree of every model in ``at.growing``; returns their node rows.

    ``rows`` are those of ``histograms``. A step evaluates all children that any model needs: smaller ones are scanned, larger ones are
    derived from the histogram of their parent, which an earlier step wrote.
    """
    bits = preset.depth + 2
    growers = {m: Grower(preset, tree) for m, tree in at.growing.items()}
    roots: dict[int, Sums] = {}
    written: list[DataFrame] = []
    held: dict[tuple[int, int], int] = {}
    scan: dict[int, list[int]] = {m: [1] for m in growers}
    less: dict[tuple[int, int], int] = {}
    parents: list[tuple[int, int]] = []
    while scan:
        partial = histograms(rows, at, scan, less)
        for step in sorted({held[p] for p in parents}):
            here = [p for p in parents if held[p] == step]
            larger = {(m, t >> 1): t for (m, _), t in less.items()}
            for right in (0, 1):
                own = [p for p in here if larger[p] & 1 == right]
                if own:
                    partial = partial.unionByName(written[step].where(_where(own, bits)).withColumn("node", F.col("node") * 2 + right))
        targets = [(m, n) for m, nodes in scan.items() for n in nodes] + [(m, t) for (m, _), t in less.items()]
        whole = summed(partial)
        if any(n < 1 << (preset.depth - 1) for _, n in targets):  # children of these may be evaluated later
            whole = materialize(whole, "histogram")
        held.update(dict.fromkeys(targets, len(written)))
        written.append(whole)
        symmetric = preset.growth == "symmetric"
        found = best_shared_splits(whole, at.sizes, preset) if symmetric else best_splits(candidates(whole, preset))
        for r in found.collect():
            left, total = Sums(r.left_g, r.left_h, r.left_n), Sums(r.total_g, r.total_h, r.total_n)
            growers[r.model].known[r.node] = Split(r.gain, r.feature, r.bin, r.missing_left, left, total)
            if r.node == 1:
                roots[r.model] = total
        scan, less, parents = {}, {}, []
        for m, grower in growers.items():
            for n in grower.expand():
                s = grower.known[n]
                small, large = (2 * n, 2 * n + 1) if 2 * s.left.n <= s.total.n else (2 * n + 1, 2 * n)
                scan.setdefault(m, []).append(small)
                less[m, small] = large
                parents.append((m, n))
    done = {m: grower.finish(roots.get(m)) for m, grower in growers.items()}
    at.growing.update({m: grower.tree for m, grower in growers.items()})
    return done


# --- runs ----------------------------------------------------------------------


def _names(label: str | Sequence[str]) -> list[str]:
    return [label] if isinstance(label, str) else list(label)


def binned(df: DataFrame, key: str, label: str | Sequence[str], features: Sequence[str], preset: Preset, folds: int, fold: str | None = None) -> tuple[DataFrame, list[list[float]]]:
    """The binned column store ``key, ys, codes, fold`` (fold -1: no label), written once, and the cuts of each feature.

    With several labels, a row without the first has none of them.
    """
    labels = _names(label)
    assigned = F.col(fold) if fold else hash_fold(key, folds, preset.fold_seed)
    inputs = [f"x{i}" for i in range(len(features))]
    # Quantiles and codes read the features several times: whatever they come from is evaluated once.
    rows = materialize(
        df.select(
            F.col(key).alias("key"),
            F.when(F.col(labels[0]).isNull(), F.lit(-1)).otherwise(assigned).cast("int").alias("fold"),
            F.array(*[F.coalesce(F.col(c).cast("int"), F.lit(0)) for c in labels]).alias("ys"),
            *[clean(c, preset.fill).alias(x) for c, x in zip(features, inputs, strict=True)],
        ),
        f"features-{preset.name}",
    )
    cuts = feature_cuts(rows, inputs, preset.bins)
    coded = with_codes(rows, inputs, cuts, ["key", "ys", "fold"])
    return materialize(coded.select(F.col("key").alias(key), "ys", "codes", "fold"), f"binned-{preset.name}"), cuts


def _starts(train: DataFrame, labels: int, folds: int, preset: Preset) -> list[float]:
    """Margin from which each model starts: 0, or the log odds of its weighted training labels."""
    if not preset.average_start:
        return [0.0] * labels * folds
    counts = train.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col("ys")[p]).alias(f"y{p}") for p in range(labels)]).collect()
    out = []
    for p in range(labels):
        for f in range(folds):
            n, y = (sum(r[c] for r in counts if r.fold != f) for c in ("n", f"y{p}"))
            positive, negative = y * preset.positive_weight, n - y
            out.append(math.log(positive / negative) if positive and negative else 0.0)
    return out


def stopping_rounds(scores: Sequence[float | None], patience: int) -> tuple[int, int | None]:
    """Rounds kept and the round after which training stops (None: not yet), by the AUCs after each round.

    The best is the first of the highest; training stops once ``patience`` rounds have not beaten it. Rounds without an AUC never do.
    """
    best, at = None, -1
    for i, score in enumerate(scores):
        if score is not None and (best is None or score > best):
            best, at = score, i
        if best is not None and i - at >= patience:
            return at + 1, i + 1
    return (at + 1 if best is not None else len(scores)), None


@dataclass
class Training:
    """Trees of every round, as dictionaries by model, and how many each model keeps."""

    trees: list[dict[int, Tree]]
    kept: list[int]
    starts: list[float]
    nodes: DataFrame
    staged: DataFrame


def train(store: DataFrame, key: str, labels: int, features: Sequence[str], cuts: Sequence[Sequence[float]], preset: Preset, folds: int, early_stopping: bool = True, block: int = 10) -> Training:
    """Boost all models over the store: model ``p * folds + f`` learns label p from the rows outside fold f.

    With early stopping the AUCs of all rounds of a block come from one pass over held-out rows.
    """
    spark, sizes = store.sparkSession, [len(c) + 2 for c in cuts]
    models = list(range(labels * folds))
    rows = store.where(F.col("fold") >= 0).select(key, "fold", "ys", "codes")
    starts = _starts(rows, labels, folds, preset)
    rows = rows.withColumn("margins", F.array(*map(F.lit, starts)).cast("array<double>"))
    path = f"{shared_dir(spark)}/tributary/nodes-{preset.name}-{uuid.uuid4().hex}"
    spark.createDataFrame([], NODES).write.parquet(path)
    trees: list[dict[int, Tree]] = []
    aucs: dict[int, list[float | None]] = {m: [] for m in models}
    active, kept = set(models), [preset.rounds] * len(models)
    while len(trees) < preset.rounds and active:
        made: list[dict[int, Tree]] = []
        reports = []
        for number in range(len(trees), min(len(trees) + block, preset.rounds)):
            growing = {m: Tree(preset.depth, preset.growth == "symmetric") for m in sorted(active)}
            at = Round(made, growing, sampled_features(len(features), preset, number), sizes, folds, preset.positive_weight)
            used = rows.withColumn("used", sampled_row(key, preset, number)).select("fold", "ys", "margins", "codes", "used")
            for m, found in grow(used, at, preset).items():
                reports += [(preset.name, m // folds, m % folds, number, n, left, right, None if j is None else features[j], _cut(cuts, j, cut), missing, value, gain, count, cover) for n, left, right, j, cut, missing, value, gain, count, cover in found]
            made.append(at.growing)
        trees += made
        spark.createDataFrame(reports, NODES).write.mode("append").parquet(path)
        if early_stopping or len(trees) < preset.rounds:
            after = materialize(_advanced(rows, key, made, folds), f"margins-{preset.name}")
            rows = after.select(key, "fold", "ys", "codes", "margins")
        if early_stopping:
            for m, values in _staged_auc(after, labels, folds, len(made)).items():
                aucs[m] += values
            for m in sorted(active):
                kept[m], stop = stopping_rounds(aucs[m][: len(trees)], preset.patience)
                if stop is not None:
                    active.discard(m)
    kept = [min(k, len(trees)) for k in kept]
    limits = F.array(*map(F.lit, kept))
    nodes = spark.read.schema(NODES).parquet(path).where(F.col("tree") < F.get(limits, F.col("run") * folds + F.col("fold")))
    staged = spark.createDataFrame([(m // folds, m % folds, i, v) for m, values in aucs.items() for i, v in enumerate(values)], "run int, fold int, round int, auc double")
    return Training(trees, kept, starts, nodes, staged)


def _cut(cuts: Sequence[Sequence[float]], feature: int | None, code: int | None) -> float | None:
    """The value at which a code cuts; beyond the last cut all known values go left."""
    if feature is None:
        return None
    return cuts[feature][code - 1] if code <= len(cuts[feature]) else math.inf


def _advanced(rows: DataFrame, key: str, made: list[dict[int, Tree]], folds: int) -> DataFrame:
    """Rows with the trees added to their margins, and in ``staged`` the margins of the models of their own fold after each round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            codes, fold = unpacked_rows(batch.column("codes")), batch.column("fold").to_numpy()
            margins = batch.column("margins").flatten().to_numpy().reshape(batch.num_rows, -1)
            each = np.arange(batch.num_rows)
            staged = []
            for trees in made:
                margins = add_margins(codes, margins, [trees])
                staged.append(margins.reshape(batch.num_rows, -1, folds)[each, :, fold])
            nested = [_nested(margins), _nested(np.stack(staged, axis=1).reshape(batch.num_rows, -1))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("k", "fold", "ys", "codes")), *nested], ["k", "fold", "ys", "codes", "margins", "staged"])

    kind = rows.schema[key].dataType.simpleString()
    made_rows = map_batches(rows.withColumnRenamed(key, "k").select("k", "fold", "ys", "codes", "margins"), run, f"k {kind}, fold int, ys array<int>, codes binary, margins array<double>, staged array<double>")
    return made_rows.withColumnRenamed("k", key)


def _nested(matrix: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]), pa.array(matrix.ravel()))


def _staged_auc(after: DataFrame, labels: int, folds: int, rounds: int) -> dict[int, list[float | None]]:
    """Exact AUC of held-out rows by model, after each round of a block."""
    held = after.select("fold", "ys", F.posexplode("staged").alias("at", "score"))
    each = held.select("fold", (F.col("at") % labels).alias("run"), F.floor(F.col("at") / labels).cast("int").alias("round"), F.get("ys", F.col("at") % labels).alias("label"), "score")
    found = {(r.run, r.fold, r["round"]): r.auc for r in auc(each, "label", "score", ["run", "fold", "round"]).collect()}
    return {p * folds + f: [found.get((p, f, i)) for i in range(rounds)] for p in range(labels) for f in range(folds)}


def cross_validate(
    df: DataFrame,
    key: str,
    label: str | Sequence[str],
    features: list[str],
    preset: Preset,
    folds: int,
    fold: str | None = None,
    early_stopping: bool = True,
    block: int = 10,
) -> CrossValidation:
    """One model per fold, trained together; each scores its held-out rows and all unlabelled rows with the trees it keeps.

    ``label`` may name several labels (the first is the real one, further ones are permutations of it). Then ``nodes``, ``importance`` and ``splits`` hold
    all runs and scores are those of the first. Missing values need no filling, except where the preset names a filler.
    """
    if not features:
        raise ValueError("no features to train on")
    labels = len(_names(label))
    store, cuts = binned(df, key, label, features, preset, folds, fold)
    done = train(store, key, labels, features, cuts, preset, folds, early_stopping, block)
    kept_trees = [{m: t for m, t in each.items() if m < folds and i < done.kept[m]} for i, each in enumerate(done.trees)]
    scored = with_margins(store.select(key, "ys", "codes", "fold"), kept_trees, done.starts[:folds])
    chance = lambda z: 1 / (1 + F.exp(-z))
    oof = scored.where(F.col("fold") >= 0).select(
        key, "fold", F.col("ys")[0].alias("label"), F.lit(preset.name).alias("model"), chance(F.get("margins", F.col("fold"))).alias("score")
    )
    mean = sum((chance(F.col("margins")[i]) for i in range(folds)), F.lit(0.0)) / folds
    test = scored.where(F.col("fold") == -1).select(key, F.lit(preset.name).alias("model"), mean.alias("score"))
    splits = done.nodes.where(F.col("feature").isNotNull())
    gains = splits.groupBy("run", "fold", "feature").agg(F.sum("gain").alias("gain"))
    share = F.col("gain") / F.sum("gain").over(W.partitionBy("run", "fold"))
    importance = _every(df.sparkSession, preset, labels, folds, features).join(gains.select("run", "fold", "feature", share.alias("importance")), ["run", "fold", "feature"], "left")
    counted = _every(df.sparkSession, preset, labels, folds, features).join(split_counts(done.nodes, ["run"]), ["run", "fold", "feature"], "left")
    columns = ["model", "feature", "fold", "importance"] if labels == 1 else ["model", "run", "feature", "fold", "importance"]
    return CrossValidation(
        materialize(oof, f"oof-{preset.name}"),
        test,
        importance.fillna(0.0, ["importance"]).select(columns),
        counted.fillna(0.0, ["importance"]).select(columns),
        done.nodes,
        done.staged,
        [done.kept[p * folds : (p + 1) * folds] for p in range(labels)],
        features,
        preset,
    )


def _every(spark: SparkSession, preset: Preset, labels: int, folds: int, features: list[str]) -> DataFrame:
    rows = [(preset.name, p, f, c) for p in range(labels) for f in range(folds) for c in features]
    return spark.createDataFrame(rows, "model string, run int, fold int, feature string")


def auc_log(run: str, oof: DataFrame) -> DataFrame:
    """Metric rows ``(run, model, fold, auc)``; fold NULL is the pooled value."""
    per_fold = auc(oof, "label", "score", ["model", "fold"])
    pooled = auc(oof, "label", "score", ["model"]).withColumn("fold", F.lit(None).cast("int"))
    columns = [F.lit(run).alias("run"), "model", "fold", "rows", "auc"]
    return per_fold.select(*columns).unionByName(pooled.select(*columns))
