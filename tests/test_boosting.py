"""The booster against a brute-force search over all cuts, plain loops for stopping, and a planted signal end to end."""

import hashlib
import math
import random
from dataclasses import replace

import credit_data
import numpy as np
import pytest
from pyspark.sql import functions as F
from tributary.operators import boosting, importance, selection, trees
from tributary.operators.validation import auc
from tributary.plans import credit
from tributary.sources import files

FEATURES = ["signal", "noise", "gap"]


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(7)
    rows = []
    for i in range(600):
        signal = rng.random()
        gap = rng.choice([None, float("nan"), rng.random(), round(rng.random(), 1)])
        y = int(signal + rng.gauss(0, 0.15) > 0.5)
        if gap is None or gap != gap:  # missing values say something
            y = y if rng.random() < 0.7 else 1
        rows.append((i, signal, round(rng.random(), 2), gap, y if i < 450 else None))
    return spark.createDataFrame(rows, "id long, signal double, noise double, gap double, y int").repartition(3)


def small(preset, rounds=8, **changes):
    return replace(preset, **{"rounds": rounds, "depth": 3, "step": 0.3, "min_child_weight": 1.0, **changes})


# --- brute force ---------------------------------------------------------------


def search(codes, g, h, preset, features):
    """Best (gain, feature, cut, missing left) of one node over every cut, or None; the sums are exact."""
    unit = boosting.SCALE

    def q(gs, hs):
        gs = math.copysign(max(abs(gs) - preset.l1 * unit, 0), gs)
        return gs * gs / (hs + preset.l2 * unit) / unit if hs + preset.l2 * unit > 0 else 0.0

    best, total = None, (sum(g), sum(h))
    for j in features:
        column = [r[j] for r in codes]
        for cut in sorted(set(column) - {0}):  # cuts after bins that have rows
            for missing_left in (False, True):
                side = [c <= cut and c > 0 or c == 0 and missing_left for c in column]
                gl, hl, nl = sum(a for a, s in zip(g, side) if s), sum(a for a, s in zip(h, side) if s), sum(side)
                if preset.growth != "symmetric" and not (0 < nl < len(side) and min(hl, total[1] - hl) >= preset.min_child_weight * unit):
                    continue
                gain = q(gl, hl) + q(total[0] - gl, total[1] - hl) - q(*total)
                key = (gain, -j, -cut, not missing_left)
                if best is None or key > best[0]:
                    best = key, (j, cut, missing_left)
    return best and (best[0][0], *best[1])


def goes_left(row, j, cut, missing_left):
    return missing_left if row[j] == 0 else row[j] <= cut


def grow_plainly(codes, g, h, preset, sizes, features):
    """{node: (feature, cut, missing left)} and the order in which nodes were split, one node at a time."""
    members = {1: list(range(len(codes)))}
    found, order = {}, []
    best = lambda n: search([codes[i] for i in members[n]], [g[i] for i in members[n]], [h[i] for i in members[n]], preset, features) if members[n] else None

    def divide(n, j, cut, missing_left):
        found[n] = (j, cut, missing_left)
        members[2 * n] = [i for i in members[n] if goes_left(codes[i], j, cut, missing_left)]
        members[2 * n + 1] = [i for i in members[n] if not goes_left(codes[i], j, cut, missing_left)]
        order.append(n)

    if preset.growth == "symmetric":
        for level in range(preset.depth):
            nodes = [n for n in members if n.bit_length() == level + 1]
            options = {}
            for j in features:
                for cut in range(1, sizes[j]):
                    for missing_left in (False, True):
                        options[j, cut, missing_left] = sum(one_gain(codes, g, h, members[n], preset, j, cut, missing_left) for n in nodes)
            (j, cut, missing_left), gain = max(options.items(), key=lambda o: (o[1], -o[0][0], -o[0][1], not o[0][2]))
            if gain / 2**20 <= preset.min_gain:
                break
            for n in nodes:
                divide(n, j, cut, missing_left)
        return found, order
    frontier = [1]
    while frontier and (preset.growth != "leaf" or len(order) < preset.leaves - 1):
        options = [(b[0], -n, b[1:]) for n in frontier if n < 1 << preset.depth and (b := best(n)) and b[0] > preset.min_gain]
        if not options:
            break
        _, n, split = max(options)
        divide(-n, *split)
        frontier = [m for m in frontier if m != -n] + [-2 * n, -2 * n + 1]
    return found, order


def one_gain(codes, g, h, rows, preset, j, cut, missing_left):
    unit = boosting.SCALE
    q = lambda gs, hs: gs * gs / (hs + preset.l2 * unit) / unit
    left = [i for i in rows if goes_left(codes[i], j, cut, missing_left)]
    gl, hl, gt, ht = sum(g[i] for i in left), sum(h[i] for i in left), sum(g[i] for i in rows), sum(h[i] for i in rows)
    return round((q(gl, hl) + q(gt - gl, ht - hl) - q(gt, ht)) * 2**20)


def taking_part(preset, tree, i):
    return int(hashlib.md5(f"{preset.seed}_{tree}_{i}".encode()).hexdigest()[:13], 16) < int(preset.row_share * 2**52)


@pytest.mark.parametrize(
    "preset",
    [
        replace(boosting.DEPTHWISE, bins=12, rounds=2, step=0.3),
        replace(boosting.LEAFWISE, bins=12, rounds=2, leaves=7, min_child_weight=3.0, step=0.3),
        replace(boosting.LEAFWISE, bins=9, rounds=1, leaves=32, min_child_weight=0.5, l1=0.5),
        replace(boosting.SYMMETRIC, bins=8, rounds=2, depth=4, step=0.3),
        replace(boosting.SYMMETRIC, bins=8, rounds=1, depth=3, fill=None),
    ],
    ids=lambda p: f"{p.growth}-{p.leaves}-{p.fill}",
)
def test_trees_equal_brute_force(spark, planted, preset):
    store, cuts = boosting.binned(planted, "id", "y", FEATURES, preset, 2)
    done = boosting.train(store, "id", 1, FEATURES, cuts, preset, 2, early_stopping=False)
    rows = {r.id: r for r in store.where("fold >= 0").collect()}
    sizes = [len(c) + 2 for c in cuts]
    margins = {i: list(done.starts) for i in rows}
    all_codes = np.array([list(r.codes) for r in rows.values()], np.uint8)
    for number, made in enumerate(done.trees):
        features = boosting.sampled_features(len(FEATURES), preset, number)
        for m, tree in made.items():
            ids = [i for i, r in rows.items() if r.fold != m and taking_part(preset, number, i)]
            g, h = boosting.gradients(np.array([rows[i].ys[0] for i in ids]), np.array([margins[i][m] for i in ids]), preset.positive_weight)
            codes = [list(rows[i].codes) for i in ids]
            want, order = grow_plainly(codes, [int(v) for v in g], [int(v) for v in h], preset, sizes, features)
            split = {n: (int(tree.feature[n]), int(tree.cut[n]), bool(tree.missing_left[n])) for n in np.flatnonzero(tree.feature >= 0)}
            assert split == {n: s for n, s in want.items()}
            table = {r.node: r for r in done.nodes.where(f"fold = {m} and tree = {number}").collect()}
            assert {n for n, r in table.items() if r.feature is not None} == set(want)
            scores = dict(zip(rows, tree.scores(all_codes), strict=True))
            for i, r in rows.items():  # every row walks down the node table to the value that the arrays give
                n = 1
                while table[n].feature is not None:
                    code = r.codes[FEATURES.index(table[n].feature)]
                    n = table[n].left if goes_left({0: code}, 0, want[n][1], table[n].missing_left) else table[n].right
                assert scores[i] == table[n].value
            if preset.growth == "leaf":
                grower = boosting.Grower(preset, tree)
                assert len(want) <= preset.leaves - 1 and order[0] == 1 and grower.order() == []
        for m, tree in made.items():
            for i, score in zip(rows, tree.scores(all_codes), strict=True):
                margins[i][m] += score


def test_leaves_split_best_first():
    """The order is that of a queue, although nodes become known level by level."""
    rng = random.Random(4)
    for _ in range(50):
        preset = replace(boosting.LEAFWISE, depth=6, leaves=rng.randrange(2, 20), min_gain=0.1)
        gains = {n: rng.choice([rng.random(), 0.05, 0.5]) for n in range(1, 64)}
        grower, steps = boosting.Grower(preset, trees.Tree(6)), 0
        unknown = [1]
        while unknown:
            for n in unknown:
                grower.known[n] = boosting.Split(gains[n], 0, 1, False, boosting.Sums(0, 0, 1), boosting.Sums(0, 0, 2))
            unknown = [c for n in grower.expand() for c in (2 * n, 2 * n + 1)]
            steps += 1
        want, frontier = [], {1}
        while len(want) < preset.leaves - 1 and any(gains.get(n, 0) > 0.1 for n in frontier):
            n = max(frontier, key=lambda n: (gains.get(n, 0), -n))
            want.append(n)
            frontier = frontier - {n} | {2 * n, 2 * n + 1}
        assert grower.order() == want and steps <= 6


def test_missing_values_choose_a_side(spark):
    """Missing rows are mostly ones, so they belong to the side of the high values, which no filler below all values could give."""
    rows = [(i, None if i % 3 == 0 else float(i % 50), int(i % 3 == 0 or i % 50 >= 25)) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, x double, y int")
    for flip in (False, True):
        each = df.withColumn("x", -F.col("x")) if flip else df
        preset = replace(boosting.DEPTHWISE, depth=1, rounds=1, row_share=1.0, column_share=1.0)
        cv = boosting.cross_validate(each, "id", "y", ["x"], preset, 2, early_stopping=False)
        assert {r.missing_left for r in cv.nodes.where("node = 1").collect()} == {flip}
        assert auc(cv.oof, "label", "score").first()["auc"] > 0.999


# --- stopping, scores, reports -----------------------------------------------


def test_stopping_rounds_equal_a_plain_loop():
    rng = random.Random(1)
    for _ in range(500):
        scores = [rng.choice([None, 0.5, 0.6, rng.random()]) for _ in range(rng.randrange(1, 40))]
        patience = rng.choice([1, 3, 10])
        best, at, stop = -1.0, None, None
        for i, s in enumerate(scores):
            if s is not None and s > best:
                best, at = s, i
            if at is not None and i - at >= patience:
                stop = i + 1
                break
        assert boosting.stopping_rounds(scores, patience) == ((len(scores) if at is None else at + 1), stop)
    late = [0.5] * 10 + [0.6] + [0.55] * 200
    assert boosting.stopping_rounds(late, 200) == (11, 211) and boosting.stopping_rounds(late[:-1], 200) == (11, None)
    assert boosting.stopping_rounds(late, 45) == (11, 56)


def test_out_of_fold(spark, planted):
    cv = boosting.cross_validate(planted, "id", "y", FEATURES, small(boosting.DEPTHWISE, 4), 3, early_stopping=False)
    oof = cv.oof.toPandas()
    assert len(oof) == 450 and oof["id"].is_unique and set(oof["fold"]) == {0, 1, 2}
    assert oof["score"].between(0, 1).all()
    assert auc(cv.oof, "label", "score").first()["auc"] > 0.85
    test = cv.test.toPandas()
    assert sorted(test["id"]) == list(range(450, 600)) and test["score"].between(0, 1).all()
    shares = cv.importance.groupBy("fold").agg(F.sum("importance").alias("s")).collect()
    assert len(shares) == 3 and all(abs(r["s"] - 1) < 1e-9 for r in shares)
    best = importance.mean_importance(cv.importance).orderBy(F.desc("importance")).first()["feature"]
    assert best == "signal"
    counts = {r["feature"] for r in importance.split_counts(cv.nodes).collect()}
    assert "signal" in counts and counts <= set(FEATURES)
    log = {(r["model"], r["fold"]): r["auc"] for r in boosting.auc_log("t", cv.oof).collect()}
    assert set(log) == {("xgb", 0), ("xgb", 1), ("xgb", 2), ("xgb", None)}


def test_patience_on_auc_and_best_prefix(spark, planted):
    """Blocks of any size stop at the same rounds, and scores are those of the best prefix."""
    short = small(boosting.SYMMETRIC, 7, patience=2, depth=2)
    runs = [boosting.cross_validate(planted, "id", "y", FEATURES, short, 3, block=b) for b in (2, 7)]
    assert runs[0].kept == runs[1].kept
    same = lambda cv: sorted((r.id, r.score) for r in cv.oof.collect())
    assert same(runs[0]) == same(runs[1])
    staged = {}
    for r in runs[1].staged.orderBy("round").collect():
        staged.setdefault(r.fold, []).append(r.auc)
    assert runs[1].kept[0] == [boosting.stopping_rounds(staged[f], 2)[0] for f in range(3)]
    per_fold = {r.fold: r.auc for r in auc(runs[1].oof, "label", "score", ["fold"]).collect()}
    assert all(abs(per_fold[f] - max(staged[f][: runs[1].kept[0][f]])) < 1e-12 for f in range(3))
    last = {r.fold: r.t for r in runs[1].nodes.groupBy("fold").agg(F.max("tree").alias("t")).collect()}
    assert [last[f] + 1 for f in range(3)] == runs[1].kept[0]


def test_path_interactions_equal_a_walk(spark, planted):
    cv = boosting.cross_validate(planted, "id", "y", FEATURES, small(boosting.DEPTHWISE, 3), 2, early_stopping=False)
    nodes = {(r.fold, r.tree, r.node): r for r in cv.nodes.collect()}
    want = {}
    for (fold, tree, node), r in nodes.items():
        run, n = [], node
        while n >= 1 and len(run) < 3 and nodes[fold, tree, n].feature is not None:
            run.append(nodes[fold, tree, n])
            key = fold, len(run), "|".join(sorted(x.feature for x in run))
            old = want.get(key, (0.0, 0, 0.0, 0))
            want[key] = old[0] + sum(x.gain for x in run), old[1] + 1, old[2] + r.rows / nodes[fold, tree, 1].rows, old[3] + r.rows
            n //= 2
    got = {(r.fold, r.order, r.features): (r.gain, r.times, r.weighted_times, r.rows) for r in trees.interactions(cv.nodes).collect()}
    assert set(got) == set(want) and any(k[1] == 3 for k in got)
    assert all(np.allclose(got[k], want[k]) for k in want)


def test_no_rows_and_one_class(spark, planted):
    with pytest.raises(ValueError):
        boosting.cross_validate(planted, "id", "y", [], small(boosting.DEPTHWISE), 3)
    ones = planted.withColumn("y", F.when(F.col("y").isNotNull(), F.lit(1)))
    cv = boosting.cross_validate(ones, "id", "y", FEATURES, small(boosting.LEAFWISE, 2), 2)
    assert cv.oof.count() == 450 and cv.kept == [[2, 2]]
    none = boosting.cross_validate(planted.where("y is null"), "id", "y", FEATURES, small(boosting.DEPTHWISE, 2), 2)
    assert none.oof.count() == 0 and {r.score for r in none.test.collect()} == {0.5} and none.nodes.count() == 0


# --- null importances and the credit job -----------------------------------------


def test_permuted_labels_together_equal_each_alone(spark, planted):
    known = planted.where("y is not null").select("id", "y")
    together = {r.id: r.labels for r in selection.permute_labels(known, "id", "y", [5, 6, 7]).collect()}
    for p, seed in enumerate((5, 6, 7)):
        alone = {r.id: r.y for r in selection.permute_label(known, "id", "y", seed).collect()}
        assert {i: labels[p] for i, labels in together.items()} == alone
    labelled = planted.join(spark.createDataFrame([(i, *labels) for i, labels in together.items()], "id long, y0 int, y1 int, y2 int"), "id", "left")
    preset = small(boosting.DEPTHWISE, 2, depth=2)
    at_once = boosting.cross_validate(labelled, "id", ["y", "y0", "y1", "y2"], FEATURES, preset, 2, early_stopping=False)
    for run, label in enumerate(("y", "y1")):
        run = {0: 0, 1: 2}[run]
        single = boosting.cross_validate(labelled, "id", label, FEATURES, preset, 2, early_stopping=False)
        key = lambda r: (r.fold, r.tree, r.node, r.feature, r.cut, r.value, r.gain)
        assert sorted(map(repr, map(key, at_once.nodes.where(F.col("run") == run).collect()))) == sorted(map(repr, map(key, single.nodes.collect())))


def test_null_importance_selection(spark, planted):
    table = planted.withColumnRenamed("id", "SK_ID_CURR").withColumnRenamed("y", "TARGET")
    found = credit.null_importances(table, small(boosting.DEPTHWISE, 4, depth=2), folds=4, permutations=2, early_stopping=False, kind="gain")
    assert {(r["run"], r["count"]) for r in found.groupBy("run").count().collect()} == {("actual", 12), ("null", 24)}
    kept, tested = credit.select_by_null_importance(table, found, require_gain=True)
    assert "signal" in kept.columns and "noise" not in kept.columns
    assert kept.count() == 600 and tested.count() == 3


def test_credit_levels_end_to_end(spark, tmp_path):
    tables = credit_data.to_spark(spark, credit_data.make(80))
    presets = [small(p, 1, depth=2) for p in (boosting.DEPTHWISE, boosting.SYMMETRIC)]
    level1 = credit.level1_matrix(tables)
    prior = spark.createDataFrame(
        [(c, 20.0 if i < 12 else 1.0) for i, c in enumerate(level1.columns[2:])], "feature string, importance double"
    )
    level1 = credit.level1_matrix(tables, prior_importance=prior)
    assert len(level1.columns) <= 14
    runs = credit.train_models(level1, presets, 2, str(tmp_path), early_stopping=False)
    scores = runs["xgb"].predictions("SK_ID_CURR").unionByName(runs["cat"].predictions("SK_ID_CURR"))
    level2 = credit.level2_matrix(tables, scores, ["xgb", "cat"])
    rows = level2.select("SK_ID_CURR", "TARGET", "xgb", "cat").toPandas()
    assert len(rows) == 79 and rows[["xgb", "cat"]].notna().all().all()
    assert spark.read.parquet(f"{tmp_path}/level1/metrics").count() == 6
    # What training writes is what pruning reads: counts, with 0 for features that never split.
    written = files.read_importance(spark, f"{tmp_path}/level1/fimp_xgb")
    assert written.count() == len(level1.columns) - 2
    pruned = credit.level1_matrix(tables, prior_importance=written, threshold=0.0)
    assert 2 < len(pruned.columns) <= len(level1.columns)
    narrowed = level2.select("SK_ID_CURR", "TARGET", "xgb", "cat", "f70", "CODE_GENDER")
    again = credit.train_models(narrowed, [small(boosting.LEAFWISE, 1, depth=2)], 2, early_stopping=False)
    assert again["lgb"].oof.count() == rows["TARGET"].notna().sum()
