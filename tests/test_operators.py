"""Windowed aggregation, encoders, lookups, assembly and selection on tiny frames."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from tributary.functions.nulls import nan_to_null
from tributary.operators import assemble, encode, importance, lookup, rollup, selection
from tributary.operators.aggspec import ALL6
from tributary.operators.windowed import Slices, Windows, spread, trend_ratio, windowed_agg

HISTORY = [
    (1, -90, "A", 10.0, 2),
    (1, -91, "A", 30.0, 2),
    (1, -5, "C", None, 3),
    (2, -400, "A", 7.0, 1),
    (3, -10, None, None, 4),
    (3, -20, "C", None, None),
    (4, None, "A", 1.0, 1),
    (4, 30, "A", 5.0, 1),
]
SCHEMA = "id long, day int, status string, amount double, version int"


def test_windowed_edges(spark):
    df = spark.createDataFrame(HISTORY, SCHEMA)
    slices = Slices("status", {"ALL": None, "ACTIVE": "A"})
    long = windowed_agg(
        df, "id", {"amount": ALL6, "version": ("nunique",)}, Windows("day", (90, 180)), slices, size="ROWS"
    )
    got = {(r["id"], r["window"], r["slice"]): r for r in long.collect()}
    first = got[(1, "90", "ALL")]
    assert (first["amount_MEAN"], first["amount_COUNT"], first["ROWS"], first["amount_VAR"]) == (10.0, 1, 2, None)
    assert first["version_NUNIQUE"] == 2
    assert got[(1, "180", "ALL")]["amount_VAR"] == pytest.approx(200.0)
    assert got[(1, "180", "ACTIVE")]["version_NUNIQUE"] == 1
    assert (2, "180", "ALL") not in got and got[(2, "False", "ALL")]["amount_SUM"] == 7.0
    empty = got[(3, "90", "ALL")]
    assert (empty["amount_SUM"], empty["amount_COUNT"], empty["amount_MEAN"], empty["amount_MAX"]) == (0.0, 0, None, None)
    assert (3, "False", "ACTIVE") not in got
    # No offset: all-time window only.  A future offset is inside every window.
    assert got[(4, "90", "ALL")]["amount_SUM"] == 5.0 and got[(4, "False", "ALL")]["amount_SUM"] == 6.0


def test_windowed_against_pandas_with_a_hot_entity(spark):
    rng = np.random.default_rng(0)
    n = 6000
    pdf = pd.DataFrame(
        {
            "id": np.where(rng.random(n) < 0.4, 1, rng.integers(2, 300, n)),
            "day": -rng.integers(0, 400, n),
            "x": 1e7 + rng.normal(size=n),
            "v": rng.integers(0, 9, n),
        }
    )
    long = windowed_agg(
        spark.createDataFrame(pdf), "id", {"x": ALL6, "v": ("nunique",)}, Windows("day", (90, 180, 270))
    ).toPandas()
    assert long.groupby("window")["x_COUNT"].sum().loc["False"] == n
    for label, limit in (("90", 90), ("180", 180), ("270", 270), ("False", 10_000)):
        seen = pdf[pdf["day"] >= -limit].groupby("id")
        got = long[long["window"] == label].set_index("id").sort_index()
        assert (got["x_COUNT"] == seen["x"].count()).all()
        assert (got["v_NUNIQUE"] == seen["v"].nunique()).all()
        # A mean near 1e7 is only exact to about 1e-9, which bounds the spread.
        np.testing.assert_allclose(got["x_VAR"], seen["x"].var(), rtol=1e-6, atol=1e-8)
        np.testing.assert_allclose(got["x_MEAN"], seen["x"].mean(), rtol=1e-12)


def test_spread_and_trend(spark):
    df = spark.createDataFrame(HISTORY, SCHEMA)
    long = windowed_agg(df, "id", {"amount": ("sum", "count")}, Windows("day", (90,)))
    wide = trend_ratio(spread(long, "id", ["90", "False"]), "90", "False")
    got = {r["id"]: r for r in wide.collect()}
    assert got[1]["fc_amount_SUM"] == pytest.approx(0.25) and got[2]["fc_amount_SUM"] is None
    assert got[2]["90_amount_COUNT"] is None and got[2]["False_amount_COUNT"] == 1
    kept = spread(long, "id", ["90", "False"], keep=lambda n: n.endswith("SUM"))
    assert kept.columns == ["id", "90_amount_SUM", "False_amount_SUM"]


def test_encoders(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "a"), (4, "b.c")], "id long, c string")
    wide, new = encode.one_hot(df)
    assert new == ["c_a", "c_b", "c_b_c", "c_nan"]
    rows = [r.asDict() for r in wide.orderBy("id").collect()]
    assert all(sum(r[n] for n in new) == 1 for r in rows) and rows[1]["c_nan"] == 1
    codes = [r["c"] for r in encode.ordinal_encode(df, ["c"]).orderBy("id").collect()]
    assert codes == [1, -1, 0, 2]
    with pytest.raises(ValueError):
        encode.vocabulary(df, ["c"], limit=2)
    ints = spark.createDataFrame(
        [(1, 126, 127, 40_000, None, 5), (2, -127, 0, 0, None, 3_000_000_000)],
        "SK_ID_X long, a long, b long, c long, d long, e long",
    )
    assert [t for _, t in encode.narrow_types(ints).dtypes] == ["bigint", "tinyint", "smallint", "int", "bigint", "bigint"]
    assert encode.narrow_types(ints).collect() == ints.collect()


def test_one_hot_keeps_clashing_values_apart(spark):
    rows = [("a.b", "C"), ("a_b", "c"), ("nan", "C"), (None, "c"), ("Y", None), ("y", "C")]
    df = spark.createDataFrame(rows, "A string, A_B string").withColumn("c_nan", F.lit(1))
    wide, new = encode.one_hot(df.withColumnRenamed("A", "c"))
    assert len(new) == len({n.lower() for n in new}) == 6 + 3 and "c_nan" not in new
    made = [r.asDict() for r in wide.collect()]
    assert all(sum(r[n] for n in new) == 2 for r in made) and all(r["c_nan"] == 1 for r in made)
    joined, new = encode.one_hot(spark.createDataFrame([("B_C", "C"), ("x", "y")], "A string, A_B string"), missing_column=False)
    assert len(set(new)) == 4 and all(sum(r) == 2 for r in joined.collect())


def test_many_categories_and_groups(spark):
    df = spark.range(40_000).select("id", F.concat(F.lit("v"), F.lpad((F.col("id") % 5000).cast("string"), 4, "0")).alias("c"), (F.col("id") % 20_000).alias("g"))
    assert encode.ordinal_encode(df, ["c"]).where(F.col("c") != F.col("id") % 5000).count() == 0
    shares = rollup.category_share_long(df.withColumn("g", F.col("id") % 2), "g", "c")
    assert shares.count() == 5000 and shares.where(F.abs(F.col("share") - 1 / 2500) > 1e-12).count() == 0
    both = lookup.group_stats(df.withColumn("x", F.col("g").cast("double")), ["g"], ["x"])
    assert both.count() == 40_000 and both.where((F.col("g_x_f1_mean") != F.col("g")) | (F.col("g_x_f1_std") != 0)).count() == 0
    medians = lookup.group_median(df, "g", "id", "m")
    assert medians.where(F.col("m") != F.col("g") + 10_000).count() == 0


def test_group_statistics(spark):
    rows = [(1, "a", "x", 1.0), (2, "a", None, 4.0), (3, "b", "x", None), (4, None, "y", 7.0), (5, "a", "x", 10.0)]
    df = spark.createDataFrame(rows, "id long, c string, d string, v double")
    got = {r["id"]: r for r in lookup.group_stats(df, ["c", "d"], ["v"]).collect()}
    assert got[1]["c_v_f1_mean"] == 5.0 and got[1]["c_v_f1_std"] == pytest.approx(np.std([1, 4, 10], ddof=1))
    assert got[3]["c_v_f1_mean"] is None and got[4]["c_v_f1_mean"] is None
    assert got[1]["d_v_f1_mean"] == 5.5 and got[4]["d_v_f1_std"] is None
    medians = {r["id"]: r["m"] for r in lookup.group_median(df, "c", "v", "m").collect()}
    assert medians == {1: 4.0, 2: 4.0, 3: None, 4: None, 5: 4.0}


def test_target_encoding_leaves_own_fold_out(spark):
    rows = [(1, "a", 1, 0), (2, "a", 0, 0), (3, "a", 1, 1), (4, "b", 1, 1), (5, "a", None, None), (6, "a", 1, 2)]
    df = spark.createDataFrame(rows, "id long, c string, y int, f int")
    got = {r["id"]: r for r in lookup.target_encode(df, "c", "y", "f", 3).collect()}
    assert got[1]["c_y_avg"] == 1.0 and got[1]["c_y_std"] == 0.0
    assert got[3]["c_y_avg"] == pytest.approx(2 / 3) and got[4]["c_y_avg"] is None
    assert got[5]["c_y_avg"] == 0.75 and got[5]["c_y_std"] == pytest.approx(0.5)


def test_rollups_count_missing(spark):
    rows = [(1, 10, 0.0, 5.0, 6.0), (1, 10, None, 5.0, 4.0), (1, 11, 2.0, None, 1.0), (2, 12, 0.0, 5.0, None)]
    df = spark.createDataFrame(rows, "id long, loan long, dpd double, due double, paid double")
    mean = {r["id"]: r["m"] for r in rollup.nonzero_then_mean(df, "id", "loan", "dpd", "m").collect()}
    assert mean == {1: 1.0, 2: 0.0}
    pct = {r["id"]: r["p"] for r in rollup.missed_payment_pct(df, "id", "due", "paid", "p").collect()}
    assert pct == {1: pytest.approx(100 / 3), 2: 0.0}
    total = {r["id"]: r["t"] for r in rollup.max_then_sum(df, "id", "loan", "paid", "t").collect()}
    assert total == {1: 7.0, 2: 0.0}


def test_assembly(spark):
    train = spark.createDataFrame([(1, 0, 5)], "SK_ID_CURR long, TARGET int, a int")
    test = spark.createDataFrame([(2, 6)], "SK_ID_CURR long, a int")
    both = assemble.union_train_test(train, test)
    left, right = assemble.split_train_test(both)
    assert (left.count(), right.count()) == (1, 1) and right.first()["TARGET"] is None
    names = ["90_bb_X", "False_bb_X", "12_instpay_X", "X", "90_bb_Y"]
    frame = spark.createDataFrame([(1,) * 5], names)
    assert assemble.drop_blacklist(frame, ["X", ""]).columns == ["False_bb_X", "X", "90_bb_Y"]
    flags = spark.createDataFrame([(1, 1, "Y", 1)], "FLAG_DOCUMENT_2 int, FLAG_MOBIL int, FLAG_OWN_CAR string, X_FLAG_Y int")
    assert assemble.document_flags(flags) == ["FLAG_DOCUMENT_2"] and assemble.contact_flags(flags) == ["FLAG_MOBIL"]
    preds = spark.createDataFrame(
        [(1, "m", 0.2), (1, "m", 0.4), (2, "n", 0.9)], "SK_ID_CURR long, model string, score double"
    )
    got = {r["SK_ID_CURR"]: r for r in assemble.stack_features(both, "SK_ID_CURR", preds, ["m", "n"]).collect()}
    assert got[1]["m"] == pytest.approx(0.3) and got[1]["n"] is None and got[2]["n"] == 0.9


def test_selection(spark):
    rows = []
    for fold in range(4):
        rows += [("actual", "same", fold, 1.0 + fold), ("null", "same", fold, 1.0 + fold)]
        rows += [("actual", "flat", fold, 2.0), ("null", "flat", fold, 1.0)]
        rows += [("actual", "worse", fold, 1.0 + fold / 100), ("null", "worse", fold, 9.0 + fold / 100)]
        rows += [("actual", "good", fold, 9.0 + fold / 100), ("null", "good", fold, 0.0 + fold * 0.0001)]
        rows += [("actual", "zero", fold, 1.0 + fold), ("null", "zero", fold, 0.0)]
    df = spark.createDataFrame(rows, "run string, feature string, fold int, importance double")
    got = {r["feature"]: r for r in selection.importance_ttest(df).collect()}
    assert got["same"]["pvalues"] == pytest.approx(1.0) and got["same"]["padj"] == 1.0
    assert got["flat"]["pvalues"] is None and got["flat"]["padj"] is None
    assert got["zero"]["fc"] is None and got["zero"]["pvalues"] is not None
    assert all(r["padj"] is None or r["padj"] >= r["pvalues"] for r in got.values())
    kept = lambda **k: {r["feature"] for r in selection.select_features(selection.importance_ttest(df), **k).collect()}
    assert kept() == {"worse", "good", "zero"} and kept(require_gain=True) == {"good", "zero"}


def test_importance_tables(spark):
    rows = [(f"f{i}", fold, float(i + fold)) for i in range(5) for fold in range(3)]
    df = spark.createDataFrame(rows, "feature string, fold int, importance double")
    assert {r["feature"] for r in importance.top_features(df, 2).collect()} == {"f3", "f4"}
    wide = importance.to_wide(df, 3)
    assert wide.columns == ["f", "fold0", "fold1", "fold2"]
    back = importance.to_long(wide, "actual").select("feature", "fold", "importance")
    assert sorted(back.collect()) == sorted(df.collect())
    assert nan_to_null(df).columns == df.columns
    assert {r["feature"] for r in importance.above_threshold(df, 3.5).collect()} == {"f3", "f4"}
