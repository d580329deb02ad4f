"""Running totals, quantiles, AUC and folds against brute force, hot groups included."""

import datetime
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from tributary.operators.encode import quantile_bin
from tributary.operators.ordered import exact_median, exact_quantiles, numbered, ranked, running_total
from tributary.operators.rollup import trend_slope
from tributary.operators.selection import permute_label
from tributary.operators.validation import auc, exact_folds, hash_fold


def skewed(n=3000, seed=1):
    """One group holds half the rows and one order value a third of them."""
    rng = np.random.default_rng(seed)
    return pd.DataFrame(
        {
            "id": np.arange(n),
            "g": np.where(rng.random(n) < 0.5, 0, rng.integers(1, 40, n)),
            "at": np.where(rng.random(n) < 0.33, 7, rng.integers(0, 60, n)),
            "x": np.round(rng.normal(size=n), 2),
        }
    )


def test_running_total_with_ties(spark):
    pdf = skewed()
    df = spark.createDataFrame(pdf)
    got = running_total(df, ["g"], "at", "x", out="b", total="t", tie_break="id", cells=16).toPandas()
    want = pdf.sort_values(["g", "at", "id"])
    want["b"] = want.groupby("g")["x"].cumsum() - want["x"]
    want["t"] = want.groupby("g")["x"].transform("sum")
    merged = got.merge(want, on="id", suffixes=("", "_w"))
    assert len(merged) == len(pdf)
    np.testing.assert_allclose(merged["b"], merged["b_w"], atol=1e-9)
    np.testing.assert_allclose(merged["t"], merged["t_w"], atol=1e-9)


def test_hot_value_is_cut_into_many_cells(spark):
    pdf = skewed()
    pdf["at"] = 7
    df = spark.createDataFrame(pdf)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    ranked = running_total(df, [], "at", F.lit(1), out="r", tie_break="id", cells=16)
    sizes = ranked.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < len(pdf) * 0.6
    assert [r["r"] for r in ranked.orderBy("id").collect()] == list(range(len(pdf)))


def test_running_total_null_group_and_empty(spark):
    df = spark.createDataFrame([(1, None, 5), (2, None, 3), (3, "a", 4)], "id long, g string, at int")
    got = {r["id"]: r["b"] for r in running_total(df, ["g"], "at", F.lit(1), out="b").collect()}
    assert got == {1: 1, 2: 0, 3: 0}
    assert running_total(df.limit(0), ["g"], "at", F.lit(1), out="b").count() == 0


KEYS = {
    "string": lambda i: f"k{i % 700:04d}",
    "decimal(38,10)": lambda i: Decimal(i % 700) / 7 + Decimal(10) ** 20,
    "timestamp": lambda i: datetime.datetime(2020, 1, 1) + datetime.timedelta(microseconds=i % 700),
    "binary": lambda i: bytes([i % 700 // 256, i % 256]),
}


@pytest.mark.parametrize("kind", KEYS)
def test_numbers_for_keys_of_any_type(spark, kind):
    """Groups, one of them with a third of all rows, null keys first, ties by a further key."""
    make = KEYS[kind]
    rows = [(i, i % 3 if i % 3 else 100 + i % 5, None if i % 50 == 0 else make(i * 7919 % 3000), f"t{i % 11}") for i in range(3000)]
    df = spark.createDataFrame(rows, f"id long, g int, at {kind}, tie string").repartition(5)
    want = {}
    for g in {r[1] for r in rows}:
        own = sorted((r for r in rows if r[1] == g), key=lambda r: (r[2] is not None, r[2] or 0, r[3], r[0]))
        want |= {r[0]: i for i, r in enumerate(own)}
    got = numbered(df, ["at", "tie", "id"], "r", ["g"])
    assert got.columns == ["id", "g", "at", "tie", "r"] and {r.id: r.r for r in got.collect()} == want
    whole = sorted(r.r for r in numbered(df, ["at"], "r").collect())
    assert whole == list(range(3000)) and numbered(df.limit(0), ["at"], "r", ["g"]).count() == 0
    names = ranked(df.select(F.col("id").cast("string").alias("name"), "g"), ["g"], "name", None, "r").collect()
    for g in {r[1] for r in rows}:
        assert [r.name for r in sorted((r for r in names if r.g == g), key=lambda r: r.r)] == sorted(str(r[0]) for r in rows if r[1] == g)


@pytest.mark.parametrize("parts", [2, 4, 100])
def test_quantiles(spark, parts):
    pdf = skewed()
    df = spark.createDataFrame(pdf)
    got = exact_quantiles(df, "x", parts, ["g"]).toPandas()
    for g, rows in got.groupby("g"):
        want = np.quantile(pdf.loc[pdf.g == g, "x"], np.arange(parts + 1) / parts)
        np.testing.assert_allclose(rows.sort_values("k")["q"], want, atol=1e-9)
    assert len(got) == (parts + 1) * pdf["g"].nunique()


def test_median_of_single_and_missing(spark):
    df = spark.createDataFrame([("a", 3.0), ("a", None), ("b", None), ("c", 1.0), ("c", 2.0)], "g string, x double")
    got = {r["g"]: r["median"] for r in exact_median(df, "x", ["g"]).collect()}
    assert got == {"a": 3.0, "c": 1.5}


def test_quantile_bins(spark):
    xs = [1.0, 1.0, 1.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, None]
    df = spark.createDataFrame(list(enumerate(xs)), "id int, x double")
    got = [r["b"] for r in quantile_bin(df, {"x": "b"}, 4).orderBy("id").collect()]
    assert got == [0, 0, 0, 0, 0, 1, 1, 2, 2, None]
    pdf = skewed()
    got = quantile_bin(spark.createDataFrame(pdf), {"x": "b", "at": "c"}, 100).toPandas().sort_values("id")
    for column, out in (("x", "b"), ("at", "c")):
        want = pd.qcut(pdf[column], 100, labels=False, duplicates="drop")
        assert (got[out].to_numpy() == want.to_numpy()).all()


def rank_auc(y, s):
    r = pd.Series(s).rank().to_numpy()
    p, n = y.sum(), (1 - y).sum()
    return (r[y == 1].sum() - p * (p + 1) / 2) / (p * n)


def test_auc(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"fold": rng.integers(0, 3, 2000), "y": rng.integers(0, 2, 2000)})
    pdf["s"] = np.round(rng.normal(size=2000) + 0.5 * pdf["y"], 1)
    one_class = pd.DataFrame({"fold": 9, "y": 1, "s": [0.1, 0.2]})
    df = spark.createDataFrame(pd.concat([pdf, one_class]))
    got = {r["fold"]: r["auc"] for r in auc(df, "y", "s", ["fold"]).collect()}
    assert got.pop(9) is None
    for f, a in got.items():
        part = pdf[pdf.fold == f]
        assert a == pytest.approx(rank_auc(part["y"].to_numpy(), part["s"].to_numpy()))
    flipped = df.withColumn("s", -F.col("s"))
    total = auc(df, "y", "s").first()["auc"] + auc(flipped, "y", "s").first()["auc"]
    assert total == pytest.approx(1.0)


@pytest.mark.parametrize("cells", [2, 5, 64])
def test_signed_zero_is_one_value(spark, cells):
    rows = [(i, (-1.0, -0.0, 0.0, 1.0)[i % 4], i % 3 % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, s double, y int")
    spark.conf.set("spark.sql.shuffle.partitions", str(max(4, cells // 2)))
    got = auc(df, "y", "s").first()["auc"]
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    s, y = np.array([r[1] for r in rows]) + 0.0, np.array([r[2] for r in rows])
    assert got == pytest.approx(rank_auc(y, s))
    ranks = running_total(df, [], "s", F.lit(1), out="r", tie_break="id", cells=cells).orderBy("id").toPandas()
    want = np.empty(200, dtype=int)
    want[np.lexsort((np.arange(200), s))] = np.arange(200)
    assert (ranks["r"].to_numpy() == want).all()
    halves = exact_quantiles(df, "s", 4, cells=cells).orderBy("k").toPandas()["q"]
    np.testing.assert_allclose(halves, np.quantile(s, [0, 0.25, 0.5, 0.75, 1]))


def test_folds(spark):
    df = spark.range(1000).withColumn("y", (F.col("id") % 4 == 0).cast("int"))
    sizes = exact_folds(df, "id", 12, 1001).groupBy("fold").count().collect()
    assert len(sizes) == 12 and {r["count"] for r in sizes} <= {83, 84}
    per = exact_folds(df, "id", 5, 1001, stratify="y").groupBy("fold", "y").count().collect()
    assert {(r["y"], r["count"]) for r in per} == {(1, 50), (0, 150)}
    folds = df.select(hash_fold("id", 5, 1001).alias("f")).groupBy("f").count().collect()
    assert {r["f"] for r in folds} == set(range(5))


def test_permutation(spark):
    df = spark.range(500).withColumn("y", (F.col("id") < 120).cast("int"))
    a = permute_label(df, "id", "y", 1).toPandas().sort_values("id")
    b = permute_label(df, "id", "y", 2).toPandas().sort_values("id")
    again = permute_label(df, "id", "y", 1).toPandas().sort_values("id")
    assert a["y"].sum() == b["y"].sum() == 120 and len(a) == 500
    assert (a["y"].to_numpy() == again["y"].to_numpy()).all()
    assert (a["y"].to_numpy() != b["y"].to_numpy()).any()
    assert 10 < a["y"].to_numpy()[:120].sum() < 60


def test_trend_slope(spark):
    pdf = skewed()
    got = trend_slope(spark.createDataFrame(pdf), "g", "at", "id", "x", "slope").toPandas().set_index("g")["slope"]
    for g, part in pdf.sort_values(["at", "id"]).groupby("g"):
        want = np.polyfit(part["x"], np.arange(len(part)), 1)[0]
        assert got[g] == pytest.approx(want, rel=1e-6)


def test_median_and_cells_of_a_skewed_table(spark, monkeypatch):
    from tributary.operators import ordered

    pdf = skewed()
    df = spark.createDataFrame(pdf)
    monkeypatch.setattr(ordered, "ROWS_PER_CELL", 10)
    assert ordered.default_cells(df) == -(-len(pdf) // 10)
    got = {r["g"]: r["median"] for r in exact_median(df, "x", ["g"]).collect()}
    assert got == {g: pytest.approx(m) for g, m in pdf.groupby("g")["x"].median().items()}
