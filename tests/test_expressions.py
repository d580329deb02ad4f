"""Edge cases of the null policy and the row expressions."""

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F
from tributary.functions.nulls import fill_for_trees, is_not, nan_to_null, sentinel_to_null
from tributary.functions.pvalue import t_two_sided
from tributary.functions.ratios import payment_features, positive_part, ratio, safe_log10, shifted_ratio
from tributary.functions.recency import within
from tributary.functions.rowstats import row_mean, row_sum, with_row_kurtosis, with_row_std

NAN = float("nan")


def values(df, col):
    return [r[col] for r in df.orderBy("id").select(col).collect()]


def test_null_policy(spark):
    df = spark.createDataFrame(
        [(1, "XNA", 365243.0), (2, None, -5.0), (3, "F", NAN)], "id long, gender string, days double"
    )
    assert values(df.where(is_not("gender", "XNA")), "id") == [2, 3]
    clean = nan_to_null(df).withColumn("days", sentinel_to_null("days"))
    assert values(clean, "days") == [None, -5.0, None]
    filled = fill_for_trees(df.withColumn("inf", F.lit(float("inf"))), ["days", "inf"])
    assert values(filled, "days") == [365243.0, -5.0, -999.0]
    assert values(filled, "inf") == [-999.0] * 3


def test_ratios(spark):
    df = spark.createDataFrame(
        [(1, 4.0, 2.0), (2, 1.0, 0.0), (3, 0.0, 0.0), (4, None, 2.0), (5, 3.0, None), (6, 2.0, -5.0)],
        "id long, a double, b double",
    )
    assert values(df.withColumn("r", ratio("a", "b")), "r") == [2.0, None, None, None, None, -0.4]
    assert values(df.withColumn("r", shifted_ratio(df, "a", "b")), "r") == [4.0 / 7, 0.2, 0.0, None, None, None]
    logs = values(df.withColumn("r", safe_log10("b")), "r")
    assert logs[0] == pytest.approx(math.log10(2)) and logs[1:3] == [None, None] and logs[5] is None
    clamped = df.withColumn("r", positive_part(F.col("b")))
    assert values(clamped, "r") == [2.0, 0.0, 0.0, 2.0, 0.0, 0.0]


def test_payment_features(spark):
    df = spark.createDataFrame(
        [(1, -10, -7, 100.0, 40.0), (2, -10, -30, 0.0, 5.0), (3, -10, None, 8.0, None)],
        "id long, due_day int, paid_day int, due double, paid double",
    )
    out = df.withColumns(payment_features("due_day", "paid_day", "due", "paid"))
    assert values(out, "PAYMENT_PERC") == [0.4, None, None]
    assert values(out, "PAYMENT_DIFF") == [60.0, -5.0, None]
    assert values(out, "DPD") == [3, 0, 0]
    assert values(out, "DBD") == [0, 20, 0]


def test_recency_bounds(spark):
    df = spark.createDataFrame([(1, -90), (2, -91), (3, None), (4, 10)], "id long, day int")
    assert values(df.where(within("day", 90)), "id") == [1, 4]
    assert values(df.where(within("day", 90, strict=True)), "id") == [4]


def test_row_statistics(spark):
    rows = [
        (1, 1.0, 2.0, 4.0, 8.0, 1.0),
        (2, 3.0, 3.0, 3.0, 3.0, 3.0),
        (3, 1.0, None, 2.0, None, 5.0),
        (4, None, None, None, None, None),
        (5, 0.0, 1.0, 0.0, None, 0.0),
    ]
    df = spark.createDataFrame(rows, "id long, d1 double, d2 double, d3 double, d4 double, d5 double")
    cols = ["d1", "d2", "d3", "d4", "d5"]
    frame = pd.DataFrame(rows, columns=["id", *cols]).set_index("id").astype(float)
    kurt = values(with_row_kurtosis(df, cols, "k"), "k")
    assert kurt[0] == pytest.approx(1.581450653983353)
    assert kurt[1] == 0.0 and kurt[2] is None and kurt[3] is None
    assert kurt[4] == pytest.approx(frame.loc[5].kurt())
    std = values(with_row_std(df, cols, "s"), "s")
    want = frame.std(axis=1)
    assert [None if math.isnan(w) else pytest.approx(w) for w in want] == std
    assert values(df.withColumn("m", row_mean(cols)), "m") == [3.2, 3.0, pytest.approx(8 / 3), None, 0.25]
    assert values(df.withColumn("m", row_sum(cols)), "m") == [16.0, 15.0, 8.0, 0.0, 1.0]


def _t_tail(t, dof):
    """Twice the upper tail by Simpson integration over the angle."""
    lo, hi, n = math.atan(abs(t) / math.sqrt(dof)), math.pi / 2, 20_000
    h = (hi - lo) / n
    f = lambda a: math.cos(a) ** (dof - 1)
    s = f(lo) + f(hi) + sum((4 if i % 2 else 2) * f(lo + i * h) for i in range(1, n))
    const = math.exp(math.lgamma((dof + 1) / 2) - math.lgamma(dof / 2)) / math.sqrt(math.pi)
    return 2 * const * s * h / 3


def test_t_pvalue(spark):
    cases = [(t, d) for d in (1, 2, 3, 4, 7, 8, 22, 23, 46) for t in (0.0, 0.3, -1.7, 2.5, 6.0, 14.0, 40.0)]
    df = spark.createDataFrame([(i, float(t), d) for i, (t, d) in enumerate(cases)], "id long, t double, d int")
    got = values(df.withColumn("p", t_two_sided(F.col("t"), F.col("d"))), "p")
    for p, (t, d) in zip(got, cases):
        assert p == pytest.approx(_t_tail(t, d), rel=1e-6, abs=1e-300), (t, d)
    far = spark.range(1).select(t_two_sided(F.lit(200.0), F.lit(22)).alias("p"), F.lit(1).alias("id"))
    assert 0 < values(far, "p")[0] < 1e-30
