"""Registered queries: each operator on the supplied tables, whole tables only."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.nulls import is_not, sentinel_to_null
from ..functions.ratios import (
    global_value,
    payment_features,
    positive_part,
    product,
    ratio,
    safe_log10,
    shifted_ratio,
)
from ..functions.recency import since, within
from ..functions.rowstats import row_mean, row_sum, with_row_kurtosis, with_row_std
from ..operators import aggspec, assemble, boosting, encode, importance, lookup, ordered, rollup, selection, trees
from ..operators.validation import auc, exact_folds, hash_fold
from ..operators.windowed import ALL_WINDOW, Slices, Windows, spread, trend_ratio, windowed_agg
from ..sources.tables import (
    EVENT_ANCHOR,
    ORDER_ANCHOR,
    event_history,
    labelled_documents,
    line_history,
    order_history,
    table,
)
from . import credit

DAYS = (90, 180, 270, 360)
EVENT_DAYS = (7, 14, 21)
SEED = 1001


def rounded(col: Column | str, digits: int) -> Column:
    """Rounded for comparison across engines.

    Means of cents often end exactly on a rounding tie, where the last float bit
    decides; a nudge of about a hundredth of the last digit settles ties upwards in
    both engines.  Adding zero turns -0.0 into 0.0.
    """
    value = F.col(col) if isinstance(col, str) else col
    return F.round(value + F.lit(float(f"1.23e-{digits + 2}")), digits) + F.lit(0.0)


def _tidy(df: DataFrame, digits: dict[str, int], scale: dict[str, float] | None = None) -> DataFrame:
    """Round columns by name suffix; squared quantities are first scaled down."""
    scale = scale or {}

    def tidy(name: str) -> Column:
        for suffix, d in digits.items():
            if name.endswith(suffix):
                return rounded(F.col(name) / F.lit(scale.get(suffix, 1.0)), d).alias(name)
        return F.col(name)

    return df.select(*[tidy(c) for c in df.columns])


_MONEY = {"_MAX": 4, "_MIN": 4, "_MEAN": 4, "_SUM": 2, "_VAR": 4, "_PERC": 6}
_MONEY_SCALE = {"_VAR": 1e6}


def _money(df: DataFrame) -> DataFrame:
    return _tidy(df, _MONEY, _MONEY_SCALE)


# --- scans, unions, filters -------------------------------------------------


def scan_entity(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")


def scan_limit(spark: SparkSession, sf: str) -> DataFrame:
    return scan_entity(spark, sf).orderBy("c_custkey").limit(10)


def _train_and_test(spark: SparkSession, sf: str) -> DataFrame:
    docs = labelled_documents(spark, sf).select("doc_id", "lang", "source", "n_chars", "TARGET")
    train, test = assemble.split_train_test(docs)
    return assemble.union_train_test(train, test.drop("TARGET"))


def union_train_test(spark: SparkSession, sf: str) -> DataFrame:
    return _train_and_test(spark, sf).select("doc_id", "lang", "source", "n_chars", "TARGET", "is_train")


def split_counts(spark: SparkSession, sf: str) -> DataFrame:
    docs = labelled_documents(spark, sf)
    side = F.when(F.col("TARGET").isNotNull(), "train").otherwise("test")
    return docs.groupBy(side.alias("side")).agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


def filter_invalid(spark: SparkSession, sf: str) -> DataFrame:
    return scan_entity(spark, sf).where(is_not("c_mktsegment", "MACHINERY"))


def sentinel_query(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_returnflag", sentinel_to_null("l_quantity", 50.0).alias("q"))
    return lines.groupBy("l_returnflag").agg(
        F.count("q").alias("n_present"), F.count(F.lit(1)).alias("n_rows"), rounded(F.avg("q"), 6).alias("q_mean")
    )


def recency_orders(spark: SparkSession, sf: str) -> DataFrame:
    recent = order_history(spark, sf).where(since("o_orderdate", ORDER_ANCHOR, 360))
    return recent.select("o_orderkey", "o_custkey", "DAYS_CREDIT", "o_totalprice")


def recency_events(spark: SparkSession, sf: str) -> DataFrame:
    return event_history(spark, sf).where(since("ts", EVENT_ANCHOR, 14)).select("event_id", "user_id", "DAYS_EVENT", "value")


def recency_prev(spark: SparkSession, sf: str) -> DataFrame:
    # DAYS_INSTALMENT lies 30 days after the order, so the window is a bound on the order date that the scan can use.
    recent = line_history(spark, sf).where(since("o_orderdate", ORDER_ANCHOR, 90 + 30, strict=True))
    return recent.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "DAYS_INSTALMENT", "l_extendedprice")


# --- row expressions --------------------------------------------------------

_LINE_ID = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def ratio_features(spark: SparkSession, sf: str) -> DataFrame:
    return line_history(spark, sf).select(
        *_LINE_ID,
        rounded(ratio("l_extendedprice", "o_totalprice"), 8).alias("price_share"),
        rounded(ratio("l_extendedprice", F.lit(1) + F.col("l_quantity")), 4).alias("price_per_unit"),
        rounded(ratio("l_extendedprice", F.col("o_totalprice") + F.col("l_quantity")), 8).alias("price_over_sum"),
        rounded(ratio("l_tax", "l_discount"), 6).alias("tax_to_discount"),
        rounded(ratio("l_discount", "l_tax"), 6).alias("discount_to_tax"),
        rounded(product("l_quantity", "l_discount", "l_tax"), 8).alias("three_way_product"),
        rounded(ratio(safe_log10(safe_log10("l_extendedprice")), safe_log10(safe_log10("o_totalprice"))), 8).alias(
            "loglog_ratio"
        ),
        rounded(product(ratio("l_tax", "l_discount"), ratio("l_discount", "l_tax")), 6).alias("ratio_product"),
    )


_ROW_COLUMNS = ["l_quantity", "l_linenumber", "l_discount", "l_tax"]


def row_kurtosis_query(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    made = with_row_kurtosis(lines, _ROW_COLUMNS, "kurt")
    return made.select(*_LINE_ID, "l_extendedprice", rounded("kurt", 6).alias("kurt"))


def row_stats(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        *_LINE_ID,
        "l_extendedprice",
        sentinel_to_null("l_quantity", 50.0).alias("a"),
        sentinel_to_null("l_discount", 0.0).alias("b"),
        sentinel_to_null("l_tax", 0.0).alias("c"),
    )
    three = ["a", "b", "c"]
    spreads = with_row_std(lines, three, "std")
    return spreads.select(
        *_LINE_ID,
        "l_extendedprice",
        rounded(row_sum(three), 6).alias("row_sum"),
        rounded(row_mean(three), 6).alias("row_mean"),
        rounded(F.coalesce("std", global_value(spreads, F.avg("std"))), 6).alias("row_std"),
    )


def shifted_ratio_query(spark: SparkSession, sf: str) -> DataFrame:
    customers = scan_entity(spark, sf)
    return customers.select("c_custkey", rounded(shifted_ratio(customers, "c_custkey", "c_acctbal"), 6).alias("shifted"))


def log_features(spark: SparkSession, sf: str) -> DataFrame:
    return scan_entity(spark, sf).select(
        "c_custkey",
        rounded(safe_log10("c_acctbal"), 8).alias("log_once"),
        rounded(safe_log10(safe_log10("c_acctbal")), 8).alias("log_twice"),
    )


def median_impute(spark: SparkSession, sf: str) -> DataFrame:
    totals = table(spark, sf, "events").groupBy(F.col("user_id").alias("c_custkey")).agg(F.sum("value").alias("total"))
    wide = table(spark, sf, "customer").select("c_custkey").join(totals, "c_custkey", "left")
    middle = ordered.exact_median(totals, "total", out="m").agg(F.max("m")).scalar()
    return wide.select("c_custkey", rounded(F.coalesce("total", middle), 4).alias("total"))


def payment_features_query(spark: SparkSession, sf: str) -> DataFrame:
    made = payment_features("DAYS_INSTALMENT", "DAYS_ENTRY_PAYMENT", "AMT_INSTALMENT", "AMT_PAYMENT")
    lines = line_history(spark, sf)
    return lines.select(
        *_LINE_ID,
        rounded(made["PAYMENT_PERC"], 6).alias("PAYMENT_PERC"),
        rounded(made["PAYMENT_DIFF"], 4).alias("PAYMENT_DIFF"),
        made["DPD"].cast("bigint").alias("DPD"),
        made["DBD"].cast("bigint").alias("DBD"),
    )


# --- encoders ---------------------------------------------------------------


def quantile_bins(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(*_LINE_ID, "l_extendedprice", "l_discount", "l_quantity")
    codes = {"l_discount": "discount_bin", "l_extendedprice": "price_bin", "l_quantity": "quantity_bin"}
    binned = encode.quantile_bin(lines, codes, 100)
    return binned.select(
        *_LINE_ID, "l_extendedprice", *codes.values(), rounded(row_mean(list(codes.values())), 6).alias("mean_bin")
    )


def ordinal_query(spark: SparkSession, sf: str) -> DataFrame:
    customers = scan_entity(spark, sf)
    return encode.ordinal_encode(customers, ["c_mktsegment"]).select("c_custkey", "c_mktsegment")


def one_hot_query(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return encode.one_hot(orders)[0]


def one_hot_clash(spark: SparkSession, sf: str) -> DataFrame:
    """Values whose column names would meet: in dots, in case, and in the name for missing."""
    first = F.substring("o_orderpriority", 1, 1)
    made = F.when(first == "1", "a.b").when(first == "2", "a_b").when(first == "3", "nan").when(first == "5", "A_b")
    orders = table(spark, sf, "orders").select("o_orderkey", made.alias("p"))
    return encode.one_hot(orders)[0]


def narrow_query(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    return encode.narrow_types(parts)


# --- aggregations -----------------------------------------------------------


def hist_agg(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return _money(aggspec.aggregate(orders, ["o_custkey"], {"o_totalprice": aggspec.ALL6}, "HIST_", "HIST_ROWS"))


def _order_windows(spark: SparkSession, sf: str) -> DataFrame:
    return windowed_agg(
        order_history(spark, sf), "o_custkey", {"o_totalprice": aggspec.ALL6}, Windows("DAYS_CREDIT", DAYS)
    )


def windowed_query(spark: SparkSession, sf: str) -> DataFrame:
    return _money(_order_windows(spark, sf).drop("slice"))


def trend_ratio_query(spark: SparkSession, sf: str) -> DataFrame:
    wide = spread(_order_windows(spark, sf), "o_custkey", ["90", ALL_WINDOW])
    ratios = trend_ratio(wide, "90", ALL_WINDOW)
    return ratios.select(
        "o_custkey", *[rounded(c, 6).alias(c) for c in ratios.columns if c.startswith("fc_")]
    )


_FLAGS = ["l_returnflag_A", "l_returnflag_N", "l_returnflag_R"]


def two_level_agg(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    months, flags = encode.one_hot(lines, ["l_returnflag"], missing_column=False)
    per_order = rollup.child_rollup(months, "l_orderkey", "l_linenumber", flags)
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    joined = orders.join(per_order, "l_orderkey", "left").drop("l_orderkey")
    spec = {
        "l_linenumber_MIN": ("mean", "min"),
        "l_linenumber_MAX": ("mean", "max"),
        "l_linenumber_SIZE": ("mean", "sum"),
        **{f"{f}_MEAN": ("mean",) for f in flags},
    }
    out = aggspec.aggregate(joined, ["o_custkey"], spec, "BURO_")
    means = [c for c in out.columns if c.endswith("_MEAN")]
    return out.select(*[rounded(c, 6).alias(c) if c in means else F.col(c) for c in out.columns])


_STATUS = Slices("o_orderstatus", {"BURO": None, "ACTIVE": "F", "CLOSED": "O"})


def _slice_name(window: str, slice_: str, feature: str) -> str:
    return f"{slice_}_{feature}"


def status_split_agg(spark: SparkSession, sf: str) -> DataFrame:
    spec = {"DAYS_CREDIT": ("mean", "max"), "o_totalprice": ("mean", "sum", "count")}
    long = windowed_agg(order_history(spark, sf), "o_custkey", spec, Windows("DAYS_CREDIT"), _STATUS)
    wide = spread(long, "o_custkey", [ALL_WINDOW], list(_STATUS.names), _slice_name)
    return _money(wide)


def prev_agg(spark: SparkSession, sf: str) -> DataFrame:
    lines = line_history(spark, sf).withColumn("APP_CREDIT_PERC", ratio("l_extendedprice", "o_totalprice") * 100)
    spec = {
        "l_extendedprice": ("min", "max", "mean", "sum"),
        "APP_CREDIT_PERC": ("min", "max", "mean"),
        "l_quantity": ("mean", "sum"),
    }
    slices = Slices("l_linestatus", {"PREV": None, "APPROVED": "F", "REFUSED": "O"})
    long = windowed_agg(lines, "o_custkey", spec, Windows("DAYS_INSTALMENT", (360,), strict=True), slices)
    names = lambda w, s, f: f"{w}_prevapp_{s}_{f}"
    return _money(spread(long, "o_custkey", [ALL_WINDOW, "360"], list(slices.names), names))


def _event_block(spark: SparkSession, sf: str) -> DataFrame:
    spec = {"DAYS_EVENT": ("max", "mean"), "value": ("max", "mean", "sum", "min", "var", "count")}
    return windowed_agg(
        event_history(spark, sf), "user_id", spec, Windows("DAYS_EVENT", EVENT_DAYS), prefix="POS_", size="POS_COUNT"
    )


def pos_agg(spark: SparkSession, sf: str) -> DataFrame:
    return _tidy(_event_block(spark, sf).drop("slice"), {"_MEAN": 4, "_SUM": 2, "_VAR": 4, "_MAX": 2, "_MIN": 2})


def instalment_agg(spark: SparkSession, sf: str) -> DataFrame:
    made = payment_features("DAYS_INSTALMENT", "DAYS_ENTRY_PAYMENT", "AMT_INSTALMENT", "AMT_PAYMENT")
    lines = line_history(spark, sf).withColumns(made)
    spec = {
        "l_suppkey": ("nunique",),
        "DPD": ("max", "mean", "sum"),
        "DBD": ("max", "mean", "sum"),
        "PAYMENT_PERC": ("mean", "var"),
        "PAYMENT_DIFF": ("mean", "sum", "var"),
        "AMT_INSTALMENT": ("max", "mean", "sum"),
        "AMT_PAYMENT": ("min", "mean", "sum"),
    }
    long = windowed_agg(
        lines, "o_custkey", spec, Windows("DAYS_INSTALMENT", DAYS), prefix="INSTAL_", size="INSTAL_COUNT"
    ).drop("slice")
    exact = {"INSTAL_DPD_MAX", "INSTAL_DPD_SUM", "INSTAL_DBD_MAX", "INSTAL_DBD_SUM"}
    scale = {"INSTAL_PAYMENT_DIFF_VAR": 1e6}
    return long.select(
        *[
            F.col(c).cast("bigint").alias(c)
            if c in exact
            else rounded(F.col(c) / F.lit(scale.get(c, 1.0)), 2 if c.endswith("_SUM") else 4).alias(c)
            if c.startswith("INSTAL_") and not c.endswith(("_NUNIQUE", "_COUNT"))
            else F.col(c)
            for c in long.columns
        ]
    )


def blanket_agg(spark: SparkSession, sf: str) -> DataFrame:
    events, _ = encode.one_hot(event_history(spark, sf).drop("props", "ts"), ["event_type"])
    spec = aggspec.blanket_spec(events, ["user_id", "event_id"])
    out = aggspec.aggregate(events, ["user_id"], spec, "CC_", "CC_COUNT")
    return out.select(
        *[
            rounded(c, 4).alias(c) if c.endswith(("_MEAN", "_VAR")) or c.startswith("CC_value") else
            F.col(c).cast("bigint").alias(c)
            for c in out.columns
        ]
    )


def category_share_query(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("user_id", "event_type")
    values = encode.vocabulary(events, ["event_type"])["event_type"]
    out = rollup.category_share(events, "user_id", "event_type", values, "POS_")
    return _tidy(out, {"_MEAN": 6})


def group_stat_map(spark: SparkSession, sf: str) -> DataFrame:
    customers = scan_entity(spark, sf).withColumn("nation", F.col("c_nationkey").cast("string"))
    mapped = lookup.group_stats(customers, ["c_mktsegment", "nation"], ["c_acctbal"])
    stats = [c for c in mapped.columns if c.endswith(("_f1_mean", "_f1_std"))]
    return mapped.select("c_custkey", *[rounded(c, 6).alias(c) for c in stats])


def group_median_query(spark: SparkSession, sf: str) -> DataFrame:
    mapped = lookup.group_median(scan_entity(spark, sf), "c_mktsegment", "c_acctbal", "acctbal_by_segment")
    return mapped.select("c_custkey", "c_mktsegment", rounded("acctbal_by_segment", 4).alias("acctbal_by_segment"))


def max_then_sum(spark: SparkSession, sf: str) -> DataFrame:
    lines = line_history(spark, sf)
    out = rollup.max_then_sum(lines, "o_custkey", "l_orderkey", "l_linenumber", "CC2_TOTAL_INSTALMENTS")
    return out.select("o_custkey", F.col("CC2_TOTAL_INSTALMENTS").cast("bigint").alias("CC2_TOTAL_INSTALMENTS"))


def nonzero_then_mean(spark: SparkSession, sf: str) -> DataFrame:
    lines = line_history(spark, sf)
    late = positive_part(F.col("DAYS_ENTRY_PAYMENT") - F.col("DAYS_INSTALMENT"))
    out = rollup.nonzero_then_mean(lines.withColumn("SK_DPD", late), "o_custkey", "l_orderkey", "SK_DPD", "CC3_DPD_COUNT")
    return out.select("o_custkey", rounded("CC3_DPD_COUNT", 6).alias("CC3_DPD_COUNT"))


def missed_payment_pct(spark: SparkSession, sf: str) -> DataFrame:
    lines = line_history(spark, sf).withColumn("due", F.col("AMT_INSTALMENT") * 0.955)
    out = rollup.missed_payment_pct(lines, "o_custkey", "due", "AMT_PAYMENT", "CC3_PERCENTAGE_MISSED_PAYMENTS")
    return out.select(
        "o_custkey", rounded("CC3_PERCENTAGE_MISSED_PAYMENTS", 6).alias("CC3_PERCENTAGE_MISSED_PAYMENTS")
    )


def trend_slope(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")))
    out = rollup.trend_slope(events, "user_id", "at", "event_id", "value", "slope")
    return out.select("user_id", rounded("slope", 8).alias("slope"))


def trend_by_time(spark: SparkSession, sf: str) -> DataFrame:
    """The trend of event values in the order of timestamps, ties by a text."""
    events = table(spark, sf, "events").withColumn("tie", F.concat_ws("#", "event_type", F.lpad(F.col("event_id").cast("string"), 12, "0")))
    out = rollup.trend_slope(events, "event_type", "ts", "tie", "value", "slope")
    return out.select("event_type", rounded("slope", 6).alias("slope"))


def target_encode(spark: SparkSession, sf: str) -> DataFrame:
    docs = labelled_documents(spark, sf).select("doc_id", "source", "TARGET")
    folded = docs.withColumn("fold", F.when(F.col("TARGET").isNotNull(), hash_fold("doc_id", 5, SEED)))
    out = lookup.target_encode(folded, "source", "TARGET", "fold", 5)
    return out.select(
        "doc_id",
        "fold",
        rounded("source_TARGET_avg", 6).alias("source_TARGET_avg"),
        rounded("source_TARGET_std", 6).alias("source_TARGET_std"),
    )


# --- wide tables ------------------------------------------------------------


def _customer_matrix(spark: SparkSession, sf: str, windows: tuple[int, ...]) -> DataFrame:
    spec = {"o_totalprice": ("count", "mean", "sum", "var")}
    orders = windowed_agg(order_history(spark, sf), "o_custkey", spec, Windows("DAYS_CREDIT", windows), _STATUS)
    labels = [str(w) for w in windows] + [ALL_WINDOW]
    name = lambda w, s, f: f"{w}_bb_{s}_{f}"
    block = spread(orders, "o_custkey", labels, list(_STATUS.names), name)
    return assemble.feature_matrix(
        scan_entity(spark, sf), "c_custkey", [block.withColumnRenamed("o_custkey", "c_custkey")]
    )


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """One row per customer: windowed and status-split order history."""
    return _money(_customer_matrix(spark, sf, (90, 360)))


def feature_matrix(spark: SparkSession, sf: str) -> DataFrame:
    made = payment_features("DAYS_INSTALMENT", "DAYS_ENTRY_PAYMENT", "AMT_INSTALMENT", "AMT_PAYMENT")
    order_block = spread(
        windowed_agg(
            order_history(spark, sf), "o_custkey", {"o_totalprice": ("count", "mean", "sum")},
            Windows("DAYS_CREDIT", (90, 360)), _STATUS,
        ),
        "o_custkey", ["90", "360", ALL_WINDOW], ["BURO", "ACTIVE"], lambda w, s, f: f"{w}_bb_{s}_{f}",
    )
    payment_block = spread(
        windowed_agg(
            line_history(spark, sf).withColumns(made), "o_custkey",
            {"DPD": ("max", "mean"), "AMT_PAYMENT": ("min", "mean", "sum")},
            Windows("DAYS_INSTALMENT", (360,)), prefix="INSTAL_", size="INSTAL_COUNT",
        ),
        "o_custkey", ["360", ALL_WINDOW], name=lambda w, s, f: f"{w}_instpay_{f}",
        keep=lambda n: not n.startswith("360_instpay_INSTAL_DPD"),
    )
    event_block = spread(
        _event_block(spark, sf), "user_id", ["7", ALL_WINDOW], name=lambda w, s, f: f"{w}_poscash_{f}",
        keep=lambda n: n.endswith(("value_MEAN", "POS_COUNT")),
    )
    blocks = [
        order_block.withColumnRenamed("o_custkey", "c_custkey"),
        payment_block.withColumnRenamed("o_custkey", "c_custkey"),
        event_block.withColumnRenamed("user_id", "c_custkey"),
    ]
    return _money(assemble.feature_matrix(scan_entity(spark, sf).select("c_custkey", "c_acctbal"), "c_custkey", blocks))


def level1_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Every window, every status and every function, variances included: one row per customer."""
    made = payment_features("DAYS_INSTALMENT", "DAYS_ENTRY_PAYMENT", "AMT_INSTALMENT", "AMT_PAYMENT")
    windows = [str(d) for d in DAYS] + [ALL_WINDOW]
    orders = windowed_agg(order_history(spark, sf), "o_custkey", {"o_totalprice": aggspec.ALL6}, Windows("DAYS_CREDIT", DAYS), _STATUS)
    payments = windowed_agg(
        line_history(spark, sf).withColumns(made), "o_custkey", {"DPD": aggspec.ALL6, "AMT_PAYMENT": aggspec.ALL6},
        Windows("DAYS_INSTALMENT", DAYS), prefix="INSTAL_", size="INSTAL_COUNT",
    )
    events = windowed_agg(event_history(spark, sf), "user_id", {"value": aggspec.ALL6}, Windows("DAYS_EVENT", EVENT_DAYS), prefix="POS_", size="POS_COUNT")
    blocks = [
        spread(orders, "o_custkey", windows, list(_STATUS.names), lambda w, s, f: f"{w}_bb_{s}_{f}").withColumnRenamed("o_custkey", "c_custkey"),
        spread(payments, "o_custkey", windows, name=lambda w, s, f: f"{w}_instpay_{f}").withColumnRenamed("o_custkey", "c_custkey"),
        spread(events, "user_id", [str(d) for d in EVENT_DAYS] + [ALL_WINDOW], name=lambda w, s, f: f"{w}_poscash_{f}").withColumnRenamed("user_id", "c_custkey"),
    ]
    return _money(assemble.feature_matrix(scan_entity(spark, sf).select("c_custkey"), "c_custkey", blocks))


def stack_features(spark: SparkSession, sf: str) -> DataFrame:
    docs = labelled_documents(spark, sf).select("doc_id", "n_chars", "TARGET")
    first = docs.select("doc_id", F.lit("length").alias("model"), ratio("n_chars", F.lit(1000)).alias("score"))
    # The second model scores train rows only, and every row twice.
    second = docs.where(F.col("TARGET").isNotNull()).select(
        "doc_id",
        F.lit("parity").alias("model"),
        F.explode(F.array(F.col("doc_id") % 7, F.col("doc_id") % 11)).alias("score"),
    )
    out = assemble.stack_features(docs, "doc_id", first.unionByName(second.withColumn("score", F.col("score").cast("double"))), ["length", "parity"])
    return out.select("doc_id", "TARGET", rounded("length", 6).alias("length"), rounded("parity", 6).alias("parity"))


# --- validation and selection -----------------------------------------------


def kfold_assign(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "labels").select(
        "doc_id", hash_fold("doc_id", 5, 1001).alias("fold5"), hash_fold("doc_id", 12, 2018).alias("fold12")
    )


def kfold_exact(spark: SparkSession, sf: str) -> DataFrame:
    return exact_folds(table(spark, sf, "labels").select("doc_id"), "doc_id", 12, 1001)


def kfold_stratified(spark: SparkSession, sf: str) -> DataFrame:
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    return exact_folds(labels, "doc_id", 5, 1001, stratify="quality")


def kfold_names(spark: SparkSession, sf: str) -> DataFrame:
    """Equal folds within each segment over text keys."""
    names = table(spark, sf, "customer").select("c_name", "c_mktsegment")
    return exact_folds(names, "c_name", 5, 1001, stratify="c_mktsegment")


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    docs = labelled_documents(spark, sf).where(F.col("TARGET").isNotNull())
    return docs.select("doc_id", "TARGET", "n_chars", hash_fold("doc_id", 3, SEED).alias("fold"))


def auc_by_fold(spark: SparkSession, sf: str) -> DataFrame:
    return auc(_scored(spark, sf), "TARGET", "n_chars", ["fold"]).withColumn("auc", rounded("auc", 8))


def auc_full(spark: SparkSession, sf: str) -> DataFrame:
    return auc(_scored(spark, sf), "TARGET", "n_chars").withColumn("auc", rounded("auc", 8))


def permute_label(spark: SparkSession, sf: str) -> DataFrame:
    return selection.permute_label(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "quality", SEED)


def permute_names(spark: SparkSession, sf: str) -> DataFrame:
    """Three permutations of the segments over text keys, as columns."""
    names = table(spark, sf, "customer").select("c_name", "c_mktsegment")
    mixed = selection.permute_labels(names, "c_name", "c_mktsegment", [SEED, SEED + 1, SEED + 2])
    return mixed.select("c_name", *[F.col("labels")[i].alias(f"segment{i}") for i in range(3)])


def test_score_mean(spark: SparkSession, sf: str) -> DataFrame:
    test = labelled_documents(spark, sf).where(F.col("TARGET").isNull())
    per_fold = test.select(
        "doc_id", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("fold"), "n_chars"
    ).withColumn("score", ratio(F.col("n_chars") % (F.col("fold") * 7), F.col("fold") * 7))
    return per_fold.groupBy("doc_id").agg(rounded(F.avg("score"), 8).alias("TARGET"))


def _importances(spark: SparkSession, sf: str, *by: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    return lines.groupBy(
        *by, F.col("l_suppkey").cast("string").alias("feature"), F.col("l_linenumber").alias("fold")
    ).agg((F.avg("l_extendedprice") / 1000).alias("importance"))


def importance_mean(spark: SparkSession, sf: str) -> DataFrame:
    return importance.mean_importance(_importances(spark, sf)).withColumn("importance", rounded("importance", 6))


def topk_importance(spark: SparkSession, sf: str) -> DataFrame:
    return importance.top_features(_importances(spark, sf), 40).withColumn("importance", rounded("importance", 6))


def importance_threshold(spark: SparkSession, sf: str) -> DataFrame:
    kept = importance.above_threshold(_importances(spark, sf), 53.0)
    return kept.withColumn("importance", rounded("importance", 6))


def _tested(spark: SparkSession, sf: str) -> DataFrame:
    """Two arms of importances per supplier: discount lifts the actual arm for most of them."""
    actual = F.col("l_linestatus") == "F"
    price = F.col("l_extendedprice")
    lifted = price * (1 + F.col("l_discount") * (F.col("l_suppkey") % 7))
    means = (
        table(spark, sf, "lineitem")
        .groupBy(
            F.when(actual, "actual").otherwise("null").alias("run"),
            F.col("l_suppkey").cast("string").alias("feature"),
            F.col("l_linenumber").alias("fold"),
        )
        .agg((F.avg(F.when(actual, lifted).otherwise(price)) / 1000).alias("importance"))
    )
    return selection.importance_ttest(means)


def importance_ttest(spark: SparkSession, sf: str) -> DataFrame:
    tested = _tested(spark, sf)
    digits = {"log10pvalues": 4}
    return tested.select(
        "feature", *[rounded(c, digits.get(c, 6)).alias(c) for c in tested.columns if c != "feature"]
    )


def select_features(spark: SparkSession, sf: str) -> DataFrame:
    picked = selection.select_features(_tested(spark, sf))
    return picked.select("feature", rounded("padj", 6).alias("padj"))


# --- models -----------------------------------------------------------------


def _model_table(spark: SparkSession, sf: str) -> tuple[DataFrame, list[str]]:
    """Numeric features of the whole document text, with the label where known."""
    docs = labelled_documents(spark, sf)
    words = F.split(F.trim("text"), r"\s+")
    made = docs.select(
        "doc_id",
        "TARGET",
        "lang",
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size(words).alias("n_words"),
        F.size(F.array_distinct(words)).alias("n_distinct"),
        F.size(F.split("text", "\n")).alias("n_lines"),
        F.length(F.regexp_replace("text", r"[^0-9]", "")).alias("n_digits"),
        F.length(F.regexp_replace("text", r"[^A-Z]", "")).alias("n_upper"),
    )
    made = made.withColumns(
        {"word_share": ratio("n_distinct", "n_words"), "digit_share": ratio("n_digits", "n_chars")}
    )
    ready, _ = encode.one_hot(made, ["lang"], missing_column=False)
    return ready, assemble.feature_columns(ready, extra=["doc_id"])


ROUNDS = 4


def _run(spark: SparkSession, sf: str, preset: boosting.Preset, rounds: int = ROUNDS) -> boosting.CrossValidation:
    """The preset as published, with fewer rounds."""
    ready, features = _model_table(spark, sf)
    return boosting.cross_validate(ready, "doc_id", "TARGET", features, replace(preset, rounds=rounds), 3)


def _scores(df: DataFrame) -> DataFrame:
    return df.withColumn("score", rounded("score", 8))


def oof_gbt(spark: SparkSession, sf: str) -> DataFrame:
    return _scores(_run(spark, sf, boosting.DEPTHWISE).oof)


def oof_leafwise(spark: SparkSession, sf: str) -> DataFrame:
    return _scores(_run(spark, sf, boosting.LEAFWISE).oof)


def oof_symmetric(spark: SparkSession, sf: str) -> DataFrame:
    return _scores(_run(spark, sf, boosting.SYMMETRIC).oof)


def test_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of the unlabelled rows, averaged over the fold models."""
    return _scores(_run(spark, sf, boosting.DEPTHWISE).test)


def staged_auc(spark: SparkSession, sf: str) -> DataFrame:
    """AUC of each fold's held-out rows after each round."""
    staged = _run(spark, sf, boosting.DEPTHWISE).staged
    return staged.select("fold", "round", rounded("auc", 8).alias("auc"))


def tree_nodes(spark: SparkSession, sf: str) -> DataFrame:
    nodes = _run(spark, sf, boosting.DEPTHWISE).nodes
    digits = {"cut": 6, "value": 8, "gain": 4, "cover": 4}
    return nodes.select("fold", "tree", "node", "feature", "missing_left", "rows", *[rounded(c, d).alias(c) for c, d in digits.items()])


def importance_long(spark: SparkSession, sf: str) -> DataFrame:
    cv = _run(spark, sf, boosting.DEPTHWISE)
    splits = cv.splits.select("feature", "fold", F.col("importance").alias("splits"))
    return cv.importance.join(splits, ["feature", "fold"]).withColumn("importance", rounded("importance", 6))


def tree_interactions(spark: SparkSession, sf: str) -> DataFrame:
    found = trees.interactions(_run(spark, sf, boosting.DEPTHWISE).nodes)
    kept = found.select("fold", "order", "features", "gain", "times", "weighted_times", "rows", "place")
    return kept.withColumns({"gain": rounded("gain", 4), "weighted_times": rounded("weighted_times", 6)})


def null_selection(spark: SparkSession, sf: str) -> DataFrame:
    """Importances on real and permuted labels, tested and corrected."""
    ready, _ = _model_table(spark, sf)
    keyed = ready.withColumnRenamed("doc_id", credit.KEY)
    found = credit.null_importances(keyed, replace(boosting.DEPTHWISE, rounds=ROUNDS), folds=3, permutations=2, early_stopping=False)
    return selection.importance_ttest(found)


def stacked_oof(spark: SparkSession, sf: str) -> DataFrame:
    """Two level-1 models, their scores as features, and a level-2 model."""
    ready, features = _model_table(spark, sf)
    level1 = None
    names = []
    for preset in (boosting.DEPTHWISE, boosting.SYMMETRIC):
        cv = boosting.cross_validate(ready, "doc_id", "TARGET", features, replace(preset, rounds=ROUNDS), 3)
        scores = cv.predictions("doc_id")
        level1 = scores if level1 is None else level1.unionByName(scores)
        names.append(preset.name)
    stacked = assemble.stack_features(ready, "doc_id", level1, names)
    return _scores(boosting.cross_validate(stacked, "doc_id", "TARGET", features + names, replace(boosting.DEPTHWISE, rounds=ROUNDS), 3).oof)


QUERIES = {
    "scan_entity": scan_entity,
    "scan_limit": scan_limit,
    "union_train_test": union_train_test,
    "split_counts": split_counts,
    "filter_invalid": filter_invalid,
    "sentinel_to_null": sentinel_query,
    "recency_orders": recency_orders,
    "recency_events": recency_events,
    "recency_prev": recency_prev,
    "ratio_features": ratio_features,
    "row_kurtosis": row_kurtosis_query,
    "row_stats": row_stats,
    "shifted_ratio": shifted_ratio_query,
    "log_features": log_features,
    "median_impute": median_impute,
    "payment_features": payment_features_query,
    "quantile_bins": quantile_bins,
    "ordinal_encode": ordinal_query,
    "one_hot": one_hot_query,
    "one_hot_clash": one_hot_clash,
    "narrow_types": narrow_query,
    "hist_agg": hist_agg,
    "windowed_agg": windowed_query,
    "trend_ratio": trend_ratio_query,
    "two_level_agg": two_level_agg,
    "status_split_agg": status_split_agg,
    "prev_agg": prev_agg,
    "pos_agg": pos_agg,
    "instalment_agg": instalment_agg,
    "blanket_agg": blanket_agg,
    "category_share": category_share_query,
    "group_stat_map": group_stat_map,
    "group_median": group_median_query,
    "max_then_sum": max_then_sum,
    "nonzero_then_mean": nonzero_then_mean,
    "missed_payment_pct": missed_payment_pct,
    "trend_slope": trend_slope,
    "target_encode": target_encode,
    "flagship": flagship,
    "feature_matrix": feature_matrix,
    "level1_blocks": level1_blocks,
    "stack_features": stack_features,
    "kfold_assign": kfold_assign,
    "kfold_exact": kfold_exact,
    "kfold_stratified": kfold_stratified,
    "kfold_names": kfold_names,
    "permute_names": permute_names,
    "trend_by_time": trend_by_time,
    "auc_by_fold": auc_by_fold,
    "auc_full": auc_full,
    "permute_label": permute_label,
    "test_score_mean": test_score_mean,
    "importance_mean": importance_mean,
    "topk_importance": topk_importance,
    "importance_threshold": importance_threshold,
    "importance_ttest": importance_ttest,
    "select_features": select_features,
    "oof_gbt": oof_gbt,
    "oof_leafwise": oof_leafwise,
    "oof_symmetric": oof_symmetric,
    "test_scores": test_scores,
    "staged_auc": staged_auc,
    "tree_nodes": tree_nodes,
    "importance_long": importance_long,
    "tree_interactions": tree_interactions,
    "stacked_oof": stacked_oof,
    "null_selection": null_selection,
}
