"""Times headline jobs on the supplied tables; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession

from tributary.operators.aggspec import ALL6
from tributary.operators.windowed import ALL_WINDOW, Windows, spread, windowed_agg
from tributary.plans.catalog import DAYS, QUERIES
from tributary.session import local_session
from tributary.sources.tables import line_history

HEADLINE = [
    "flagship",
    "windowed_agg",
    "feature_matrix",
    "two_level_agg",
    "status_split_agg",
    "prev_agg",
    "instalment_agg",
    "blanket_agg",
    "ratio_features",
    "quantile_bins",
    "group_stat_map",
    "group_median",
    "trend_slope",
    "target_encode",
    "auc_full",
    "permute_label",
    "kfold_stratified",
    "importance_ttest",
    "oof_gbt",
]

EIGHT = (
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "AMT_PAYMENT",
    "o_totalprice",
    "DAYS_ENTRY_PAYMENT",
    "l_linenumber",
)


def wide_block_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8 columns x 6 functions x 5 nested windows, long form."""
    spec = {c: ALL6 for c in EIGHT}
    return windowed_agg(line_history(spark, sf_dir), "o_custkey", spec, Windows("DAYS_INSTALMENT", DAYS))


def wide_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same block as one row of 240 features per entity."""
    return spread(wide_block_long(spark, sf_dir), "o_custkey", [str(d) for d in DAYS] + [ALL_WINDOW])


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, "bench")
    jobs = {name: QUERIES[name] for name in HEADLINE}
    jobs.update({"windowed_8x6x5_long": wide_block_long, "windowed_8x6x5_wide": wide_block})
    only = sys.argv[1:]
    if only:
        jobs = {k: v for k, v in jobs.items() if k in only}
    QUERIES["hist_agg"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # JVM start-up
    took = {}
    for name, job in jobs.items():
        runs = []
        for _ in range(1 if name == "oof_gbt" else 3):
            start = time.perf_counter()
            job(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        took[name] = round(min(runs), 3)
        print(f"{name} {runs}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
