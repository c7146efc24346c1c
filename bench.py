"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3 timed runs after one warm-up; the median counts),
BENCH_QUERIES (comma-separated names; ``all`` for every query).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from featurespark.plans.registry import all_queries
from featurespark.session import scratch_tables

HEADLINE = [
    "rolling_avg",
    "rolling_avg_all",
    "rolling_pairs_sql",
    "rolling_pairs_window",
    "target_game_avg",
    "historic_avg",
    "quartiles",
    "corr_pairs",
    "correlation_ratio",
    "cramers_v",
    "ols_per_feature",
    "logit_per_feature",
    "msd1d",
    "msd2d_cont_cont",
    "msd2d_cat_cont",
    "msd2d_cat_cat",
    "knn_classify",
    "count_vectorize",
    "stride_sample",
    "rolling_avg_instants",
    "rf_classify",
    "rf_importance",
    "rf_importance_regression",
    "corr_wide",
    "rolling_window_median",
    "count_vectors",
    "knn_lsh",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("featurespark-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(spark: SparkSession, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    with scratch_tables(spark):
        all_queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", "")
    names = list(all_queries()) if names == "all" else [n for n in names.split(",") if n] or HEADLINE
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    seconds = {}
    for name in names:
        run(spark, sf_dir, name)
        seconds[name] = round(statistics.median(run(spark, sf_dir, name) for _ in range(runs)), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
