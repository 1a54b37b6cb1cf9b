"""Times the headline queries and prints one JSON line.

The session is warmed up with one query; then every query runs ``BENCH_RUNS`` times and the
best run counts. A run computes every row and column of the result and throws them away.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from market_lens.plans import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "1"))
HEADLINE = (
    "agg_brand_top10 agg_price_summary agg_fuel_share_all cln_dedup cln_preprocess cln_preprocess_counts "
    "chart_price_share chart_price_hist chart_mileage_box chart_price_year_summary rep_overview rep_quick_stats "
    "fn_year fn_brand parse_listing extract_cards parse_pages frontier_pending quota_city_cap quota_adaptive_alloc "
    "quota_total_cap ml_label_encode ml_price_tier ml_standardize ml_metrics_regression ml_price_predictions "
    "ml_cluster_profile stream_ingest_pages"
).split()


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("market_lens bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="market_lens_bench_"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    names = os.environ.get("BENCH_QUERIES", " ".join(HEADLINE)).split()
    timed(names[0])
    seconds = {}
    for name in names:
        seconds[name] = round(min(timed(name) for _ in range(RUNS)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)  # a run that is stopped leaves what it has
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
