"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (data folder), BENCH_CPUS (local cores), BENCH_RUNS (timed
runs per query, median reported, after one warm-up), BENCH_QUERIES (comma list).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from revlens.session import build_session  # noqa: E402
from workload.queries import registry  # noqa: E402

HEADLINE = [
    "gzip_to_ndjson",
    "bad_record_report",
    "load_metadata",
    "load_inferred",
    "bronze_products",
    "bronze_reviews",
    "dim_date",
    "dim_products",
    "dim_reviewer",
    "fct_review",
    "gold_category_ratings_monthly",
    "gold_brand_repeated_reviewers",
    "gold_reviews_per_reviewer",
    "gold_seasonality_and_reviews",
    "gold_weekend_review_behavior",
    "star_join",
    "merge_fct_review",
    "merge_dim_products",
    "merge_dim_reviewer",
    "fct_partitioned",
    "check_unique_review_sk",
    "check_rel_product",
    "check_summary",
]


def timed(run, spark, sf_dir: str) -> float:
    """Seconds to compute every row; the sink discards them without the driver."""
    started = time.perf_counter()
    run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE
    spark = build_session(
        app="bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalog, seconds = registry(), {}
    for name in names:
        timed(catalog[name], spark, sf_dir)
        seconds[name] = round(
            statistics.median(timed(catalog[name], spark, sf_dir) for _ in range(runs)), 3
        )
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    spark.stop()
    result = {
        "metric": "headline_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rsplit("sf", 1)[-1],
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
