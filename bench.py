"""Time headline queries: one warm-up, then the median of several runs into a sink that discards rows.

Settings: BENCH_SF_DIR (data folder), BENCH_CPUS (local cores), BENCH_RUNS.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from registry import REGISTRY  # noqa: E402
from reviewlens.session import build_session  # noqa: E402

HEADLINES = [
    "product_ratings_avg",
    "category_ratings_avg",
    "tagged_ratings",
    "top_analysis",
    "top_analysis_by_dataset",
    "weighted_ratings",
    "missing_profile",
    "rating_frequency",
    "rating_summary",
    "validation_report",
    "harmonise_arrays",
    "time_extract",
    "length_extract",
    "good_events",
    "monthly_trend",
    "rolling_trend",
    "category_trend",
    "length_buckets",
    "rating_length_pivot",
    "length_rating_corr",
    "basic_stats",
    "rating_histogram",
    "star_distribution",
    "combined_monthly",
    "report_roundtrip",
    "categories_by_rating",
    "exact_quantiles",
    "integrated_report",
    "map_reduce_avg",
    "piped_map_reduce_avg",
    "stream_daily_ratings",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINES
    spark = build_session(
        "reviewlens-bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        for run in range(runs + 1):
            start = time.perf_counter()
            REGISTRY[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            if run:
                times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 4)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "sum of median query seconds",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
