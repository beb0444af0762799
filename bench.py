"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

import json
import os
import re
import sys
import time

from pyspark.sql import DataFrame

from patchlens.session import build_session
from testbed.queries import QUERIES

HEADLINE = (
    "patch_entropy",
    "patch_entropy_native",
    "leak_detect",
    "trend_extract",
    "commit_enrich",
    "kpi_24h",
    "entropy_hourly",
    "top_risky_repos",
    "live_latest_per_repo",
    "activity_heatmap_pivot",
    "tech_trends_top60",
    "category_libs",
    "llm_response_parse",
    "stream_dual_sink",
)


def run(df: DataFrame) -> None:
    """Compute every row and column without collecting them."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    run(QUERIES["patch_entropy"](spark, sf_dir))  # start the JVM's and Python's workers
    seconds = {}
    for name in names:
        best = None
        for _ in range(2):
            start = time.perf_counter()
            run(QUERIES[name](spark, sf_dir))
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
