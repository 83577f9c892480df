"""Time the headline queries; print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3).
Each time is the median of the runs after one warm-up. ``build_summary`` writes the summary
table that the reports below it read; ``vendor_summary`` and the two cleaning queries start
from the raw tables every time.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from procurelens.plans.build import build_summary  # noqa: E402
from procurelens.plans.reports import REPORTS, summary_table  # noqa: E402
from procurelens.session import local_session, work_dir  # noqa: E402
from procurelens.sources import star  # noqa: E402

HEADLINE = [
    "vendor_summary",
    "summary_clean_py",
    "summary_clean_sql",
    "duplicate_pos",
    "low_turnover_profitable",
    "brand_categories",
    "target_brands",
    "vendor_pareto",
    "order_size_prices",
    "unsold_by_vendor",
    "describe_numeric",
    "correlation_matrix",
    "histogram_30",
    "box_stats",
    "margin_ci",
    "margin_welch",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    if name == "build_summary":
        build_summary(spark, star.load(spark, sf_dir), work_dir(spark, "bench"))
    else:
        REPORTS[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, "procurelens-bench", os.environ.get("BENCH_MEMORY", "8g"))
    spark.sparkContext.setLogLevel("ERROR")
    summary_table(spark, sf_dir)
    times = {}
    for name in ["build_summary", *HEADLINE]:
        run(spark, name, sf_dir)
        times[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(runs)), 3)
    line = {
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
        "runs": runs,
        "spark": spark.version,
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
