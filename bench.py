"""Wall time of the headline queries, as one line of JSON.

``BENCH_SF_DIR``: folder of the test tables; ``BENCH_CPUS``: threads; ``BENCH_RUNS``: timed runs.
The first run of a query warms up and is not counted; the value is the median of the others. Every
run computes all rows and columns of the result and discards them.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from dealtide.catalog.queries import QUERIES  # noqa: E402
from dealtide.session import start  # noqa: E402

HEADLINES = (
    "clean_parse_events", "clean_source_key", "clean_deals", "clean_deal_products",
    "clean_payments", "clean_stage_history", "clean_duplicate_lines", "clean_orphans",
    "report_funnel", "report_managers", "report_receivables", "report_delays", "report_stale",
    "report_sources", "report_cleaned_managers", "quality_transitions", "quality_overdue",
    "refresh_manifest", "expect_checks", "journal_summary",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = start(
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", cpus)
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINES:
        taken = []
        for _ in range(runs + 1):
            begun = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - begun)
        seconds[name] = round(statistics.median(taken[1:] or taken), 3)
        print(name, [round(t, 3) for t in taken], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_seconds_headline_queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "cpus": int(cpus),
        "runs": runs,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
