"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from chartmill.session import configure  # noqa: E402
from queries import QUERIES  # noqa: E402

HEADLINE = [
    "collapse_count", "collapse_count_text", "collapse_collect", "classify_duplicates", "duplicate_audit", "duplicate_blocks",
    "key_divergence", "silver_flowsheets", "silver_patient_labs", "silver_patient_medications", "silver_patient_information",
    "bronze_flowsheets", "scan_time_range_month", "summary_by_group", "top_groups", "profile", "describe", "histogram",
    "reconcile_multiplicity", "verify_layer", "attach_attributes", "as_of_features", "interval_join", "first_occurrence_pivot",
    "step_gaps", "history_features", "breach_ahead",
]


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = configure(
        SparkSession.builder.master(f"local[{cpus}]").appName("chartmill-bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    seconds = {}
    for name in names:
        run(name)  # the first run pays for code generation and file listing
        seconds[name] = round(min(run(name) for _ in range(3)), 3)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
