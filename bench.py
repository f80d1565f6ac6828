"""Time the headline queries: after a warm-up the median of three runs into the noop sink, chains once.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and the cores. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from fieldgauge.checks.queries import REGISTRY
from fieldgauge.session import build_session

HEADLINES = (
    "kpi", "silver", "quarantine", "current_state", "alert_identity", "sequence", "validate_records",
    "dedup_first_events", "dedup_first_lineitem", "latest_per_key_orders", "sequence_lineitem", "enrich_lineitem",
    "merge_upsert", "merge_insert_composite", "duplicate_keys_lineitem", "validation_report",
)
# Chains of many jobs: timed once, without a warm-up.
CHAINS = ("alert_episodes", "silver_in_slices", "stages_over_tables")
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or (*HEADLINES, *CHAINS)
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            # One partition per core; the data is far too small for Spark to choose their number.
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        start = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    timed(names[0])  # starts the JVM's compilers, whose time belongs to no query
    queries = {}
    for name in names:
        runs = 1 if name in CHAINS else RUNS
        if runs > 1:
            timed(name)
        queries[name] = round(statistics.median(timed(name) for _ in range(runs)), 3)
    total = round(sum(queries.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": queries,
                      "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
