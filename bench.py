"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (comma separated, or
"all"), BENCH_VERBOSE=1 for one line per query on stderr. Every query is read to the end through the noop sink.
"""
from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "classification_metrics", "metrics_rollup", "auroc", "latency_stats", "quantile_higher", "threshold_sweep", "recall_first",
    "ladder_threshold", "review_segments", "segment_escalation", "batch_report", "stratified_batches", "reserve_roles",
    "dedup_content", "cohort_fingerprint", "merge_runs", "mask_intersection", "tolerant_counts", "connected_components",
    "mask_conf_curve", "segmentation_micro", "promotion_gate", "shadow_window", "model_in_force", "batch_snapshot",
    "nearest_bank", "kcenter_select", "simulation_table", "ingest_against_store", "milestone_stream",
)


def session(cpus: str):
    from pyspark.sql import SparkSession
    return (SparkSession.builder.master(f"local[{cpus}]").appName("loupeline-bench")
            .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
            .config("spark.driver.memory", "16g").config("spark.driver.host", "127.0.0.1")
            .config("spark.driver.bindAddress", "127.0.0.1").getOrCreate())


def main() -> None:
    from loupeline.plans import catalog
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    wanted = os.environ.get("BENCH_QUERIES", "")
    plans = catalog.callables()
    names = list(plans) if wanted == "all" else [n for n in wanted.split(",") if n] or [n for n in HEADLINE if n in plans]
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    plans["decide"](spark, folder).write.format("noop").mode("overwrite").save()  # warm the session up
    seconds = {}
    for name in names:
        start = time.perf_counter()
        plans[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        if os.environ.get("BENCH_VERBOSE"):
            print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
                      "sf": float(scale.group(1)) if scale else folder}))


if __name__ == "__main__":
    main()
