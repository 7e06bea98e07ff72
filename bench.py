"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is planned and fully executed into Spark's ``noop`` sink (all rows computed, nothing
collected). An untimed warm-up first runs every headline query once on sf0.001 (JVM class loading
and JIT; without it the first queries measured pay for the whole session's warm-up). Then every
query runs twice on the bench input: the first (cold for this input: code generation, file
listing) is reported under ``cold``, the second under ``queries``. The cache is cleared before every run, so
a query that persists an intermediate result computes it again. Prints one JSON line: total warm seconds,
per-query warm seconds, the cold times and the scale factor.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "silver_transactions",
    "gold_scored",
    "v_global_fraud_rate",
    "v_fraud_by_city_state",
    "v_avg_amount_by_class",
    "v_top_suspect_clients",
    "explain_rules",
    "predict_batch",
    "dedupe_first_wins",
    "snapshot_prefix_70",
    "undersample_balanced",
    "string_index",
    "roc_auc",
    "classification_metrics",
    "bronze_write",
    "snapshot_latest",
    "train_gbt",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from cardwatch.plans.keys import registry
    from cardwatch.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="cardwatch-bench")
    reg = registry()
    # Warm-up: every headline query once on the smallest input (class loading, JIT), untimed.
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    for name in only or HEADLINE:
        reg[name](spark, warm_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    cold: dict[str, float] = {}
    for name in only or HEADLINE:
        for run in (cold, times):
            spark.catalog.clearCache()  # no run may reuse data another run cached
            t0 = time.perf_counter()
            reg[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            run[name] = round(time.perf_counter() - t0, 3)
        print(f"{name}: cold {cold[name]}s warm {times[name]}s", file=sys.stderr)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "cold": cold,
        "cold_total": round(sum(cold.values()), 3),
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
