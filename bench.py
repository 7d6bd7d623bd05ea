"""Bench: wall time of the headline queries on $BENCH_SF_DIR (default sf0.1)
with local[$BENCH_CPUS]; prints one JSON line.

Each query is built and fully executed through the ``noop`` sink (every row
computed, nothing collected to the driver).  One untimed warm-up query on the
smallest table set loads the JVM code paths first."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "clean_encounters",      # F1 -> F3 -> F4 -> NZV drop -> F6
    "deletion_audit",        # F8-F10
    "nzv_all_columns",       # A2 (one pass over every line column)
    "value_distribution",    # A8 with distributed ordinals
    "column_profile",        # A14
    "diagnosis_groups",      # C1
    "model_ready",           # P1-P5
    "stratified_split",      # P7
    "prediction_metrics",    # M11 + M14
    "roc_curve",             # M13
    "run_history",           # M22
    "frequent_itemsets",     # R1
    "association_rules",     # R2
    "feature_scores",        # FS1 + FS2 + FS5
    "cluster_points",        # K1 + K2 + K6
]


def main() -> None:
    from tabmine.plans.queries import QUERIES, clear_memo
    from tabmine.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "8")),
                          app="tabmine-bench")
    warm = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    QUERIES["clean_encounters"](spark, warm).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        clear_memo()                                   # every query measured from its inputs
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_wall_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
