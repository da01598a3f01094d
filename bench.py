"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Every query is written to Spark's ``noop`` sink, so all rows are produced and none
travel to the driver. Queries named on the command line replace the headline set.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from packtrace.plans import catalog  # noqa: E402
from packtrace.session import build  # noqa: E402

HEADLINE = (
    "integrity_flags",
    "integrity_flags_hot_devices",
    "integrity_severity",
    "integrity_replay_pattern",
    "fault_features",
    "fault_features_hot_cycles",
    "soh_features",
    "soh_dqdv",
    "feature_stats",
    "cycles_from_row_count",
    "split_stratified",
    "auroc_large_table",
    "regression_metrics",
    "interval_coverage",
    "top_attributions",
    "prompt_markdown",
    "drift_features",
    "drift_features_large_tables",
    "risk_register",
    "rollout_gates",
    "live_window_counts",
    "soh_model_predictions",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    settings = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = build(f"local[{cpus}]", "bench", **settings)
    only = sys.argv[1:] or HEADLINE
    catalog.QUERIES["risk_register"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm the JVM
    times = {}
    for name in only:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
