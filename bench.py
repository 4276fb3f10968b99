"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is run twice into the noop sink and the faster run counts, so that
JVM warm-up and tables derived once per session are not part of it.
"""

from __future__ import annotations

import json
import os
import sys
import time

from churnloom.plans.registry import QUERIES
from churnloom.plans.workspace import Workspace
from churnloom.session import build

HEADLINE = [
    "silver_transactions",
    "silver_members",
    "silver_logs",
    "txn_features",
    "log_features",
    "gold_features",
    "daily_delta",
    "cumulative_features",
    "materialize_latest",
    "asof_features",
    "score_lookup",
    "impute_stats",
    "impute_serving",
    "drift_psi",
    "drift_ks",
    "eval_auc",
    "pr_curve",
    "class_report",
    "req_rate",
    "rolling_churn_rate",
    "hist_quantile",
    "in_flight",
    "top_reasons",
    "score_batch",
    "shap_values",
    "stream_features",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build(
        f"local[{cpus}]", "bench", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"}
    )
    spark.sparkContext.setLogLevel("OFF")
    wanted = sys.argv[1:] or HEADLINE
    seconds: dict[str, float] = {}
    for name in wanted:
        runs = []
        for _ in range(2):
            started = time.perf_counter()
            if name == "stream_features":
                # The whole job each time: replay, micro-batches, drift, finish.
                Workspace(spark, sf_dir).run_stream()
            else:
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
        seconds[name] = round(min(runs), 3)
        print(f"{name}: {runs[0]:.2f}s, {runs[1]:.2f}s", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline queries, faster of two runs",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
