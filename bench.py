"""Time the headline queries; prints one JSON line.

Each query runs in full (every row and column is produced) RUNS times; the best
time counts, so JIT and code generation of the first run are left out. Every query's
time goes to standard error as it ends.
"""

from __future__ import annotations

import json
import os
import sys
import time

from loanlens.plans.catalog import QUERIES
from loanlens.session import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

HEADLINE = (
    "q_labelled",
    "q_feature_matrix",
    "q_early_agg",
    "q_target_combined",
    "q_first_per_loan",
    "q_impute_median",
    "q_stratified_split",
    "q_metrics",
    "q_metrics_exact",
    "q_pd_histogram",
    "q_pd_to_score",
    "q_score_portfolio",
    "q_score_requests",
    "q_band_summary",
    "q_reason_codes",
    "q_linear_attrib_global",
    "stream_score",
)


def seconds(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = local_session(CPUS, "loanlens-bench")
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        runs = [seconds(lambda: QUERIES[name](spark, SF_DIR)) for _ in range(RUNS)]
        times[name] = round(min(runs), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "runs": RUNS,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
