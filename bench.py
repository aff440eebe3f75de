"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from eventloom.plans.queries import QUERIES  # noqa: E402
from eventloom.session import build_session  # noqa: E402

HEADLINE = [
    "check_all",
    "rank_sites_read",
    "group_stats",
    "job_time_breakdown",
    "flatten_meta",
    "job_profile",
    "key_coverage",
    "answer_batch",
    "union_generated",
    "result_quality",
    "route_answers",
    "lint_sql",
    "assemble_llm",
    "label_mask",
    "loss_weights",
    "conversation_verdict",
    "benchmark_summary",
    "leakage_check",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "eventloom-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or HEADLINE
    cold, warm = {}, {}
    for times in (cold, warm):
        for name in chosen:
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "total warm seconds of the headline queries",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
