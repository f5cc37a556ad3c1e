"""Times the headline queries and prints one JSON line.

Each query runs once to warm up and then ``BENCH_RUNS`` times; the best run
counts.  Results go to a sink that reads every row and column.
"""

from __future__ import annotations

import json
import os
import sys
import time

from annomill.plans.queries import QUERIES
from annomill.session import local_session

HEADLINES = [
    "expand_requests", "render_instruction", "build_request", "write_requests", "split_plan", "need_split",
    "read_outputs", "extract_level", "annotate_long", "annotation_summary", "attach_prompts",
    "pivot_wide", "nest_wide", "batch_usage", "batch_summary", "general_summary",
    "token_count", "input_tokens_exact", "input_tokens_approx", "estimate_cost",
    "missing_outputs", "jobs_in_ledger", "validate_prompts", "stream_status", "stream_outputs",
    "annotation_run",
]


def timed(query, spark, sf_dir) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINES
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        timed(QUERIES[name], spark, sf_dir)
        seconds[name] = round(min(timed(QUERIES[name], spark, sf_dir) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "headline queries, total wall time", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
