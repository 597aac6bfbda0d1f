"""Benchmark: run the headline queries and print one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, optional).  Each query runs to completion into
Spark's ``noop`` sink (full execution, no driver collect).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "items", "exact_duplicates", "item_issues", "chapter_quality", "coverage_cube", "coverage_gaps",
    "normalize_variations", "merge_variations", "syllabus_match", "topic_sections", "section_requests",
    "verification_requests", "flatten_bank", "bank_export", "near_duplicates", "near_duplicate_items",
    "run_summary",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    from quizmill.plans.registry import QUERIES
    from quizmill.session import local_session
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2)
    times: dict[str, float] = {}
    for name in names:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
