"""Benchmark the headline queries.

Runs each query end to end (``noop`` sink: every row is computed, nothing is
collected) on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` and prints one
JSON line. Each query runs ``$BENCH_REPEAT`` times (default 2); the best
time counts.
"""

from __future__ import annotations

import json
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "c3_search_page",        # keyword search page, card view
    "f7_combined",           # optional filters incl. day range
    "t4_keyset_page",        # keyset paging
    "a6_tags",               # tag facet
    "n1_normalised_histogram",  # ordered rule fold + histogram
    "a7_rule_hits",          # per-rule counts
    "n3_cleanup_after",      # preview, delete, recount
    "s4_insert_if_absent",   # first-wins + anti join
    "a8_collect_outcomes",
    "s5_keyed_update",
    "s3_reachability",
    "x8_page_text",          # page parse
    "k1_page_dates",         # page parse + date resolution
    "c1_collect_rows",       # full collect pipeline
    "x20_summary",           # extractive summary over whole documents
    "x21_keyword_terms",     # TF-IDF over the corpus
    "c2_enrich_rows",        # full enrich pipeline
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    names = sys.argv[1:] or HEADLINE
    from newsloom.registry import queries
    from newsloom.session import build_session
    mem = os.environ.get("BENCH_DRIVER_MEMORY", "16g")
    spark = build_session(f"local[{cpus}]", app="newsloom-bench", shuffle_partitions=cpus * 2,
                          extra={"spark.driver.memory": mem})
    qs = queries()
    # warm-up: start executors and JIT on a small query
    qs["a5_sources"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        best = math.inf
        for _ in range(repeat):
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - t0)
        times[name] = round(best, 3)
    total = round(sum(times.values()), 3)
    geo = round(math.exp(sum(math.log(max(t, 1e-3)) for t in times.values()) / len(times)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "total_seconds_headline_queries", "value": total, "unit": "sec",
        "queries": times, "geomean_sec": geo, "sf": sf, "cores": cpus,
        "driver_memory": mem, "spark": spark.version, "repeat": repeat,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
