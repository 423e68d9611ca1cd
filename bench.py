"""Time the headline queries end to end and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is built from scratch (no results shared between queries or runs) and
executed into Spark's ``noop`` sink, so every row is computed but nothing is collected.
Every query runs ``BENCH_RUNS`` times (default 2) after an untimed warm-up on the small
tables; the faster run is reported, which damps noise from the host.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "recs_unseen",           # flagship: top-100 unseen popular items per basket
    "split_train",           # ordered 80/20 hold-out
    "indexed_interactions",  # dense ids for baskets and items + joins
    "popularity_score",      # per-item features and weighted score
    "cooccurrence_full",     # item pairs within baskets
    "stratified_sample",     # size bands + hash sample
    "hybrid_rank",           # blend + seen removal + top-k
    "metrics_at_k",          # hits, precision/recall/coverage at 4 cut-offs
    "map_at_100",            # average precision and MAP
    "nested_parse",          # nested JSON documents -> interactions
    "als_candidates",        # factor model fit and its lists for every basket
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE

    from hamper.plans import catalog
    from hamper.session import local_session

    spark = local_session(cpus, app="hamper-bench", shuffle_partitions=cpus,
                          extra={"spark.ui.showConsoleProgress": "false"})
    # warm up the JVM (JIT) and the Python workers on the small tables; not timed
    warm_dir = re.sub(r"sf[0-9.]+", "sf0.01", sf_dir)
    for name in names if os.path.isdir(warm_dir) else []:
        catalog.QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
        catalog.clear_memo()
        spark.catalog.clearCache()

    runs = int(os.environ.get("BENCH_RUNS", "2"))
    times, all_runs = {}, {}
    for name in names:
        for _ in range(runs):
            catalog.clear_memo()
            spark.catalog.clearCache()  # nothing carried over between queries or runs
            t0 = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            all_runs.setdefault(name, []).append(round(time.perf_counter() - t0, 3))
        times[name] = min(all_runs[name])
    catalog.clear_memo()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus,
                      "stat": f"min of {runs} runs", "runs": all_runs}))
    spark.stop()


if __name__ == "__main__":
    main()
