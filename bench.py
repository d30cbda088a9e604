"""Bench: time the headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR.

Each query is run to completion with a ``noop`` write (the whole plan runs,
nothing is collected) and timed on the wall clock.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "kw_filter",
    "stage_counts",
    "top_n",
    "arrival_seq",
    "cosine_pairs",
    "bow_similarity",
    "dedupe_leaders_partitioned",
    "novelty_filter",
    "novelty_scores",
    "dedupe_leaders",
    "related_lists",
    "peel_rank",
    "balance_sources",
    "least_represented",
    "normalize_headers",
    "reports",
    "page_text",
    "content_bundle",
    "feed_scan",
    "daily_digest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE

    from gazette.plans.catalog import QUERIES
    from gazette.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="gazette-bench")
    # warm the JVM and the Python workers once; not part of any query's time
    spark.read.parquet(f"{sf_dir}/region.parquet").write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in names:
        t0 = time.perf_counter()
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_queries_total_wall", "value": total, "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
