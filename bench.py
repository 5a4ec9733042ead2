"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local threads. Every query runs to the end
into a sink that drops the rows, so all columns of all rows are produced. It runs ``BENCH_RUNS``
times and its best time counts, because the first run of a plan includes compiling it; the first
times are reported next to them. Names given as arguments restrict the run.
"""

from __future__ import annotations

import json
import os
import sys
import time

from nestloom.session import local_session
from nestloom.suite.queries import REGISTRY

HEADLINE = [
    "order_documents",
    "customer_profiles",
    "customer_orders_target",
    "root_rollup",
    "mid_rollup",
    "leaf_enriched",
    "catalog_target",
    "container_members",
    "container_pages",
    "container_counts",
    "staff_items",
    "order_totals",
    "hierarchy_tree",
    "catalog_tree",
    "typed_items",
    "lookup_batch",
    "lookup_prefix",
    "latest_orders",
    "index_sizes",
    "profile_lineitem",
    "profile_documents",
    "database_overview",
    "relationship_report",
    "reconcile_counts",
    "checksums",
    "sample_mismatch",
    "orphans",
    "quality_rejects",
    "snapshot_diff",
    "upsert_latest",
    "latest_lines",
    "feed_upsert",
    "lookup_collection",
    "lookup_point",
    "lookup_index",
    "load_with_updates_and_deletes",
    "index_after_upsert",
    "customer_orders_whole",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "bench")
    # start-up cost belongs to no query
    spark.read.parquet(f"{folder}/orders.parquet").groupBy("o_custkey").count().write.format("noop").mode("overwrite").save()
    seconds, first = {}, {}
    for name in names:
        taken = []
        for _ in range(max(runs, 1)):
            begin = time.perf_counter()
            REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(round(time.perf_counter() - begin, 3))
        seconds[name], first[name] = min(taken), taken[0]
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "first_run": first,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
