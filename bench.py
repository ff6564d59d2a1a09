"""Times the headline queries, median of up to three runs, and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores, ``BENCH_QUERIES`` a choice.
"""

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from edgeloom.plans.rounds import release  # noqa: E402
from queries.registered import QUERIES  # noqa: E402

HEADLINE = [
    "graph_build_nodes",
    "csr_indices",
    "csr_roundtrip",
    "edge_map_diff",
    "bipartite_diff",
    "nodemap_sort_topk",
    "bipartite_violations",
    "aggregate_edges",
    "connected_components_succession",
    "connected_components_places",
    "strong_components_succession",
    "pagerank_succession",
    "bfs_succession",
    "triangle_count_succession",
    "projection_customers",
    "projection_parts",
    "modularity_of_part_sizes",
    "louvain_transitions_quality",
]
RUNS = 3  # of each query, while the whole takes less than the limit
LIMIT_SECONDS = 450


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("edgeloom-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="edgeloom-bench-"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    begun = time.perf_counter()
    _timed(spark, "connected_components_succession", folder)  # warm-up, not counted
    runs = {name: [_timed(spark, name, folder)] for name in names}
    for _ in range(RUNS - 1):
        # Another turn only if it is likely to end in time.
        if time.perf_counter() - begun + 1.2 * sum(r[0] for r in runs.values()) > LIMIT_SECONDS:
            break
        for name in names:
            runs[name].append(_timed(spark, name, folder))
    spark.stop()
    seconds = {name: round(statistics.median(r), 3) for name, r in runs.items()}
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(folder).name.removeprefix("sf"), "runs": len(runs[names[0]]),
    }))


def _timed(spark: SparkSession, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    took = time.perf_counter() - start
    release(spark)
    print(name, round(took, 3), file=sys.stderr, flush=True)
    return took


if __name__ == "__main__":
    main()
