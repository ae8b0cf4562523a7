"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_RUNS`` the timed runs after
one warm-up, ``BENCH_QUERIES`` a comma-separated choice of queries (``all`` for every one).
"""

from __future__ import annotations

import json
import os
import statistics
import time

from readloom.catalog.queries import QUERIES
from readloom.session import local_session

HEADLINE = [
    "qc_summary",
    "cycle_quality_hist",
    "cycle_quantiles",
    "qc_boxplot",
    "trim_reads",
    "mate_pairs_grouped",
    "mate_pairs_joined",
    "fastq_records",
    "fastq_source_validated",
    "mapped_reads",
    "coordinate_sort",
    "reads_with_reference",
    "pileup_counts",
    "baq_pileup",
    "baq_bases",
    "snp_counts",
    "pileup_by_region",
    "sam_partition_blocks",
]


def timed(spark, run) -> float:
    spark.catalog.clearCache()
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "readloom-bench")
    seconds = {}
    for name in names:
        taken = [timed(spark, lambda: QUERIES[name](spark, sf_dir)) for _ in range(runs + 1)]
        seconds[name] = round(statistics.median(taken[1:]), 3)
    total = round(sum(seconds.values()), 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
