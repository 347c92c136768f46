"""Headline queries on one directory of tables; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
data and cores. Every query runs once to warm the JVM and once timed; each run
computes all rows and columns and discards them.
"""

from __future__ import annotations

import json
import os
import sys
import time

from docloom.plans.queries import QUERIES
from docloom.session import build_session

HEADLINES = [
    "range_chunks",
    "normalize_schema",
    "left_chain",
    "ancestor_closure",
    "category_arrays",
    "meta_fold",
    "concat_group",
    "promote_meta",
    "promote_serialized",
    "php_decode",
    "assemble_documents",
    "keep_last",
    "window_passthrough",
    "bulk_batches",
    "bulk_totals",
    "success_rate",
    "tokens",
    "shingles",
    "synonym_expand",
    "synonym_shingles",
    "mapping_projection",
]


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINES
    spark = build_session(
        "docloom-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, directory).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    scale = os.path.basename(os.path.normpath(directory)).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline queries, warm",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
