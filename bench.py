"""Wall time of the headline queries; prints one JSON line.

Every query is run a few times in one session (``BENCH_RUNS``, three unless set) and written to a sink that keeps
nothing; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINE = (
    "chunk_tokens",
    "global_part_index",
    "pending_articles",
    "part_summary_feed",
    "pending_parts",
    "pending_relations",
    "truncate_to_budget",
    "repair_report",
    "serialise_relations",
    "relation_edges",
    "resolve_entities",
    "export_join",
    "all_prompt_variants",
    "check_references",
    "batch_infer",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")

    from pyspark.sql import SparkSession

    from corpusloom.plans.queries import queries
    from corpusloom.session import configure

    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.ui.enabled", "false")
    builder = builder.config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g")
    spark = configure(builder.config("spark.ui.showConsoleProgress", "false")).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    seconds = {}
    registered = queries()
    for name in HEADLINE:
        times = []
        for _ in range(RUNS):
            started = time.perf_counter()
            registered[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times), 3)
        print(name, [round(value, 2) for value in times], file=sys.stderr, flush=True)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale}))


if __name__ == "__main__":
    main()
