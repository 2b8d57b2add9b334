"""Times every registered query and prints one JSON line.

Each query runs once to warm up and then BENCH_RUNS times (default 1); its
median counts. Results go to Spark's ``noop`` sink, so all rows are computed
and none is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from siltbed.registry import ENTRIES
from siltbed.session import build_session


def seconds(spark, run, sf_dir: str) -> float:
    started = time.perf_counter()
    run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or list(ENTRIES)
    spark = build_session("bench", cores)
    timings = {}
    for name in names:
        run = ENTRIES[name].run
        seconds(spark, run, sf_dir)
        timings[name] = round(statistics.median(seconds(spark, run, sf_dir) for _ in range(runs)), 3)
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    megabytes = documents.selectExpr("sum(octet_length(text)) / 1e6").first()[0]
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    if "raw_ingest_provenance" in timings:
        result["raw_ingest_mb_per_sec"] = round(float(megabytes) / timings["raw_ingest_provenance"], 1)
    print(json.dumps(result))


if __name__ == "__main__":
    main()
