"""Time the ten job-market queries and print one JSON line.

The postings, skills and summaries are derived from the tables in
``BENCH_SF_DIR`` and written to Parquet before the clock starts. A time covers
reading and computing the whole result; it is the median of ``RUNS`` runs.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

from laborscope.catalog import QUERIES
from laborscope.catalog.jobs import job_dataset

HEADLINE = {f"q{n}": f"job_q{n}" for n in range(1, 11)} | {"q10b": "job_q10_by_type"}
RUNS = 3


def seconds(spark: SparkSession, folder: str, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("laborscope-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="laborscope-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    job_dataset(spark, folder, "postings", "skills", "summary")
    times = {
        label: round(statistics.median(seconds(spark, folder, name) for _ in range(RUNS)), 3)
        for label, name in HEADLINE.items()
    }
    print(
        json.dumps(
            {
                "metric": "ten job-market queries, total",
                "value": round(sum(times[f"q{n}"] for n in range(1, 11)), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
