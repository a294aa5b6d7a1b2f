"""Run the job-market queries: ``spark-submit`` this file or ``python -m laborscope``."""

from __future__ import annotations

import argparse
from dataclasses import replace

from pyspark.sql import SparkSession

from laborscope.plans import QUERIES, JobDataset, run_query
from laborscope.session import size_shuffles
from laborscope.sources import csv_to_parquet
from laborscope.sources.storage import SUCCESS_MARKER, exists


def main() -> None:
    parser = argparse.ArgumentParser(prog="laborscope", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    run = commands.add_parser("run", help="run queries and write their results")
    run.add_argument("folder", help="folder or URI with the tables")
    run.add_argument("output", help="new folder for the results")
    run.add_argument("--queries", type=int, nargs="*", default=sorted(QUERIES))
    run.add_argument("--postings", default="postings", help="a .csv name is read as CSV")
    run.add_argument("--skills", default="skills")
    run.add_argument("--summary", default="summary")
    run.add_argument("--prepared-summary", help="converted Parquet folder of the summaries")

    run.add_argument("--unique", help="folder for postings deduplicated once; reused if there")

    convert = commands.add_parser("convert", help="convert a multi-line CSV to Parquet")
    convert.add_argument("source")
    convert.add_argument("target")
    convert.add_argument("--rows-per-part", type=int, default=20_000)
    convert.add_argument("--columns", nargs="*")

    options = parser.parse_args()
    spark = SparkSession.builder.appName("laborscope").getOrCreate()
    if options.command == "convert":
        parts, rows = csv_to_parquet(
            spark, options.source, options.target, options.columns, options.rows_per_part
        )
        print(f"{rows} rows in {parts} parts: {options.target}")
        return
    size_shuffles(spark, options.folder)
    data = JobDataset(
        spark,
        options.folder,
        options.postings,
        options.skills,
        options.summary,
        options.prepared_summary,
    )
    if options.unique:
        if exists(spark, f"{options.unique.rstrip('/')}/{SUCCESS_MARKER}"):
            data = replace(data, unique_folder=options.unique)
        else:
            data = data.with_unique_postings(options.unique)
    for number in options.queries:
        seconds = run_query(number, data, options.output)
        print(f"query {number}: {seconds:.2f} s")


if __name__ == "__main__":
    main()
