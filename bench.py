"""Times the reports; prints one JSON line.

Each of the 35 datasets is built on its own from ``$BENCH_SF_DIR``; then, from a
stored clean table, all of them one by one and all of them by way of rollups.
"""

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession

from checks.queries import dataset_query
from ledgerloom import jobs
from ledgerloom.fixtures import constant_rate, raw_from_events, transactions_from_lineitem
from ledgerloom.plans import DATASETS, build_reports, report
from ledgerloom.schema import RAW_FIELDS
from ledgerloom.session import scratch_dir

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    run(dataset_query(DATASETS["merchant_analysis_day"])(spark, SF_DIR))  # start-up costs
    queries = {}
    for dataset in DATASETS.values():
        query = dataset_query(dataset)
        queries[dataset.id] = timed(lambda: run(query(spark, SF_DIR)))
    value = round(sum(queries.values()), 3)

    scratch = scratch_dir(spark, "bench")
    transactions_from_lineitem(spark, SF_DIR).write.parquet(f"{scratch}/clean")
    clean = spark.read.parquet(f"{scratch}/clean")

    def one_by_one() -> None:
        for d in DATASETS.values():
            run(report(clean, d.report.name, d.grain, sort=False))

    def shared() -> None:
        for df in build_reports(clean, scratch_dir(spark, "rollups")).values():
            run(df)

    def ingest() -> None:
        rows = raw_from_events(spark, SF_DIR).select(*RAW_FIELDS)
        jobs.store_batch_records(
            jobs.ingest_batch(rows, constant_rate(spark)), f"{scratch}/lake", "bench"
        )

    queries["all_reports_one_by_one"] = timed(one_by_one)
    queries["all_reports_shared"] = timed(shared)
    queries["ingest_batch"] = timed(ingest)
    print(
        json.dumps(
            {
                "metric": "35 report datasets built one by one from the source tables",
                "value": value,
                "unit": "sec",
                "queries": queries,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
