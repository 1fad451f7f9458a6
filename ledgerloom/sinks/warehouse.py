"""Report tables in the warehouse (S7): typed Parquet, and CSV made from it."""

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from ledgerloom.failures import DatasetFailures
from ledgerloom.plans.catalog import DATASETS
from ledgerloom.plans.reports import sort_columns


def parquet_path(warehouse: str, dataset_id: str) -> str:
    return f"{warehouse}/parquet/{DATASETS[dataset_id].path}"


def csv_path(warehouse: str, dataset_id: str) -> str:
    return f"{warehouse}/csv/{DATASETS[dataset_id].path}"


def read_stored(spark: SparkSession, warehouse: str, dataset_id: str) -> DataFrame:
    return spark.read.parquet(parquet_path(warehouse, dataset_id))


def write_reports(
    spark: SparkSession,
    reports: dict[str, DataFrame],
    warehouse: str,
    csv: bool = True,
    parallel: int = 4,
) -> None:
    """Overwrite each dataset. CSV is written from the stored rows, not computed
    again, and in the report's order across its part files. The rest goes on past a
    failure, which is raised at the end."""
    failures: dict[str, Exception] = {}

    @inheritable_thread_target(spark)
    def attempt(dataset_id: str) -> None:
        try:
            store(dataset_id)
        except Exception as error:
            failures[dataset_id] = error

    def store(dataset_id: str) -> None:
        reports[dataset_id].write.mode("overwrite").parquet(parquet_path(warehouse, dataset_id))
        if csv:
            (
                read_stored(spark, warehouse, dataset_id)
                .orderBy(*sort_columns(DATASETS[dataset_id].report))
                .write.mode("overwrite")
                .option("header", True)
                .csv(csv_path(warehouse, dataset_id))
            )

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        list(pool.map(attempt, reports))
    if failures:
        raise DatasetFailures(failures)


def stored_datasets(ids: Iterable[str] | None) -> list[str]:
    ids = list(DATASETS if ids is None else ids)
    unknown = set(ids) - set(DATASETS)
    if unknown:
        raise ValueError(f"unknown datasets: {sorted(unknown)}")
    return ids
