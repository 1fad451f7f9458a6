"""Published files (S8, S9, B4): one sorted CSV per dataset.

The layout is fixed by the report, not by its size: a file where hours, days or places bound the
rows, a folder of sorted files where users or merchants do not.
"""

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.failures import DatasetFailures
from ledgerloom.plans.catalog import DATASETS
from ledgerloom.plans.reports import sort_columns
from ledgerloom.sinks import paths
from ledgerloom.sinks.warehouse import read_stored, stored_datasets

#: About the rows of one file in a folder.
FILE_ROWS = 2_000_000


class PublishError(DatasetFailures):
    """Some datasets were not published."""


def published_path(dest: str, dataset_id: str) -> str:
    return f"{dest}/{DATASETS[dataset_id].file_stem}.csv"


def publish_one(df: DataFrame, dataset_id: str, dest: str, file_rows: int) -> None:
    """Write beside the target, look at the result, then put it in place.

    A single file takes the place of the old one in one rename: readers find either. An old folder
    is moved aside, and deleted when the new one is in place: after a crash in between, one of the two
    is there to be found. Readers may miss it for that moment.
    """
    spark = df.sparkSession
    spec = DATASETS[dataset_id].report
    target = published_path(dest, dataset_id)
    staged = f"{dest}/_staged/{DATASETS[dataset_id].file_stem}"
    order = sort_columns(spec)
    if spec.one_file:
        rows = df.coalesce(1).sortWithinPartitions(*order)
    else:
        # The keys settle ties, so equal measures do not pile up in one range.
        files = max(1, -(-df.count() // file_rows))
        rows = df.repartitionByRange(files, *order).sortWithinPartitions(*order)
    rows.write.mode("overwrite").option("header", True).csv(staged)
    written = paths.part_files(spark, staged, ".csv")
    if not written:
        raise OSError(f"nothing written to {staged}")
    if spec.one_file:
        paths.replace_file(spark, f"{staged}/{written[0]}", target)
        paths.delete(spark, staged)
        return
    aside = f"{dest}/_replaced/{DATASETS[dataset_id].file_stem}.csv"
    if paths.exists(spark, target):
        paths.delete(spark, aside)
        paths.make_folder(spark, f"{dest}/_replaced")
        paths.rename(spark, target, aside)
    paths.rename(spark, staged, target)
    paths.delete(spark, aside)


def publish(
    spark: SparkSession,
    warehouse: str,
    dest: str,
    ids: Iterable[str] | None = None,
    file_rows: int = FILE_ROWS,
    parallel: int = 4,
) -> None:
    """Publish stored datasets; the rest goes on past a failure, which is
    raised at the end."""
    failures: dict[str, Exception] = {}

    @inheritable_thread_target(spark)
    def attempt(dataset_id: str) -> None:
        try:
            publish_one(read_stored(spark, warehouse, dataset_id), dataset_id, dest, file_rows)
        except Exception as error:
            failures[dataset_id] = error

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        list(pool.map(attempt, stored_datasets(ids)))
    if failures:
        raise PublishError(failures)


def verify_outputs(
    spark: SparkSession,
    dest: str,
    ids: Iterable[str] | None = None,
    strict: bool = True,
    warehouse: str | None = None,
) -> DataFrame:
    """(dataset, readable, rows, columns) of each published file.

    The files are read to the end here and now. With ``warehouse``, a file is readable
    only if it has as many rows as the stored dataset. With ``strict``, a missing or
    unreadable file raises.
    """
    schema = "dataset string, readable boolean, rows bigint, columns string"
    checks, unreadable = [], []
    for dataset_id in stored_datasets(ids):
        try:
            found = spark.read.option("header", True).csv(published_path(dest, dataset_id))
            names = ",".join(found.columns)
            if found.columns != DATASETS[dataset_id].report.columns:
                raise ValueError(f"columns {names}")
            # all columns are parsed, so that a row cut short shows; one count comes back
            last = F.col(found.columns[-1])
            n = found.agg(F.count("*").alias("rows"), F.count(last)).first().rows
            if warehouse and n != (stored := read_stored(spark, warehouse, dataset_id).count()):
                raise ValueError(f"{n} rows, {stored} stored")
            checks.append((dataset_id, True, n, names))
        except Exception as error:
            unreadable.append(f"{dataset_id}: {error}")
            checks.append((dataset_id, False, None, None))
    if strict and unreadable:
        raise FileNotFoundError("; ".join(unreadable))
    return spark.createDataFrame(checks, schema)  # one row for each dataset of the registry
