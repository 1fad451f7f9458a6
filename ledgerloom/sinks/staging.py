"""Rows of a batch written where readers don't look, before they are put in their places."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sinks import paths
from ledgerloom.sinks.generations import ADDED, COMPACTED, SEPARATOR, Day, folder_name
from ledgerloom.sinks.manifests import Folder, escaped

#: What separates a batch from the rest of the key of an attempt.
ATTEMPT = "/"


def check_key(batch: str) -> None:
    if not batch or SEPARATOR in batch or ATTEMPT in batch or batch in (COMPACTED, ADDED):
        raise ValueError(f"batch key {batch!r}")


def of_batch(batch: str) -> Column:
    """Filter on rows that some attempt to store the batch left."""
    return F.coalesce(F.startswith(F.col("attempt"), F.lit(f"{batch}{ATTEMPT}")), F.lit(False))


def stage(records: DataFrame, lake: str, name: str) -> str:
    """Write by outcome and day. Rows are gathered by day first, or every task would leave a small
    file in every day; adaptive execution splits a day that is too large for one task."""
    staged = f"{lake}/_staged/{escaped(name)}"
    (
        records.hint("rebalance", F.col("outcome"), F.col("ds"))
        .write.mode("overwrite")
        .partitionBy("outcome", "ds")
        .parquet(staged)
    )
    return staged


def staged_folders(spark: SparkSession, staged: str, batch: str, attempt: str, number: int) -> tuple[Folder, ...]:
    """The days that were staged, from listing them alone, as folders with the batch's name."""
    files: dict[Day, list[int]] = {}
    for path, size in paths.sizes(spark, f"{staged}/outcome=*/ds=*/part-*").items():
        outcome, ds = (part.split("=", 1)[1] for part in path.split("/")[-3:-1])
        files.setdefault((outcome, ds), []).append(size)
    name = escaped(folder_name(batch, number))
    return tuple(Folder(o, d, name, attempt, len(s), sum(s)) for (o, d), s in sorted(files.items()))


def place(spark: SparkSession, lake: str, staged: str, folders: tuple[Folder, ...]) -> None:
    for folder in folders:
        target = folder.path(lake)
        paths.make_folder(spark, target.rsplit("/", 1)[0])
        paths.rename(spark, f"{staged}/outcome={folder.outcome}/ds={folder.ds}", target)


def is_shared(folder: Folder) -> bool:
    """Whether other batches have rows in it too."""
    return folder.folder.split(SEPARATOR)[0] in (COMPACTED, ADDED)


def clear(spark: SparkSession, lake: str, staged: str) -> None:
    paths.delete(spark, staged)
    for folder in (f"{lake}/_staged", lake):
        paths.delete_if_empty(spark, folder)
