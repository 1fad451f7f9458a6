"""Refused records taken in again (D13, C2, C9): after new rates, or with other rules.

All that was refused is typed and converted anew, by the ingest time it came with. Records that are accepted
now move to their day; the days that they leave are rewritten without them. Both begin to count with the same
rename (see ``generations``), so at any time a record is in one outcome. Rows keep the attempt that stored
them, and the manifests of their batches learn where they are now: a batch that is stored again replaces them
too, and kept history sees the days that gained rows.
"""

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.clean import ACCEPTED, REFUSED, clean_raw, parse_messages
from ledgerloom.schema import UNDATED
from ledgerloom.sinks import generations
from ledgerloom.sinks.compaction import files_of, rows_of_days, stored_rows
from ledgerloom.sinks.generations import ADDED, COMPACTED
from ledgerloom.sinks.manifests import Folder, read_manifest, write_manifest
from ledgerloom.sinks.staging import ATTEMPT, clear, place, stage, staged_folders

KEEP = ("attempt", "was_ds", "was_reason")


def cleaned_again(refused: DataFrame, rates: DataFrame) -> DataFrame:
    messages = refused.select(
        F.col("raw_value").cast("binary").alias("value"),
        F.col("ingest_time").alias("timestamp"),
        "attempt",
        F.coalesce(F.col("ds").cast("string"), F.lit(UNDATED)).alias("was_ds"),
        F.col("reject_reason").alias("was_reason"),
    )
    return clean_raw(parse_messages(messages, KEEP), rates, keep=KEEP)


def retake_refused(spark: SparkSession, lake: str, rates: DataFrame) -> int:
    """Take refused records in again; gives how many were accepted. Run again, it finds nothing to do."""
    number = generations.start(spark, lake)
    known = generations.committed(spark, lake)
    again = cleaned_again(stored_rows(spark, lake, REFUSED, known), rates)
    differs = (F.col("outcome") == ACCEPTED) | ~F.col("reject_reason").eqNullSafe(F.col("was_reason"))
    found = again.where(differs).select("was_ds").distinct().collect()  # days
    if not found:
        return 0
    days = sorted((REFUSED, row.was_ds) for row in found)
    before = files_of(spark, lake, days, known, number)
    rows = cleaned_again(rows_of_days(spark, lake, days, known, number), rates)
    name = f"{ADDED}-{number}"
    staged = stage(rows.drop("was_ds", "was_reason"), lake, name)
    folders = tuple(
        folder
        for kind in (COMPACTED, ADDED)
        for folder in staged_folders(spark, staged, kind, name, number)
        if (folder.day in days) == (kind == COMPACTED)
    )
    moved = moved_rows(spark, staged)
    place(spark, lake, staged, folders)
    with generations.locked(spark, lake):
        if files_of(spark, lake, days, known, number) != before:
            raise RuntimeError(f"refused records of {lake} changed while being taken in again; run it again")
        for batch in sorted({row.batch for row in moved}):
            note(spark, lake, batch, [row for row in moved if row.batch == batch], number)
        generations.commit(spark, lake, number, known, days, adds=True)
    clear(spark, lake, staged)
    return sum(row.n for row in moved)


def moved_rows(spark: SparkSession, staged: str) -> list:
    """(batch, attempt, ds, n) of the rows accepted now: a row for each batch and day that gained some."""
    rows = spark.read.parquet(staged).where(F.col("outcome") == ACCEPTED)
    batch = F.substring_index("attempt", ATTEMPT, 1).alias("batch")
    return rows.groupBy(batch, "attempt", F.col("ds").cast("string").alias("ds")).agg(F.count("*").alias("n")).collect()


def note(spark: SparkSession, lake: str, batch: str, moved: list, number: int) -> None:
    """The manifest of a batch with the days that its rows moved to."""
    manifest = read_manifest(spark, lake, batch)
    if manifest is None:
        return
    name = generations.folder_name(ADDED, number)
    # another name for the attempt, so that a day with other rows of it is seen to have changed
    folders = tuple(Folder(ACCEPTED, row.ds, name, f"{row.attempt}+{number}", 0, 0) for row in moved)
    n = sum(row.n for row in moved)
    write_manifest(
        spark,
        lake,
        replace(manifest, folders=(*manifest.folders, *folders), accepted=manifest.accepted + n, refused=manifest.refused - n),
    )
