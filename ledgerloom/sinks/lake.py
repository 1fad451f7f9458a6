"""Partitioned table of ingested records (S6), safe to write again (ST3)."""

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.clean import ACCEPTED, REFUSED
from ledgerloom.sinks import generations, paths
from ledgerloom.sinks.compaction import take_out
from ledgerloom.sinks.manifests import PENDING, STORED, Folder, Manifest, read_manifest, write_manifest
from ledgerloom.sinks.staging import ATTEMPT, check_key, clear, is_shared, place, stage, staged_folders


def write_lake(records: DataFrame, lake: str, batch: str) -> Manifest | None:
    """Store one batch below ``lake/outcome=.../ds=.../batch=...``; gives its manifest, None where there
    were no records and none before.

    Clean and refused records go out in one job, which also counts them, so the input is read
    once.

    A batch that was stored before, perhaps with other rows (a replay after new rates, a corrected
    file), is replaced: the folders in its manifest go, also those of an attempt that broke off, and no
    others are looked at. Rows of it that now stand in rewritten folders are taken out there. In between
    readers may miss rows of this batch, but see none twice.
    """
    check_key(batch)
    spark = records.sparkSession
    attempt = f"{batch}{ATTEMPT}{uuid.uuid4().hex}"
    counts = Observation()
    counted = records.withColumn("attempt", F.lit(attempt)).observe(
        counts,
        F.count_if(F.col("outcome") == ACCEPTED).alias("accepted"),
        F.count_if(F.col("outcome") == REFUSED).alias("refused"),
    )
    staged = stage(counted, lake, attempt.replace(ATTEMPT, "-"))
    before = read_manifest(spark, lake, batch)
    filled = bool(staged_folders(spark, staged, batch, attempt, 0))
    manifest = None
    if before is not None or filled:
        # an empty batch may be optimised away, and its counts with it
        found = counts.get if filled else {"accepted": 0, "refused": 0}
        manifest = Manifest(batch, attempt, STORED, (), found["accepted"], found["refused"])
        manifest = put_in_place(spark, lake, manifest, before.folders if before else (), staged)
    clear(spark, lake, staged)
    return manifest


def put_in_place(spark: SparkSession, lake: str, manifest: Manifest, old: tuple[Folder, ...], staged: str) -> Manifest:
    """Exchange the old folders of a batch for staged ones. A crash anywhere is made up for by the next
    attempt, which finds in the manifest all folders that may be there."""
    while True:
        seen = take_out(spark, lake, manifest, old)
        with generations.locked(spark, lake):
            if generations.last_committed(spark, lake) != seen:
                continue  # days were rewritten meanwhile, perhaps with rows of an old attempt
            new = staged_folders(spark, staged, manifest.batch, manifest.attempt, generations.last_started(spark, lake))
            write_manifest(spark, lake, manifest.with_folders(PENDING, (*old, *new)))
            for folder in old:
                if not is_shared(folder):
                    paths.delete(spark, folder.path(lake))
            place(spark, lake, staged, new)
            manifest = manifest.with_folders(STORED, new)
            write_manifest(spark, lake, manifest)
            return manifest
