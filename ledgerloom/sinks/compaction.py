"""Rewriting days of a lake (S2, S6): many small files into few, and rows taken out or moved.

A rewriting writes new folders beside the old ones, looks whether anything happened to the old ones
meanwhile, and then lets the new ones count by one rename (see ``generations``). Days that did change are left as they
were. The old folders go with the next compaction, so whoever began to read before can finish. One
rewriting is committed at a time; batches may be stored while it runs.
"""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.schema import LAKE, UNDATED
from ledgerloom.sinks import generations, paths
from ledgerloom.sinks.generations import ADDED, COMPACTED, SEPARATOR, Committed, Day
from ledgerloom.sinks.manifests import Folder, Manifest, read_manifests
from ledgerloom.sinks.staging import clear, is_shared, of_batch, place, stage, staged_folders

#: A day is worth rewriting from this many files on ...
LEAST_FILES = 8
#: ... of less than this on average.
SMALL_BYTES = 64 << 20


def compact(
    spark: SparkSession, lake: str, least_files: int = LEAST_FILES, small_bytes: int = SMALL_BYTES
) -> list[Day]:
    """Pack the small files of each day that has many into files as large as a shuffle partition
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes``); gives the days rewritten.

    One job rewrites all of them: rows are gathered by day, small days share a task and large ones are
    split. Which days those are comes from the manifests, read by executors. Folders that an earlier compaction
    replaced are deleted.
    """
    known = generations.committed(spark, lake)
    swept = sweep(spark, lake, known)
    days = crowded_days(spark, lake, known, least_files, small_bytes)
    if not days and not swept:
        return []
    return rewrite(spark, lake, days, swept=swept)


def crowded_days(
    spark: SparkSession, lake: str, known: Committed, least_files: int, small_bytes: int
) -> list[Day]:
    lines = read_manifests(spark, lake).where("outcome IS NOT NULL")
    number = generations.number_in(F.col("folder"))
    first = spark.createDataFrame([(o, d, n) for (o, d), n in known.days.items()], "outcome string, ds string, first int")
    loose = lines.join(F.broadcast(first), ["outcome", "ds"], "left").where(number >= F.coalesce("first", F.lit(0)))
    # a day rewritten before has at least one more file
    files = F.sum("files") + F.max(F.when(F.col("first").isNotNull(), 1).otherwise(0))
    crowded = (
        loose.groupBy("outcome", "ds")
        .agg(files.alias("files"), F.sum("bytes").alias("bytes"))
        .where((F.col("files") >= least_files) & (F.col("bytes") < F.col("files") * small_bytes))
    )
    return sorted((r.outcome, r.ds) for r in crowded.select("outcome", "ds").collect())  # days, not files


def sweep(spark: SparkSession, lake: str, known: Committed) -> set[Day]:
    """Delete the folders that earlier rewritings replaced; gives the days looked at."""
    days = set(known.days) - known.swept
    for day in days:
        for name in paths.names(spark, day_path(lake, day)):
            folder = name.removeprefix("batch=")
            if known.covers(day, folder) or (folder.startswith(COMPACTED + SEPARATOR) and not known.counts(day, folder)):
                paths.delete(spark, f"{day_path(lake, day)}/{name}")
    return days


def day_path(lake: str, day: Day) -> str:
    return f"{lake}/outcome={day[0]}/ds={day[1]}"


def files_of(spark: SparkSession, lake: str, days: Iterable[Day], known: Committed, below: int) -> dict[Day, set[str]]:
    """The files of each day that count now, of rewritings before ``below``."""
    found = {}
    for day in days:
        files = paths.matching(spark, f"{day_path(lake, day)}/batch=*/part-*")
        folders = {f: f.split("/")[-2].removeprefix("batch=") for f in files}
        found[day] = {f for f, b in folders.items() if known.counts(day, b) and generations.number_of(b) < below}
    return found


def stored_rows(spark: SparkSession, lake: str, outcome: str, known: Committed) -> DataFrame:
    """All columns of the rows that count, with the partition columns as they stand in the path."""
    path = f"{lake}/outcome={outcome}"
    if not paths.exists(spark, path):
        return spark.createDataFrame([], LAKE).withColumns({"ds": F.lit(None).cast("date"), "batch": F.lit("")})
    schema = LAKE.add("ds", "date").add("batch", "string")
    return spark.read.schema(schema).parquet(path).where(generations.counting(known, outcome))


def rows_of_days(spark: SparkSession, lake: str, days: list[Day], known: Committed, below: int) -> DataFrame:
    """Rows of some days with their ``outcome``; the days are a filter on the folders."""
    parts = None
    for outcome in sorted({o for o, _ in days}):
        listed = ",".join(ds for o, ds in days if o == outcome)
        chosen = F.array_contains(F.split(F.lit(listed), ","), F.coalesce(F.col("ds").cast("string"), F.lit(UNDATED)))
        number = generations.number_in(F.col("batch"))
        rows = stored_rows(spark, lake, outcome, known).where(chosen & (number < below)).withColumn("outcome", F.lit(outcome))
        parts = rows if parts is None else parts.unionByName(rows)
    return parts


def shared_folder() -> Column:
    return F.startswith("batch", F.lit(COMPACTED + SEPARATOR)) | F.startswith("batch", F.lit(ADDED + SEPARATOR))


def rewrite(
    spark: SparkSession,
    lake: str,
    days: list[Day],
    without: Column | None = None,
    swept: set[Day] = frozenset(),
    must: bool = False,
) -> list[Day]:
    """Rewrite days, without the rows for which ``without`` is true; gives those that were rewritten. With
    ``must``, a day that changed meanwhile is an error."""
    number = generations.start(spark, lake)
    known = generations.committed(spark, lake)
    name = f"{COMPACTED}-{number}"
    staged, folders, before = f"{lake}/_staged/{name}", (), {}
    if days:
        before = files_of(spark, lake, days, known, number)
        rows = rows_of_days(spark, lake, days, known, number).drop("batch")
        if without is not None:
            rows = rows.where(~without)
        staged = stage(rows, lake, name)
        folders = staged_folders(spark, staged, COMPACTED, name, number)
        place(spark, lake, staged, folders)
    with generations.locked(spark, lake):
        after = files_of(spark, lake, days, known, number)
        unchanged = [day for day in days if before[day] == after[day]]
        if must and len(unchanged) < len(days):
            raise RuntimeError(f"{sorted(set(days) - set(unchanged))} of {lake} changed while being rewritten")
        generations.commit(spark, lake, number, known, unchanged, swept)
    for folder in folders:
        if folder.day not in unchanged:
            paths.delete(spark, folder.path(lake))
    clear(spark, lake, staged)
    return unchanged


def take_out(spark: SparkSession, lake: str, manifest: Manifest, folders: Iterable[Folder]) -> int:
    """Take the rows that earlier attempts of a batch left out of the days that were rewritten since;
    gives the number of the last rewriting that was looked at."""
    known = generations.committed(spark, lake)
    days = sorted({f.day for f in folders if known.covers(f.day, f.folder) or is_shared(f)})
    if not days:
        return known.number
    stale = of_batch(manifest.batch) & (F.col("attempt") != manifest.attempt)
    holding = rows_of_days(spark, lake, days, known, known.number + 1).where(stale & shared_folder())
    dated = holding.select("outcome", F.coalesce(F.col("ds").cast("string"), F.lit(UNDATED)).alias("ds")).distinct()
    days = sorted((r.outcome, r.ds) for r in dated.collect())  # days of one batch
    if not days:
        return known.number
    rewrite(spark, lake, days, without=stale, must=True)
    return generations.last_committed(spark, lake)
