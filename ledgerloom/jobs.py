"""The jobs a user runs (B1-B6); ``python -m ledgerloom`` is their command line."""

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.failures import DatasetFailures
from ledgerloom.operators.clean import clean_raw, parse_messages, raw_records
from ledgerloom.operators.grains import LatestBounds
from ledgerloom.plans.history import kept_rollups, update_history
from ledgerloom.plans.shared import build_reports
from ledgerloom.session import scratch_dir
from ledgerloom.sinks import paths
from ledgerloom.sinks.compaction import compact
from ledgerloom.sinks.lake import write_lake
from ledgerloom.sinks.publish import publish, verify_outputs
from ledgerloom.sinks.retake import retake_refused
from ledgerloom.sinks.warehouse import write_reports
from ledgerloom.sources.files import read_clean
from ledgerloom.streaming.ingest import ingest_stream

__all__ = [
    "build_reports",
    "compact",
    "ingest_batch",
    "ingest_messages",
    "ingest_stream",
    "publish",
    "retake_refused",
    "run_daily",
    "run_daily_lake",
    "store_batch_records",
    "store_reports",
    "update_history",
    "verify_outputs",
]


def ingest_batch(rows: DataFrame, rates: DataFrame, ingest_time: Column | None = None) -> DataFrame:
    """B2: the cleaning of the stream on a static frame of raw rows.

    ``ingest_time`` decides the rate: a column of the rows or one instant; the time of the
    run unless given. One instant is fixed here, and its rate looked up once.
    """
    time = F.current_timestamp() if ingest_time is None else ingest_time
    try:
        micros = rows.sparkSession.range(1).select(F.unix_micros(time)).first()[0]
    except AnalysisException:  # a column of the rows
        return clean_raw(raw_records(rows, time), rates)
    instant = F.timestamp_micros(F.lit(micros))
    return clean_raw(raw_records(rows, instant), rates, instant)


def ingest_messages(messages: DataFrame, rates: DataFrame) -> DataFrame:
    """B2 for stored messages, say a topic read from its start."""
    return clean_raw(parse_messages(messages), rates)


def store_batch_records(records: DataFrame, lake: str, batch: str) -> None:
    """Store ingested records; stored again, the same ``batch`` replaces itself."""
    write_lake(records, lake, batch)


def store_reports(
    spark: SparkSession,
    transactions: DataFrame,
    warehouse: str,
    names: Iterable[str] | None = None,
    threshold: int | str | None = "exact",
    failures: dict[str, Exception] | None = None,
    bounds: LatestBounds | None = None,
    kept: dict[str, DataFrame] | None = None,
) -> list[str]:
    """Build the reports and store them; gives the ids of the datasets stored in this run.

    A failure does not stop the rest. It is noted in ``failures``, or raised at the end.
    ``bounds`` are looked up in the table unless given; ``kept`` are rollups that are there.
    """
    scratch = scratch_dir(spark, "rollups")
    noted: dict[str, Exception] = {}
    try:
        reports = build_reports(transactions, scratch, names, threshold=threshold, failures=noted, bounds=bounds, kept=kept)
        try:
            write_reports(spark, reports, warehouse)
        except DatasetFailures as error:
            noted |= error.failures
    finally:
        paths.delete(spark, scratch)
    if noted and failures is None:
        raise DatasetFailures(noted)
    (failures if failures is not None else noted).update(noted)
    return [d for d in reports if d not in noted]


def run_daily(
    spark: SparkSession,
    transactions: DataFrame,
    warehouse: str,
    dest: str,
    names: Iterable[str] | None = None,
    threshold: int | str | None = "exact",
    bounds: LatestBounds | None = None,
    kept: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Build, store, publish and verify, in that order.

    A dataset that fails in a step is left out of the later ones, so an older table is never
    published in its place; the others go on, and the job fails at the end.
    """
    failures: dict[str, Exception] = {}
    stored = store_reports(spark, transactions, warehouse, names, threshold, failures, bounds, kept)
    try:
        publish(spark, warehouse, dest, stored)
    except DatasetFailures as error:
        failures |= error.failures
    published = [d for d in stored if d not in failures]
    checked = verify_outputs(spark, dest, published, warehouse=warehouse)
    if failures:
        raise DatasetFailures(failures)
    return checked


def run_daily_lake(
    spark: SparkSession,
    lake: str,
    history: str,
    warehouse: str,
    dest: str,
) -> DataFrame:
    """B6 on a lake, with the state of every day kept below ``history``: only days that batches touched
    since the last run are read. The high-value limit is exact."""
    update_history(spark, lake, history)
    bounds = LatestBounds.of_lake(spark, lake)
    scratch = scratch_dir(spark, "kept")
    try:
        kept = kept_rollups(spark, history, scratch, bounds)
        return run_daily(spark, read_clean(spark, lake), warehouse, dest, bounds=bounds, kept=kept)
    finally:
        paths.delete(spark, scratch)
