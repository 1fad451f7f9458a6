"""The queries the driver runs, each over the whole tables of ``sf_dir``."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom import jobs, sources
from ledgerloom.fixtures import (
    COLUMNS,
    constant_rate,
    noon_rates,
    raw_from_events,
    table,
    transactions_from_lineitem,
)
from ledgerloom.operators.clean import (
    accepted,
    clean_raw,
    parse_messages,
    raw_records,
    type_records,
)
from ledgerloom.operators.fx import with_amount_vnd
from ledgerloom.operators.grains import GRAINS, LatestBounds, latest_bounds_frame
from ledgerloom.plans import DATASETS, REPORTS, Dataset, build_reports, report
from ledgerloom.plans.catalog import SPREAD
from ledgerloom.plans.history import kept_rollups
from ledgerloom.plans.reports import high_value_threshold, is_high_value, top
from ledgerloom.plans.shared import SOURCES
from ledgerloom.schema import RAW_FIELDS
from ledgerloom.session import scratch_dir
from ledgerloom.sinks.manifests import batch_counts as read_batch_counts
from ledgerloom.sinks.warehouse import csv_path, write_reports
from ledgerloom.streaming.ingest import store_batch

Query = Callable[[SparkSession, str], DataFrame]

TOP_K = 10
#: O2: report, and the grain it is looked at.
TOPS = {
    "top_hours": ("hourly_analysis", "year"),
    "top_cities": ("city_analysis", "year"),
    "top_merchants": ("merchant_analysis", "year"),
}
#: Datasets derived from rollups, one per family at its widest grain.
SHARED = [d.id for d in DATASETS.values() if d.grain in (None, "year")]
STORED_CSV = "city_analysis_year"


def comparable(clean: DataFrame) -> DataFrame:
    """Clean records without the time of processing, and with the decimal as a
    double, which both engines hand over alike."""
    return clean.select(*COLUMNS).withColumn("amount_usd", F.col("amount_usd").cast("double"))


def facts(spark: SparkSession, sf_dir: str, name: str) -> int | None:
    """About as many as there are transactions, for reports that ask; only the ends of files are read."""
    return table(spark, sf_dir, "lineitem").count() if name in SPREAD else None


def stored(transactions: DataFrame) -> DataFrame:
    """Transactions as a table of their own, as a lake has them: what reads them several times
    joins once."""
    path = scratch_dir(transactions.sparkSession, "clean")
    transactions.write.parquet(path)
    return transactions.sparkSession.read.parquet(path)


def dataset_query(dataset: Dataset, threshold: str = "exact") -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = transactions_from_lineitem(spark, sf_dir, dataset.report.reads)
        limit = threshold
        if dataset.report.high_value:
            # over the amount alone, or each quantile scan would carry the report's joins
            limit = high_value_threshold(transactions_from_lineitem(spark, sf_dir, ["amount_vnd"]), threshold)
        return report(df, dataset.report.name, dataset.grain, threshold=limit, row_count=facts(spark, sf_dir, dataset.report.name))

    return run


def shared_query(dataset: Dataset) -> Query:
    """The dataset by way of the rollups, as ``build_reports`` makes it."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = transactions_from_lineitem(spark, sf_dir)
        if len(SOURCES[dataset.report.name]) > 1:
            df = stored(df.select(*dataset.report.reads))
        grains = [dataset.grain] if dataset.grain else None
        built = build_reports(df, scratch_dir(spark, "rollups"), [dataset.report.name], grains, row_count=facts(spark, sf_dir, dataset.report.name))
        return built[dataset.id]

    return run


def top_query(name: str, grain: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = transactions_from_lineitem(spark, sf_dir, REPORTS[name].reads)
        return top(report(df, name, grain, sort=False), name, TOP_K)

    return run


def latest_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_bounds_frame(transactions_from_lineitem(spark, sf_dir, ["ds"]))


def high_value_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows at or above the exact P95: how many, and the least of them."""
    df = transactions_from_lineitem(spark, sf_dir, ["amount_vnd"])
    return df.where(is_high_value(high_value_threshold(df))).agg(
        F.min("amount_vnd").alias("threshold"), F.count("*").alias("row_count")
    )


def high_value_approx_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the approximate P95 has a rank within 0.01 of 0.95."""
    df = transactions_from_lineitem(spark, sf_dir, ["amount_vnd"])
    limit = high_value_threshold(df, "approx")
    amount = F.col("amount_vnd")
    return df.agg(
        ((F.count_if(amount < limit) <= 0.96 * F.count(amount)) & (F.count_if(amount <= limit) >= 0.94 * F.count(amount))).alias("within")
    )


def moved_days(df: DataFrame) -> DataFrame:
    """Purchases stored two days after their own day."""
    return df.withColumn("ds", F.date_add("ds", 2))


def moved_weekdays(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = REPORTS["weekday_vs_weekend"]
    return report(moved_days(transactions_from_lineitem(spark, sf_dir, spec.reads)), spec.name)


def shared_moved_weekdays(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = moved_days(transactions_from_lineitem(spark, sf_dir))
    return build_reports(df, scratch_dir(spark, "rollups"), ["weekday_vs_weekend"])["weekday_vs_weekend"]


def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.count_rows(transactions_from_lineitem(spark, sf_dir, ["ds"]))


def stored_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report written to the warehouse as CSV and read from there."""
    dataset = DATASETS[STORED_CSV]
    df = transactions_from_lineitem(spark, sf_dir, dataset.report.reads)
    result = report(df, dataset.report.name, dataset.grain, sort=False)
    warehouse = scratch_dir(spark, "warehouse")
    write_reports(spark, {dataset.id: result}, warehouse)
    return sources.read_report_csv(spark, csv_path(warehouse, dataset.id), result.schema)


def published_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily run over all datasets, up to the verification of its files."""
    scratch = scratch_dir(spark, "daily")
    df = stored(transactions_from_lineitem(spark, sf_dir))
    return jobs.run_daily(spark, df, f"{scratch}/warehouse", f"{scratch}/published")


def clean_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows to JSON messages, parsed and cleaned again."""
    rows = raw_from_events(spark, sf_dir)
    messages = rows.select(
        F.to_json(F.struct(*RAW_FIELDS)).cast("binary").alias("value"),
        F.col("ts").alias("timestamp"),
    )
    records = clean_raw(parse_messages(messages), constant_rate(spark))
    return comparable(accepted(records))


def clean_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows by way of CSV files and the batch ingest."""
    path = scratch_dir(spark, "csv")
    rows = raw_from_events(spark, sf_dir).select(*RAW_FIELDS)
    rows.write.options(header=True, escape='"').csv(path)
    records = jobs.ingest_batch(sources.read_transactions_csv(spark, path), constant_rate(spark))
    return comparable(accepted(records))


def message_archive(spark: SparkSession, sf_dir: str, path: str) -> None:
    rows = raw_from_events(spark, sf_dir)
    rows.select(
        F.to_json(F.struct(*RAW_FIELDS)).cast("binary").alias("value"),
        F.col("ts").alias("timestamp"),
    ).repartition("timestamp").write.parquet(path)


def ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archived messages streamed into a lake in several batches, and read back."""
    scratch = scratch_dir(spark, "stream")
    message_archive(spark, sf_dir, f"{scratch}/messages")
    jobs.ingest_stream(
        sources.read_message_stream(
            spark, "parquet", f"{scratch}/messages", {"maxFilesPerTrigger": "2"}
        ),
        lambda session: noon_rates(session, sf_dir),
        f"{scratch}/lake",
        f"{scratch}/checkpoint",
        {"availableNow": True},
    ).awaitTermination()
    return comparable(sources.read_clean(spark, f"{scratch}/lake"))


def fx_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event's amount at the rate in force at its time, NULL before the first."""
    rows = raw_from_events(spark, sf_dir)
    typed = type_records(raw_records(rows, F.col("ts")))
    return with_amount_vnd(typed, noon_rates(spark, sf_dir), "ingest_time").select(
        "user_id", "time", "ds", F.col("vnd_per_usd").cast("double"), "amount_vnd"
    )


def ingest_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many records are accepted, and refused for each reason, where some
    messages are broken, some dates impossible or incomplete, and some amounts too
    large or no numbers."""
    rows = raw_from_events(spark, sf_dir)
    key = F.col("event_id")
    damaged = rows.withColumns(
        {
            "Day": F.when(key % 13 == 0, "31").when(key % 19 == 0, "123").when(key % 17 != 0, F.col("Day")),
            "Month": F.when(key % 13 == 0, "2").when(key % 23 == 0, "100").otherwise(F.col("Month")),
            "Amount": F.when(key % 29 == 0, "$12345678901.00")
            .when(key % 31 == 0, "$1,234.50")
            .otherwise(F.col("Amount")),
        }
    )
    text = F.when(key % 11 == 0, "{bad").otherwise(F.to_json(F.struct(*RAW_FIELDS)))
    messages = damaged.select(text.cast("binary").alias("value"), F.col("ts").alias("timestamp"))
    records = clean_raw(parse_messages(messages), noon_rates(spark, sf_dir))
    return records.groupBy(
        "outcome", F.coalesce("reject_reason", F.lit("none")).alias("reason")
    ).agg(F.count("*").alias("row_count"))


def kept_reports(spark: SparkSession, sf_dir: str, name: str, grain: str | None) -> DataFrame:
    """A report out of the states kept by day, after a first batch, and a second one that adds
    to some days of the first. The transactions themselves are not looked at."""
    scratch = scratch_dir(spark, "history")
    lake, store = f"{scratch}/lake", f"{scratch}/history"
    rows = raw_from_events(spark, sf_dir)
    later = (F.dayofmonth("ts") > 20) | ((F.dayofmonth("ts") == 5) & (F.col("event_id") % 3 == 0))
    for batch, part in (("first", rows.where(~later)), ("second", rows.where(later))):
        records = jobs.ingest_batch(part.select(*RAW_FIELDS), constant_rate(spark))
        jobs.store_batch_records(records, lake, batch)
        jobs.update_history(spark, lake, store)
    bounds = LatestBounds.of_lake(spark, lake)
    kept = kept_rollups(spark, store, f"{scratch}/merged", bounds)
    none = sources.read_clean(spark, lake).where("1 = 0")
    grains = [grain] if grain else None
    built = build_reports(none, f"{scratch}/rollups", [name], grains, threshold=None, bounds=bounds, kept=kept)
    return built[f"{name}_{grain}" if grain else name]


def incremental_daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kept_reports(spark, sf_dir, "daily_summary", None)


def kept_merchant_analysis_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of a month as the union of sets kept by day."""
    return kept_reports(spark, sf_dir, "merchant_analysis", "month")


def kept_high_value_analysis_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact limit, and what lies above it, from kept slices and tails."""
    return kept_reports(spark, sf_dir, "high_value_analysis", "month")


def sent_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows sent as messages, taken in and cleaned."""
    path = scratch_dir(spark, "topic")
    sources.write_messages(raw_from_events(spark, sf_dir).select(*RAW_FIELDS), "text", path)
    messages = sources.read_messages(spark, "text", path)
    return comparable(accepted(jobs.ingest_messages(messages, constant_rate(spark))))


def rates_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversion with rates read from stored JSON documents, one a day."""
    path = scratch_dir(spark, "rates")
    rows = raw_from_events(spark, sf_dir)
    days = rows.select(F.col("ts").cast("date").alias("date")).distinct()
    rate = (25_000 + F.dayofmonth("date") * 10).cast("double")
    days.select("date", F.struct(rate.alias("vnd"), F.lit(0.9).alias("eur")).alias("usd")).write.json(path)
    typed = type_records(raw_records(rows, F.col("ts")))
    return with_amount_vnd(typed, sources.read_rates_json(spark, path), "ingest_time").select(
        "user_id", "time", "ds", F.col("vnd_per_usd").cast("double"), "amount_vnd"
    )


def sorted_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored report in its own order, with the place of each row."""
    dataset = DATASETS[STORED_CSV]
    df = transactions_from_lineitem(spark, sf_dir, dataset.report.reads)
    ordered = report(df, dataset.report.name, dataset.grain, sort=True)
    # the rows of one report by place: as few as there are cities
    place = F.row_number().over(Window.orderBy(F.monotonically_increasing_id()))
    return ordered.select("*", place.cast("long").alias("place"))


def csv_text(rows: DataFrame, names: list[str], key: Column) -> DataFrame:
    """Lines of CSV below a header of ``names``; every seventh has a field too many, every
    eleventh is cut off after nine."""
    fields = [F.concat(F.lit('"'), F.replace(F.col(f"`{n}`"), F.lit('"'), F.lit('""')), F.lit('"')) for n in names]
    line = (
        F.when(key % 7 == 0, F.concat_ws(",", *fields, F.lit("more")))
        .when(key % 11 == 0, F.concat_ws(",", *fields[:9]))
        .otherwise(F.concat_ws(",", *fields))
    )
    return rows.select(line.alias(",".join(names)))


def csv_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sets of CSV files with other column orders, ragged rows in both: what is
    accepted, by place, and what is refused."""
    base = scratch_dir(spark, "csv")
    rows, kept = raw_from_events(spark, sf_dir), None
    for half, names in enumerate((list(RAW_FIELDS), list(reversed(RAW_FIELDS)))):
        path = f"{base}/{half}"
        lines = csv_text(rows.where(F.col("event_id") % 2 == half), names, F.col("event_id"))
        # one column, its text left as it is
        lines.write.options(header=True, sep="\u0001", quote="\u0000", escapeQuotes=False).csv(path)
        records = jobs.ingest_batch(sources.read_transactions_csv(spark, path), constant_rate(spark))
        kept = records if kept is None else kept.union(records)
    clean = F.col("outcome") == "clean"
    return kept.groupBy(
        "outcome",
        F.coalesce("reject_reason", F.lit("none")).alias("reason"),
        *(F.when(clean, F.col(c)).alias(c) for c in ("merchant_city", "merchant_state")),
    ).agg(F.count("*").alias("row_count"), F.sum(F.when(clean, F.col("amount_vnd"))).alias("total_vnd"))


def replayed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch stored before its rates were there, its commit lost, and run again with them:
    every message once, over both outcomes."""
    scratch = scratch_dir(spark, "replay")
    message_archive(spark, sf_dir, f"{scratch}/messages")
    messages = sources.read_messages(spark, "parquet", f"{scratch}/messages")
    for known in (noon_rates(spark, sf_dir).limit(0), noon_rates(spark, sf_dir)):
        store_batch(messages, known, f"{scratch}/lake", "query-0")
    return both_outcomes(spark, f"{scratch}/lake")


def both_outcomes(spark: SparkSession, lake: str) -> DataFrame:
    """Every stored record once, with what identifies it and where it is."""
    clean = sources.read_clean(spark, lake).select("user_id", "time", "ds", F.lit("clean").alias("outcome"))
    refused = sources.read_rejected(spark, lake).select(
        F.get_json_object("raw_value", "$.User").cast("int").alias("user_id"),
        F.concat(F.get_json_object("raw_value", "$.Time"), F.lit(":00")).alias("time"),
        F.lit(None).cast("date").alias("ds"),
        F.lit("rejected").alias("outcome"),
    )
    return clean.union(refused)


def compacted_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five batches, the last stored without two thirds of its rows; packed; that batch stored again
    as it should be, and packed again."""
    lake = f"{scratch_dir(spark, 'compacted')}/lake"
    rows, number = raw_from_events(spark, sf_dir), F.col("event_id") % 5
    for batch in range(5):
        part = rows.where(number == batch)
        known = part.where(F.col("event_id") % 3 == 0) if batch == 4 else part
        jobs.store_batch_records(jobs.ingest_batch(known.select(*RAW_FIELDS), constant_rate(spark)), lake, f"b{batch}")
    jobs.compact(spark, lake, least_files=2)
    part = rows.where(number == 4)
    jobs.store_batch_records(jobs.ingest_batch(part.select(*RAW_FIELDS), constant_rate(spark)), lake, "b4")
    jobs.compact(spark, lake, least_files=2)
    return comparable(sources.read_clean(spark, lake))


def retaken_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches stored before most of their rates were known; taken in again, twice, with all rates;
    one of them stored again after that."""
    scratch = scratch_dir(spark, "retaken")
    lake = f"{scratch}/lake"
    message_archive(spark, sf_dir, f"{scratch}/messages")
    messages = sources.read_messages(spark, "parquet", f"{scratch}/messages")
    rates = noon_rates(spark, sf_dir)
    late = F.dayofmonth("effective_from") > 20
    for batch in range(2):
        part = messages.where(F.pmod(F.xxhash64("value", "timestamp"), F.lit(2)) == batch)
        store_batch(part, rates.where(late), lake, f"query-{batch}")
    for _ in range(2):
        jobs.retake_refused(spark, lake, rates)
    store_batch(messages.where(F.pmod(F.xxhash64("value", "timestamp"), F.lit(2)) == 0), rates, lake, "query-0")
    return both_outcomes(spark, lake)


def batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of seven batches took in and refused, as its write counted it."""
    lake = f"{scratch_dir(spark, 'counts')}/lake"
    rows, number = raw_from_events(spark, sf_dir), F.col("event_id") % 7
    for batch in range(7):
        part = rows.where(number == batch).select(*(F.lit("x").alias(c) if batch == 3 and c == "Year" else F.col(f"`{c}`") for c in RAW_FIELDS))
        jobs.store_batch_records(jobs.ingest_batch(part, constant_rate(spark)), lake, f"b{batch}")
    return read_batch_counts(spark, lake)


def registered() -> dict[str, Query]:
    queries: dict[str, Query] = {d.id: dataset_query(d) for d in DATASETS.values()}
    queries |= {f"shared_{key}": shared_query(DATASETS[key]) for key in SHARED}
    queries |= {
        f"high_value_approx_{g}": dataset_query(DATASETS[f"high_value_analysis_{g}"], "approx")
        for g in GRAINS
    }
    queries |= {name: top_query(*spec) for name, spec in TOPS.items()}
    return queries | {
        "latest_bounds": latest_bounds,
        "high_value_limit": high_value_limit,
        "row_count": row_count,
        "stored_csv_report": stored_csv,
        "published_files": published_files,
        "clean_from_json": clean_from_json,
        "clean_from_csv": clean_from_csv,
        "ingest_stream": ingest_stream,
        "fx_conversion": fx_conversion,
        "ingest_outcomes": ingest_outcomes,
        "high_value_approx_limit": high_value_approx_limit,
        "moved_weekdays": moved_weekdays,
        "shared_moved_weekdays": shared_moved_weekdays,
        "csv_outcomes": csv_outcomes,
        "replayed_stream": replayed_stream,
        "sent_messages": sent_messages,
        "rates_from_json": rates_from_json,
        "sorted_report": sorted_report,
        "incremental_daily_summary": incremental_daily_summary,
        "kept_merchant_analysis_month": kept_merchant_analysis_month,
        "kept_high_value_analysis_month": kept_high_value_analysis_month,
        "compacted_lake": compacted_lake,
        "retaken_records": retaken_records,
        "batch_counts": batch_counts,
    }
