"""Command line of the jobs."""

import argparse

from pyspark.sql import functions as F

from ledgerloom import jobs, sources
from ledgerloom.operators.grains import LatestBounds
from ledgerloom.plans import DATASETS
from ledgerloom.session import get_session
from ledgerloom.sinks.compaction import LEAST_FILES


def key_values(pairs: list[str]) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in pairs)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="ledgerloom")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, *required: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        for option in required:
            sub.add_argument(f"--{option}", required=True)
        return sub

    stream = command("ingest-stream", "lake", "rates", "checkpoint")
    stream.add_argument("--format", default="kafka")
    stream.add_argument("--path")
    stream.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    stream.add_argument("--servers")
    stream.add_argument("--topic", default="transactions")
    stream.add_argument("--max-offsets", type=int)
    stream.add_argument("--available-now", action="store_true")

    batch = command("ingest-csv", "input", "lake", "rates", "batch")
    batch.add_argument(
        "--ingest-time", metavar="TIMESTAMP", help="decides the rate; the time of the run unless given"
    )
    retake = command("retake", "lake", "rates")
    for sub in (stream, batch, retake):
        sub.add_argument("--whole-file-rates", action="store_true")
    pack = command("compact", "lake")
    pack.add_argument("--least-files", type=int, default=LEAST_FILES, help="of a day, for it to be packed")

    send = command("send-csv", "input")
    send.add_argument("--format", default="kafka")
    send.add_argument("--path")
    send.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    send.add_argument("--servers")
    send.add_argument("--topic", default="transactions")

    reports = command("reports", "lake", "warehouse")
    daily = command("daily", "lake", "warehouse", "dest")
    daily.add_argument("--history", help="where states of past days are kept between runs; the limit is exact then")
    for sub in (reports, daily):
        sub.add_argument("--threshold", choices=("exact", "approx"), default="exact")

    command("publish", "warehouse", "dest")
    command("verify", "dest")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    if getattr(args, "format", None) == "kafka" and not args.servers:
        raise SystemExit("--format kafka needs --servers")
    spark = get_session(f"ledgerloom-{args.command}")
    if args.command == "ingest-stream":
        options = key_values(args.option)
        if args.format == "kafka":
            options |= sources.kafka_options(
                args.servers, args.topic, max_offsets_per_trigger=args.max_offsets
            )
        query = jobs.ingest_stream(
            sources.read_message_stream(spark, args.format, args.path, options),
            lambda session: sources.read_rates_json(session, args.rates, args.whole_file_rates),
            args.lake,
            args.checkpoint,
            {"availableNow": True} if args.available_now else None,
        )
        query.awaitTermination()
    elif args.command == "ingest-csv":
        rows = sources.read_transactions_csv(spark, args.input)
        rates = sources.read_rates_json(spark, args.rates, args.whole_file_rates)
        time = F.to_timestamp(F.lit(args.ingest_time)) if args.ingest_time else None
        records = jobs.ingest_batch(rows, rates, time)
        jobs.store_batch_records(records, args.lake, args.batch)
    elif args.command == "retake":
        rates = sources.read_rates_json(spark, args.rates, args.whole_file_rates)
        print(f"accepted now: {jobs.retake_refused(spark, args.lake, rates)}")
    elif args.command == "compact":
        print(f"days packed: {len(jobs.compact(spark, args.lake, args.least_files))}")
    elif args.command == "send-csv":
        rows = sources.read_transactions_csv(spark, args.input)
        options = key_values(args.option)
        if args.format == "kafka":
            options |= {"kafka.bootstrap.servers": args.servers, "topic": args.topic}
        sources.write_messages(rows, args.format, args.path, options)
    elif args.command == "reports":
        jobs.store_reports(
            spark,
            sources.read_clean(spark, args.lake),
            args.warehouse,
            threshold=args.threshold,
            bounds=LatestBounds.of_lake(spark, args.lake),
        )
    elif args.command == "daily" and args.history:
        jobs.run_daily_lake(spark, args.lake, args.history, args.warehouse, args.dest).show(len(DATASETS), truncate=False)
    elif args.command == "daily":
        jobs.run_daily(
            spark,
            sources.read_clean(spark, args.lake),
            args.warehouse,
            args.dest,
            threshold=args.threshold,
            bounds=LatestBounds.of_lake(spark, args.lake),
        ).show(len(DATASETS), truncate=False)
    elif args.command == "publish":
        jobs.publish(spark, args.warehouse, args.dest)
    elif args.command == "verify":
        jobs.verify_outputs(spark, args.dest).show(len(DATASETS), truncate=False)


if __name__ == "__main__":
    main()
