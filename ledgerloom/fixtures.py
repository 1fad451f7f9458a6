"""Clean transactions derived from star-schema tables.

Two mappings: ``events`` (one month, real times of day) and ``lineitem`` (seven
years, so day, month and year differ). The dimension joins are left joins on
primary keys and keep every row as it is, so a join is left out when none of its
columns is asked for.
"""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import to_vnd
from ledgerloom.plans.spread import partitions

RATE = 25380
MAX_BROADCAST_MERCHANTS = 100_000
MERCHANT_COLUMNS = {"merchant_name", "merchant_city", "merchant_state"}

#: Order of the mapped columns.
COLUMNS = (
    "user_id", "card_id", "time", "amount_usd", "use_chip",
    "merchant_name", "merchant_city", "merchant_state", "zip", "mcc",
    "has_errors", "is_fraud", "transaction_date", "amount_vnd", "ds",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier with its nation as city and its region as state.

    Spark overestimates the size of joined tables, so it would shuffle the facts
    even for few suppliers. They are broadcast when counted to be few.
    """
    suppliers = table(spark, sf_dir, "supplier")
    joined = (
        suppliers
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            "s_suppkey",
            F.col("s_name").alias("merchant_name"),
            F.col("n_name").alias("merchant_city"),
            F.col("r_name").alias("merchant_state"),
        )
    )
    return F.broadcast(joined) if suppliers.count() <= MAX_BROADCAST_MERCHANTS else joined


def _select(df: DataFrame, mapped: dict[str, Column], wanted: list[str]) -> DataFrame:
    amount = mapped.pop("x").cast("decimal(12,2)")
    mapped |= {
        "use_chip": F.lit("Chip Transaction"),
        "zip": F.lit("00000"),
        "mcc": F.lit(5411),
        "transaction_date": mapped["ds"],
        "amount_usd": amount,
        "amount_vnd": to_vnd(amount, F.lit(RATE)),
    }
    return df.select(*[(mapped.get(c, F.col(c))).alias(c) for c in wanted])


def transactions_from_lineitem(
    spark: SparkSession, sf_dir: str, columns: Iterable[str] = COLUMNS
) -> DataFrame:
    wanted = [c for c in COLUMNS if c in set(columns)]
    df = table(spark, sf_dir, "lineitem")
    if "user_id" in wanted:
        # Orders grow with the facts, so they are never worth broadcasting; the
        # shuffle also spreads facts that were stored as a single row group. Tasks are
        # as many as the facts fill, so that what one sorts does not grow with them.
        n = partitions(df, None)
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
        orders = orders.repartition(n, "o_orderkey").hint("merge")
        df = df.repartition(n, "l_orderkey").join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    if MERCHANT_COLUMNS & set(wanted):
        df = df.join(merchants(spark, sf_dir), F.col("l_suppkey") == F.col("s_suppkey"), "left")
    hour = (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 24
    return _select(
        df,
        {
            "user_id": F.col("o_custkey") if "user_id" in wanted else F.lit(None),
            "card_id": F.col("l_linenumber"),
            "time": F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":00:00")),
            "x": F.col("l_extendedprice"),
            "has_errors": F.when(F.col("l_returnflag") == "R", "Bad PIN").otherwise(""),
            "is_fraud": F.when(F.col("l_orderkey") % 37 == 0, "Yes").otherwise("No"),
            "ds": F.col("l_shipdate").cast("date"),
        },
        wanted,
    )


def with_merchant_of_event(spark: SparkSession, sf_dir: str, events: DataFrame) -> DataFrame:
    """Events have no merchant; the suppliers are dealt out by event number."""
    suppliers = table(spark, sf_dir, "supplier").agg(F.count("*")).scalar()
    return events.withColumn("supplier_key", F.col("event_id") % suppliers).join(
        merchants(spark, sf_dir), F.col("supplier_key") == F.col("s_suppkey"), "left"
    )


def transactions_from_events(
    spark: SparkSession, sf_dir: str, columns: Iterable[str] = COLUMNS
) -> DataFrame:
    wanted = [c for c in COLUMNS if c in set(columns)]
    df = table(spark, sf_dir, "events")
    if MERCHANT_COLUMNS & set(wanted):
        df = with_merchant_of_event(spark, sf_dir, df)
    return _select(
        df,
        {
            "user_id": F.col("user_id").cast("int"),
            "card_id": (F.col("user_id") % 3).cast("int"),
            "time": F.date_format("ts", "HH:mm:ss"),
            "x": F.col("value"),
            "has_errors": F.when(F.col("event_type") == "error", "Technical Glitch").otherwise(""),
            "is_fraud": F.when(F.col("event_id") % 37 == 0, "Yes").otherwise("No"),
            "ds": F.col("ts").cast("date"),
        },
        wanted,
    )


def raw_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events mapping as raw transactions, with ``event_id`` and ``ts``."""
    df = with_merchant_of_event(spark, sf_dir, table(spark, sf_dir, "events"))
    return df.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("user_id").cast("string").alias("User"),
        (F.col("user_id") % 3).cast("string").alias("Card"),
        F.year("ts").cast("string").alias("Year"),
        F.month("ts").cast("string").alias("Month"),
        F.dayofmonth("ts").cast("string").alias("Day"),
        F.date_format("ts", "HH:mm").alias("Time"),
        F.concat(F.lit("$"), F.col("value").cast("decimal(12,2)").cast("string")).alias("Amount"),
        F.lit("Chip Transaction").alias("Use Chip"),
        F.col("merchant_name").alias("Merchant Name"),
        F.col("merchant_city").alias("Merchant City"),
        F.col("merchant_state").alias("Merchant State"),
        F.lit("00000").alias("Zip"),
        F.lit("5411").alias("MCC"),
        F.when(F.col("event_type") == "error", "Technical Glitch").otherwise("").alias("Errors?"),
        F.when(F.col("event_id") % 37 == 0, "Yes").otherwise("No").alias("Is Fraud?"),
    )


def noon_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rate for each day of ``events``, in force from noon."""
    days = table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("d")).distinct()
    return days.select(
        F.expr("CAST(d AS TIMESTAMP) + INTERVAL 12 HOURS").alias("effective_from"),
        F.lit("USD").alias("currency"),
        (F.lit(25000) + F.dayofmonth("d") * 10).cast("decimal(18,4)").alias("vnd_per_usd"),
    )


def constant_rate(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(
        F.lit("2000-01-01").cast("timestamp").alias("effective_from"),
        F.lit("USD").alias("currency"),
        F.lit(RATE).cast("decimal(18,4)").alias("vnd_per_usd"),
    )
