"""Raw transactions to typed, converted records (C1-C10) with refusals kept."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import complete_time, parse_date, parse_int, parse_money
from ledgerloom.operators.fx import with_amount_vnd
from ledgerloom.schema import CLEAN, RAW, RAW_FIELDS, REJECTED

MALFORMED = "malformed_text"

# Where a record ends up, and why it was refused.
ACCEPTED, REFUSED = "clean", "rejected"
MALFORMED_MESSAGE = "malformed_message"
NO_DATE = "no_date"
NO_RATE = "no_rate"
OUT_OF_RANGE = "amount_out_of_range"
NOT_A_NUMBER = "amount_not_a_number"

AMOUNT_PROBLEM = "amount_problem"


def parse_messages(messages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(value, timestamp)`` messages to raw fields.

    Keeps the text and the ingest time (and the columns ``keep``), and marks messages that are not JSON.
    """
    schema = T.StructType([*RAW.fields, T.StructField(MALFORMED, T.StringType())])
    text = F.col("value").cast("string")
    parsed = F.from_json(text, schema, {"columnNameOfCorruptRecord": MALFORMED})
    return messages.select(
        text.alias("raw_value"),
        F.col("timestamp").alias("ingest_time"),
        parsed.alias("data"),
        *keep,
    ).select("raw_value", "ingest_time", "data.*", *keep)


def raw_records(rows: DataFrame, ingest_time=None) -> DataFrame:
    """Raw rows (say, from CSV) in the form ``parse_messages`` gives.

    A column ``malformed_text`` marks rows whose fields could not be told apart.
    """
    marked, text = MALFORMED in rows.columns, F.to_json(F.struct(*RAW_FIELDS))
    return rows.select(
        (F.coalesce(MALFORMED, text) if marked else text).alias("raw_value"),
        (F.current_timestamp() if ingest_time is None else ingest_time).alias("ingest_time"),
        *RAW_FIELDS,
        (F.col(MALFORMED) if marked else F.lit(None).cast("string")).alias(MALFORMED),
    )


def type_records(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Names, types, date, time and partition day in one projection."""
    transaction_date = parse_date(*[parse_int(F.col(part)) for part in ("Day", "Month", "Year")])
    amount = parse_money(F.col("Amount"))
    amount_usd = amount.try_cast(CLEAN["amount_usd"].dataType)
    problem = F.when((F.trim("Amount") != "") & amount.isNull(), NOT_A_NUMBER).when(
        amount.isNotNull() & amount_usd.isNull(), OUT_OF_RANGE
    )
    return raw.select(
        parse_int(F.col("User")).alias("user_id"),
        parse_int(F.col("Card")).alias("card_id"),
        complete_time(F.col("Time")).alias("time"),
        amount_usd.alias("amount_usd"),
        F.col("Use Chip").alias("use_chip"),
        F.col("Merchant Name").alias("merchant_name"),
        F.col("Merchant City").alias("merchant_city"),
        F.col("Merchant State").alias("merchant_state"),
        F.col("Zip").alias("zip"),
        parse_int(F.col("MCC")).alias("mcc"),
        F.col("`Errors?`").alias("has_errors"),
        F.col("`Is Fraud?`").alias("is_fraud"),
        transaction_date.alias("transaction_date"),
        F.current_timestamp().alias("processed_at"),
        transaction_date.alias("ds"),
        "raw_value",
        "ingest_time",
        MALFORMED,
        problem.alias(AMOUNT_PROBLEM),
        *keep,
    )


def refuse(converted: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every record with its ``outcome``; the text is kept only where refused."""
    reason = (
        F.when(F.col(MALFORMED).isNotNull(), MALFORMED_MESSAGE)
        .when(F.col("ds").isNull(), NO_DATE)
        .when(F.col(AMOUNT_PROBLEM).isNotNull(), F.col(AMOUNT_PROBLEM))
        .when(F.col("amount_usd").isNotNull() & F.col("vnd_per_usd").isNull(), NO_RATE)
        .when(F.col("amount_usd").isNotNull() & F.col("amount_vnd").isNull(), OUT_OF_RANGE)
    )
    refused = F.col("reject_reason").isNotNull()
    return converted.withColumn("reject_reason", reason).select(
        *CLEAN.fieldNames(),
        "reject_reason",
        F.when(refused, F.col("raw_value")).alias("raw_value"),
        "ingest_time",
        F.when(refused, REFUSED).otherwise(ACCEPTED).alias("outcome"),
        *keep,
    )


def clean_raw(raw: DataFrame, rates: DataFrame, time: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """All of the cleaning: raw records to records with an outcome. ``time`` is the ingest time
    where all records have the same; ``keep`` are columns that go through as they are."""
    return refuse(with_amount_vnd(type_records(raw, keep), rates, "ingest_time", time), keep)


def accepted(records: DataFrame) -> DataFrame:
    return records.where(F.col("outcome") == ACCEPTED).select(*CLEAN.fieldNames())


def rejected(records: DataFrame) -> DataFrame:
    return records.where(F.col("outcome") == REFUSED).select(*REJECTED.fieldNames())
