"""Table layouts shared by ingest, reports and publishing."""

from pyspark.sql import types as T

# The field names of a raw transaction, as they arrive in CSV or JSON.
RAW_FIELDS = (
    "User",
    "Card",
    "Year",
    "Month",
    "Day",
    "Time",
    "Amount",
    "Use Chip",
    "Merchant Name",
    "Merchant City",
    "Merchant State",
    "Zip",
    "MCC",
    "Errors?",
    "Is Fraud?",
)

RAW = T.StructType([T.StructField(name, T.StringType()) for name in RAW_FIELDS])

#: One message as a broker delivers it; ``timestamp`` is when the broker took it in.
MESSAGE = T.StructType(
    [
        T.StructField("value", T.BinaryType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

#: Fixed value: how a partition of NULL is named.
UNDATED = "__HIVE_DEFAULT_PARTITION__"

#: Money is decimal and the converted amount bigint: float32 loses cents and
#: int32 overflows at about 84,600 USD.
CLEAN = T.StructType(
    [
        T.StructField("user_id", T.IntegerType()),
        T.StructField("card_id", T.IntegerType()),
        T.StructField("time", T.StringType()),
        T.StructField("amount_usd", T.DecimalType(12, 2)),
        T.StructField("use_chip", T.StringType()),
        T.StructField("merchant_name", T.StringType()),
        T.StructField("merchant_city", T.StringType()),
        T.StructField("merchant_state", T.StringType()),
        T.StructField("zip", T.StringType()),
        T.StructField("mcc", T.IntegerType()),
        T.StructField("has_errors", T.StringType()),
        T.StructField("is_fraud", T.StringType()),
        T.StructField("transaction_date", T.DateType()),
        T.StructField("amount_vnd", T.LongType()),
        T.StructField("processed_at", T.TimestampType()),
        T.StructField("ds", T.DateType()),
    ]
)

FX = T.StructType(
    [
        T.StructField("effective_from", T.TimestampType()),
        T.StructField("currency", T.StringType()),
        T.StructField("vnd_per_usd", T.DecimalType(18, 4)),
    ]
)

#: What a refused record keeps: why, what arrived, and when.
REJECTED = T.StructType(
    [
        T.StructField("reject_reason", T.StringType()),
        T.StructField("raw_value", T.StringType()),
        T.StructField("ingest_time", T.TimestampType()),
        T.StructField("processed_at", T.TimestampType()),
    ]
)

#: All that a lake file holds: a record with what it was refused for, and the attempt that stored it.
LAKE = T.StructType(
    [
        *(field for field in CLEAN if field.name != "ds"),
        *(field for field in REJECTED if field.name != "processed_at"),
        T.StructField("attempt", T.StringType()),
    ]
)
