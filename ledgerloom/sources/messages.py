"""Message streams in and out (S1, S5). The broker is one format among others.

Whatever the format, a message is ``(value BINARY, timestamp)`` with the time it
was taken in, which decides the exchange rate:

* ``kafka``: the broker's own columns;
* ``text``: one message per line, taken in when its file was last written;
* ``parquet``: files holding the two columns, say an archived topic.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.clean import MALFORMED
from ledgerloom.schema import MESSAGE, RAW_FIELDS

FORMATS = ("kafka", "text", "parquet")


def kafka_options(
    servers: str,
    topic: str = "transactions",
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def _load(reader, fmt: str, path: str | None, options: dict[str, str] | None) -> DataFrame:
    if fmt not in FORMATS:
        raise ValueError(f"message format {fmt!r}, not one of {FORMATS}")
    reader = reader.format(fmt).options(**(options or {}))
    if fmt == "kafka":
        return reader.load().select("value", "timestamp")
    if fmt == "parquet":
        return reader.schema(MESSAGE).load(path)
    return reader.load(path).select(
        F.col("value").cast("binary").alias("value"),
        F.col("_metadata.file_modification_time").alias("timestamp"),
    )


def read_message_stream(
    spark: SparkSession, fmt: str, path: str | None = None, options: dict[str, str] | None = None
) -> DataFrame:
    return _load(spark.readStream, fmt, path, options)


def read_messages(
    spark: SparkSession, fmt: str, path: str | None = None, options: dict[str, str] | None = None
) -> DataFrame:
    """The same messages as a static frame, to fill in history."""
    return _load(spark.read, fmt, path, options)


def to_messages(rows: DataFrame) -> DataFrame:
    """One JSON value per raw row; a row that could not be read goes out as its text, to
    be refused where it is taken in."""
    value = F.to_json(F.struct(*RAW_FIELDS))
    if MALFORMED in rows.columns:
        value = F.coalesce(F.col(MALFORMED), value)
    return rows.select(value.alias("value"))


def write_messages(
    rows: DataFrame, fmt: str, path: str | None = None, options: dict[str, str] | None = None
) -> None:
    """Raw rows as JSON messages to a topic or to text files."""
    writer = to_messages(rows).write.format(fmt).options(**(options or {}))
    writer.mode("append").save(path) if path else writer.save()
