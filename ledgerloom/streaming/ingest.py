"""Streaming ingest (ST1-ST5): messages to the lake, one batch at a time."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.operators.clean import clean_raw, parse_messages
from ledgerloom.sinks.lake import write_lake


def store_batch(messages: DataFrame, rates: DataFrame, lake: str, batch: str) -> None:
    """Clean, convert and store one batch of messages; nothing if it is empty, which shows when it
    is written. Rates may have come since a first, uncommitted attempt; then records change sides."""
    write_lake(clean_raw(parse_messages(messages), rates), lake, batch)


def ingest_stream(
    messages: DataFrame,
    load_rates: Callable[[SparkSession], DataFrame],
    lake: str,
    checkpoint: str,
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start the ingest query; by default a batch starts when the last is done.

    ``load_rates`` is called for each batch, so new rates are seen. The batch key
    joins the query's lasting id with the batch number: a batch run again after
    a failure overwrites itself and never another query's. A new checkpoint is a
    new query, so reading a topic from its start again needs an empty lake.
    """

    def process(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        store_batch(batch, load_rates(spark), lake, f"{query_id}-{number}")

    writer = messages.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
