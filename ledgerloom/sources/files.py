"""Stored tables and files."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.clean import ACCEPTED, MALFORMED, REFUSED
from ledgerloom.schema import CLEAN, RAW_FIELDS, REJECTED
from ledgerloom.sinks import generations
from ledgerloom.sinks.paths import exists


def _read_outcome(
    spark: SparkSession, lake: str, outcome: str, schema: T.StructType
) -> DataFrame:
    path = f"{lake}/outcome={outcome}"
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    stored = T.StructType([*schema.fields, T.StructField("batch", T.StringType())])
    if "ds" not in schema.fieldNames():
        stored = stored.add("ds", T.DateType())
    # what counts is looked up before files are listed: a rewriting that commits in between is not seen
    # yet, and the old files are there
    known = generations.committed(spark, lake)
    rows = spark.read.schema(stored).parquet(path)
    if generations.last_started(spark, lake):
        rows = rows.where(generations.counting(known, outcome))
    return rows.select(*schema.fieldNames())


def read_clean(spark: SparkSession, lake: str) -> DataFrame:
    """The clean transactions of a lake, partitioned by ``ds``.

    The schema is declared, so no footer is read for it and ``ds`` is a date.
    """
    return _read_outcome(spark, lake, ACCEPTED, CLEAN)


def read_rejected(spark: SparkSession, lake: str) -> DataFrame:
    return _read_outcome(spark, lake, REFUSED, REJECTED)


def read_transactions_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw transactions from CSV with a header, columns found by its names.

    All files must have the same header: one that differs fails the job rather than
    being read by position. An empty field is the empty string, as in a message,
    not NULL. A row with too many or too few fields has its text in the column
    ``malformed_text``, which is NULL otherwise.
    """
    options = {"header": True, "escape": '"'}
    names = spark.read.options(**options).csv(path).columns
    fields = [T.StructField(name, T.StringType()) for name in (*names, MALFORMED)]
    reader = spark.read.options(
        **options, enforceSchema=False, columnNameOfCorruptRecord=MALFORMED, columnPruning=False
    )
    rows = reader.schema(T.StructType(fields)).csv(path)
    return rows.select(*[F.coalesce(F.col(f"`{n}`"), F.lit("")).alias(n) for n in RAW_FIELDS], MALFORMED)


def read_report_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """S3: a stored or published report; all text unless a schema is given."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader).csv(path)


def read_rates_json(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """Rates out of documents ``{"date": ..., "usd": {"vnd": ...}}``.

    One document per line, or with ``whole_files`` one per file over many lines.
    """
    documents = spark.read.schema("date DATE, usd STRUCT<vnd: DECIMAL(18,4)>").json(
        path, multiLine=whole_files
    )
    return documents.where("date IS NOT NULL AND usd.vnd IS NOT NULL").select(
        F.col("date").cast("timestamp").alias("effective_from"),
        F.lit("USD").alias("currency"),
        F.col("usd.vnd").alias("vnd_per_usd"),
    )


def count_rows(df: DataFrame) -> DataFrame:
    """The row count as a one-row frame."""
    return df.agg(F.count("*").alias("row_count"))
