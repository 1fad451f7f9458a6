"""Intermediate tables in the folder that the whole cluster shares."""

from pyspark.sql import DataFrame

from ledgerloom.session import scratch_dir


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written as Parquet below ``spark.checkpoint.dir`` and read back.

    Cuts the lineage, so a lost executor costs a read and not a recomputation, and
    what was random or drawn from a sample (range bounds) is fixed from here on.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
