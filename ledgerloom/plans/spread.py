"""Aggregates with several distinct counts whose groups are nearly as many as the rows.

Spark would make a row for each distinct count, and hash them all where they are read, which saves nothing
when hardly two rows are equal: what a task holds then follows the size of its input. Here rows are shuffled
first, as they are, into as many partitions as they fill, so what a task holds stays the same however many rows
there are; the first row of each value is then told by sorting. The first shuffle is by group and counted value,
so a hot group is spread out.
"""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: About the rows of one task.
TASK_ROWS = 250_000

USER_DAY = ("ds", "user_id")
PLACES = ("merchant_name", "merchant_city")


def partitions(df: DataFrame, rows: int | None) -> int:
    """For ``rows`` of ``df``, which are counted unless given; the count need not be exact. At least two, as one
    partition would not be dealt out by key."""
    return max(2, -(-(df.count() if rows is None else rows) // TASK_ROWS))


def merge(measures: Iterable[str], least: Iterable[str] = ("smallest",), greatest: Iterable[str] = ("largest",)) -> list:
    """Measures of parts put together: the least, the greatest, or the sum."""
    by_name = {m: F.min for m in least} | {m: F.max for m in greatest}
    return [by_name.get(m, F.sum)(m).alias(m) for m in measures]


def user_days(df: DataFrame, measures: dict[str, str], rows: int | None = None) -> DataFrame:
    """(ds, user_id, measures, merchants, cities): rows of one user, day and place become one, then those
    of one user and day."""
    n = partitions(df, rows)
    place = [*USER_DAY, *PLACES]
    visits = df.repartition(n, *place).groupBy(*place).agg(*(F.expr(sql).alias(m) for m, sql in measures.items()))
    spread = visits.repartition(n, *USER_DAY)
    firsts = {f"first_{c}": is_first(*USER_DAY, c) & F.col(c).isNotNull() for c in PLACES}
    merchants, cities = (F.count_if(c) for c in firsts)
    return (
        spread.withColumns(firsts)
        .groupBy(*USER_DAY)
        .agg(*merge(measures), merchants.alias("merchants"), cities.alias("cities"))
    )


def is_first(*keys: str) -> Column:
    """True for one row of each group."""
    return F.row_number().over(Window.partitionBy(*keys).orderBy(keys[-1])) == 1


def day_totals(df: DataFrame, measures: dict[str, str], rows: int | None = None) -> DataFrame:
    """(ds, measures, users, merchants, cities). A transaction becomes two rows, one for its user and one for its
    merchant, that are sorted by day and value; the first of each value counts. Cities are few and
    come as a set: one state a day, that holds each place once."""
    value = ("ds", "user_id", "merchant_name")
    needed = [c for c in df.columns if c not in value]
    for_user = F.struct("user_id", F.lit(None).cast("string").alias("merchant_name"), F.lit(True).alias("whole"), *needed)
    for_merchant = F.struct(
        F.lit(None).cast(df.schema["user_id"].dataType).alias("user_id"), "merchant_name", F.lit(False).alias("whole"),
        *(F.lit(None).cast(df.schema[c].dataType).alias(c) for c in needed),
    )
    two = df.select("ds", F.explode(F.array(for_user, for_merchant)).alias("row")).select("ds", "row.*")
    # a merchant's row that has no merchant counts nowhere
    two = two.where(F.col("whole") | F.col("merchant_name").isNotNull())
    spread = two.repartition(2 * partitions(df, rows), *value)
    plain = [F.expr(f"{sql} FILTER (WHERE whole)").alias(m) for m, sql in measures.items()]
    return spread.withColumn("first", is_first(*value)).groupBy("ds").agg(
        *plain,
        F.count_if(F.col("first") & F.col("user_id").isNotNull()).alias("users"),
        F.count_if(F.col("first") & F.col("merchant_name").isNotNull()).alias("merchants"),
        F.size(F.collect_set("merchant_city")).cast("bigint").alias("cities"),
    )
