"""Repeated rows as one row with a count, and back.

Operators that number rows have to tell equal rows apart, and nothing in a table does: row
numbers by partition change when a partition is computed again elsewhere. So equal rows are
counted first (which also takes care of a row that makes up a third of a table), the counted
rows are placed, and the places are handed out at the end.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType
from .names import fresh

#: Copies that one generator step writes before steps are dealt out over tasks.
STEP = 10_000


def row_hash(docs: DataFrame) -> Column:
    """A hash of all columns; ids and hash together name a row's content."""
    columns = []
    for field in docs.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, MapType):
            column = F.array_sort(F.map_entries(column))
        columns += [column, column.isNull()]  # a hash skips nulls
    return F.xxhash64(*columns)


def row_key(docs: DataFrame, id_column: str) -> Column:
    """Id and content hash as one value to group and join by; a null id equals a null id."""
    return F.struct(F.col(id_column).alias("id"), row_hash(docs).alias("hash"))


def numbered_copies(df: DataFrame, count: str, into: str, largest: int) -> DataFrame:
    """Each row ``count`` times, numbered from 0 in ``into``; none for a count of 0. ``largest`` is
    the largest count: over ``STEP`` the copies of a row are written by several tasks."""
    df = df.where(F.col(count) > 0)
    if largest <= STEP:
        return df.withColumn(into, F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1)))
    starts = F.sequence(F.lit(0).cast("long"), F.col(count) - 1, F.lit(STEP).cast("long"))
    start = fresh(df, "_from")
    steps = df.withColumn(start, F.explode(starts)).repartition(start, count)
    last = F.least(F.col(start) + STEP, F.col(count)) - 1
    return steps.withColumn(into, F.explode(F.sequence(F.col(start), last))).drop(start)


def cell_bits(df: DataFrame) -> int:
    """Leading hash bits that name a cell: four to eight cells for each shuffle partition."""
    return (4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))).bit_length()


def same(left: DataFrame, right: DataFrame, *keys: str, how: str = "inner") -> DataFrame:
    """A join on equal keys, null being equal to null; the keys of ``left`` are kept."""
    there = right.select(*(F.col(k).alias(f"_{k}") if k in keys else F.col(k) for k in right.columns))
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return left.join(there, on, how).drop(*(f"_{k}" for k in keys))
