"""Exact distinct counts that can be merged (A6, A7): sets of whole numbers, kept by key and bucket.

A set is cut into buckets of 32,768 possible values, Spark's bitmap buckets. In each bucket a few values are
kept as a list of their positions and many as a bitmap, whatever is smaller, so a merchant with ten customers
takes some bytes a day and one with a hundred million takes a bit for each. The union of sets of many days
counts each value once, without looking at the rows again.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A bitmap has 4 KB, a position two bytes.
DENSE = 2048


def value_sets(rows: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """(keys, bucket, positions, bits): of each bucket either the positions or the bitmap is there. Values
    that are NULL are in no set. Values are made distinct first, so a hot key is spread over its buckets and
    values."""
    value = F.col(column).cast("bigint")
    places = rows.where(value.isNotNull()).select(
        *keys, F.bitmap_bucket_number(value).alias("bucket"), F.bitmap_bit_position(value).cast("smallint").alias("position")
    )
    # at most 32,768 positions in a list
    listed = places.distinct().groupBy(*keys, "bucket").agg(F.collect_list("position").alias("positions"))
    few = listed.where(F.size("positions") < DENSE).select(*keys, "bucket", "positions", F.lit(None).cast("binary").alias("bits"))
    many = listed.where(F.size("positions") >= DENSE).select(*keys, "bucket", F.explode("positions").alias("position"))
    bitmaps = many.groupBy(*keys, "bucket").agg(F.bitmap_construct_agg(F.col("position").cast("bigint")).alias("bits"))
    none = F.lit(None).cast("array<smallint>").alias("positions")
    return few.union(bitmaps.select(*keys, "bucket", none, "bits"))


def bit_is_set(bits: Column, position: Column) -> Column:
    """Whether a bitmap has a position; the lowest bit of a byte comes first."""
    byte = F.conv(F.hex(F.substring(bits, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, position.cast("int") % 8) == 1


def distinct_counts(sets: DataFrame, keys: Sequence[str], into: str) -> DataFrame:
    """(keys, ``into``): how many values the union of the sets of each key has."""
    place = [*keys, "bucket"]
    bitmaps = sets.where(F.col("bits").isNotNull()).groupBy(*place).agg(F.bitmap_or_agg("bits").alias("bits"))
    single = sets.where(F.col("bits").isNull()).select(*place, F.explode("positions").alias("position")).distinct()
    there = bitmaps.select(*(F.col(c).alias(f"_{c}") for c in place), "bits")
    met = single.join(there, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in place], "left")
    extra = met.where(F.col("bits").isNull() | ~bit_is_set(F.col("bits"), F.col("position")))
    counts = bitmaps.select(*keys, F.bitmap_count("bits").alias("n")).union(
        extra.groupBy(*keys).agg(F.count("*").alias("n"))
    )
    return counts.groupBy(*keys).agg(F.sum("n").alias(into))
