"""Currency conversion by the rate in force when a record was taken in (C9, ST4).

Looking rates up by ingest time, not by the clock, makes a replayed batch give
the same amounts. Each rate holds until the next one, so this is an as-of join.
It is expressed as an equi-join: rates in order of time are cut into buckets of the same number of
rates, and a bucket is one row with its times and rates as arrays. A record finds its bucket by binary search
among the bounds, meets that one row, and finds its rate by binary search in it. So
a record compares with about as many times as the number of rates has binary digits, whether rates are
spread evenly or come in a burst after years of silence.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import to_vnd
from ledgerloom.session import scratch_dir

CURRENCY = "USD"
#: At most so many buckets, whose bounds are part of the plan; and at least so many rates in each.
MAX_BUCKETS = 50_000
LEAST_DEPTH = 64
#: Above this many rates they are shuffled instead of broadcast, and ordered by range.
MAX_BROADCAST_RATES = 100_000
#: About the most rates that salted copies may add up to.
MAX_SALTED_RATES = 20_000_000


def at_or_before(times: Column, time: Column, most: int) -> Column:
    """How many of the ascending ``times``, an array of at most ``most``, are at or before ``time``:
    binary search, a step for each binary digit."""
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(max(most, 1).bit_length()))))
    return F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(F.get(times, at + step - 1) <= time, at + step).otherwise(at),
    )


@dataclass(frozen=True)
class Buckets:
    """Slices of time that hold ``depth`` rates each, the last one perhaps fewer. ``bounds_us`` are
    the times at which buckets begin, the first one left out."""

    rates: int
    depth: int
    bounds_us: tuple[int, ...]

    @classmethod
    def over(cls, rates: DataFrame) -> "Buckets | None":
        n = rates.count()
        if n == 0:
            return None
        depth = max(LEAST_DEPTH, -(-n // MAX_BUCKETS))
        return cls(n, depth, tuple(every(rates, n, depth)))

    @property
    def count(self) -> int:
        return len(self.bounds_us) + 1

    def of(self, time: Column) -> Column:
        """Times before the first rate go to the first bucket, where no rate is
        valid for them; times after the last rate go to the last bucket."""
        if not self.bounds_us:
            return F.lit(0)
        listed = F.expr(f"CAST(split('{','.join(map(str, self.bounds_us))}', ',') AS ARRAY<BIGINT>)")
        return at_or_before(listed, F.unix_micros(time), len(self.bounds_us))


def every(rates: DataFrame, n: int, depth: int) -> list[int]:
    """The times of the rates with ranks ``depth``, ``2 * depth``, ... counted from 0."""
    times = rates.select(F.unix_micros("effective_from").alias("us"))
    if n <= MAX_BROADCAST_RATES:
        return sorted(row.us for row in times.collect())[depth::depth]
    spark = rates.sparkSession
    path = scratch_dir(spark, "rate_times")
    times.repartitionByRange("us").withColumn("part", F.spark_partition_id()).write.parquet(path)
    ranges = spark.read.parquet(path)
    # one row a range, as many as the shuffle has partitions
    counts = sorted(tuple(row) for row in ranges.groupBy("part").count().collect())
    ahead, offsets = 0, []
    for part, size in counts:
        offsets.append((part, ahead))
        ahead += size
    rank = F.row_number().over(Window.partitionBy("part").orderBy("us")) - 1 + F.col("ahead")
    ranked = ranges.join(F.broadcast(spark.createDataFrame(offsets, "part int, ahead long")), "part")
    chosen = ranked.withColumn("rank", rank).where((F.col("rank") > 0) & (F.col("rank") % depth == 0))
    return sorted(row.us for row in chosen.select("us").collect())  # at most MAX_BUCKETS


def distinct_rates(fx: DataFrame) -> DataFrame:
    """One rate per instant; of two for the same instant the larger counts."""
    return (
        fx.where((F.col("currency") == CURRENCY) & F.col("vnd_per_usd").isNotNull())
        .where(F.col("effective_from").isNotNull())
        .groupBy("effective_from")
        .agg(F.max("vnd_per_usd").alias("vnd_per_usd"))
    )


def rates_by_bucket(rates: DataFrame, buckets: Buckets) -> DataFrame:
    """(rate_bucket, times, rates): a row for each bucket, its rates in order of time. An array has
    ``depth`` entries at most, which grows only beyond ``MAX_BUCKETS * LEAST_DEPTH`` rates."""
    entry = F.struct(F.unix_micros("effective_from").alias("us"), F.col("vnd_per_usd").alias("rate"))
    listed = rates.groupBy(buckets.of(F.col("effective_from")).alias("rate_bucket")).agg(
        F.sort_array(F.collect_list(entry)).alias("entries")
    )
    return listed.select("rate_bucket", F.col("entries.us").alias("times"), F.col("entries.rate").alias("rates"))


def with_rate(df: DataFrame, fx: DataFrame, time_column: str) -> DataFrame:
    """``df`` with ``vnd_per_usd`` as of ``time_column``; NULL before the first rate."""
    rates = distinct_rates(fx)
    buckets = Buckets.over(rates)
    if buckets is None:
        return df.withColumn("vnd_per_usd", F.lit(None).cast("decimal(18,4)"))
    lookup = rates_by_bucket(rates, buckets)
    records = df.withColumn("bucket", buckets.of(F.col(time_column)))
    same = F.col("bucket") == F.col("rate_bucket")
    if buckets.rates <= MAX_BROADCAST_RATES:
        # at most MAX_BROADCAST_RATES narrow entries
        lookup = F.broadcast(lookup)
    else:
        # A busy bucket is spread over the shuffle. The input split a record came from spreads even
        # equal records, and is the same when a task is run again. What copies of very many
        # rates would cost is left to adaptive execution, which splits the records' side too.
        width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        salts = max(1, min(width, MAX_SALTED_RATES // buckets.rates))
        records = records.withColumn("salt", F.spark_partition_id() % salts)
        lookup = lookup.withColumn("rate_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        same &= F.col("salt") == F.col("rate_salt")
    found = at_or_before(F.col("times"), F.unix_micros(time_column), buckets.depth)
    return records.join(lookup, same, "left").select(*df.columns, F.get("rates", found - 1).alias("vnd_per_usd"))


def with_one_rate(df: DataFrame, fx: DataFrame, time: Column) -> DataFrame:
    """``df`` with the rate in force at one instant: looked up once, nothing is joined."""
    at_or_before = distinct_rates(fx).where(F.col("effective_from") <= time)
    rate = at_or_before.agg(F.max_by("vnd_per_usd", "effective_from")).first()[0]
    return df.withColumn("vnd_per_usd", F.lit(rate).cast("decimal(18,4)"))


def with_amount_vnd(df: DataFrame, fx: DataFrame, time_column: str, time: Column | None = None) -> DataFrame:
    """``df`` with the rate and the converted amount. ``time`` is given where it is one and the
    same for all rows."""
    rated = with_rate(df, fx, time_column) if time is None else with_one_rate(df, fx, time)
    return rated.withColumn("amount_vnd", to_vnd(F.col("amount_usd"), F.col("vnd_per_usd")))
