"""Rollups of the whole history, kept by day and brought up to date.

Past days do not change unless a batch touches them. So the rollups that cover all of history
are stored partitioned by ``ds``, together with a table of the attempts to store batches that each day was
made from; a run computes the days whose attempts are others now, and nothing else. Both sides of that
comparison are tables, read and joined by executors: the driver learns the days to compute and no more. Packing
the files of a day anew changes no attempt, so compacted days stay as they are.

Reports of the latest day, month and year are made of states of single days too:

* counts, sums and largest amounts by hour, by place and by user, which add up;
* the customers of each place as sets, whose union is counted (``operators/distinct.py``);
* how many amounts lie in each slice of the value range, from which the slice with the high-value limit is found;
* the amounts above the lowest that the limit may be (``TAIL_SHARE``), counted by value: they give the exact limit and
  the report of what lies above. Should the limit ever fall below what is kept, they are counted anew.

So a daily run reads the days that were touched since the last one, and no others.
"""

from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.distinct import distinct_counts, value_sets
from ledgerloom.operators.grains import LatestBounds
from ledgerloom.operators.quantile import Slice, logarithmic, slice_at, value_in
from ledgerloom.plans.catalog import REPORTS
from ledgerloom.plans.reports import HIGH_VALUE_SHARE, aggregates, finish, is_high_value, with_derived_keys
from ledgerloom.plans.shared import FREQUENT, ROLLUPS, roll_up
from ledgerloom.schema import CLEAN, UNDATED
from ledgerloom.sinks import paths
from ledgerloom.sinks.manifests import read_manifests
from ledgerloom.sources.files import read_clean

KEPT = ("by_user_day", "by_merchant_day", "by_day_type", FREQUENT)
STATE = "_attempts"

PLACE = ROLLUPS["latest_by_merchant"].keys
CUSTOMERS = "customers"
#: Rollups of the latest grains, by the day states that they are merged from.
MERGED = {"hour_by_day": "latest_by_hour", "place_by_day": "latest_by_merchant", "flags_by_user_day": "latest_by_user"}
SETS, SLICES, TAIL = "customer_sets_by_day", "amount_slices_by_day", "tail_by_day"
DAY_STATES = (*MERGED, SETS, SLICES)
#: Amounts from this share of all rows on are kept by value.
TAIL_SHARE = 0.9
#: States that are made at a time.
PARALLEL = 4
TAIL_KEYS = ROLLUPS["latest_high_value"].keys


def attempts_by_day(spark: SparkSession, lake: str) -> DataFrame:
    """(ds, batch, attempt) of clean rows. One that was broken off is another one than the same finished."""
    lines = read_manifests(spark, lake).where(F.col("outcome") == "clean").where(F.col("ds") != UNDATED)
    return lines.select("ds", "batch", F.concat_ws(" ", "attempt", "state").alias("attempt")).distinct()


def day_state(name: str, rows: DataFrame) -> DataFrame:
    """What is kept of each day in one of the rollups or states."""
    if name == FREQUENT:
        return frequent_days(rows)
    if name in KEPT:
        return roll_up(rows, ROLLUPS[name], None, (), None)
    if name == SETS:
        return value_sets(rows, ("ds", *PLACE), "user_id")
    if name == SLICES:
        amounts = rows.where(F.col("amount_vnd").isNotNull()).groupBy("ds", logarithmic(F.col("amount_vnd")).alias("slice"))
        return amounts.agg(F.count("*").alias("n"), F.min("amount_vnd").alias("low"), F.max("amount_vnd").alias("high"))
    rollup = ROLLUPS[MERGED[name]]
    rows = with_derived_keys(rows.where(rollup.where) if rollup.where else rows, rollup.keys)
    return rows.groupBy("ds", *rollup.keys).agg(*aggregates(added_up(name)))


def added_up(name: str) -> dict[str, str]:
    """The measures of a merged rollup but for distinct counts."""
    return {m: sql for m, sql in ROLLUPS[MERGED[name]].measures.items() if m != CUSTOMERS}


def tail(rows: DataFrame, bound: int) -> DataFrame:
    rows = with_derived_keys(rows.where(F.col("amount_vnd") >= bound), TAIL_KEYS)
    return rows.groupBy("ds", *TAIL_KEYS, "amount_vnd").agg(F.count("*").alias("n"))


def changed_days(now: DataFrame, known: DataFrame) -> tuple[list[str], list[str]]:
    """Days with an attempt on one side only: those to compute, and those that are there no more."""
    keys = ["ds", "batch", "attempt"]
    both = now.withColumn("here", F.lit(True)).join(known.withColumn("there", F.lit(True)), keys, "full")
    days = both.groupBy("ds").agg(
        F.count("here").alias("here"), F.count_if(F.col("here").isNull() | F.col("there").isNull()).alias("changed")
    )
    rows = days.where("changed > 0").select("ds", "here").collect()  # one row a touched day
    return sorted(r.ds for r in rows if r.here), sorted(r.ds for r in rows if not r.here)


def frequent_days(rows: DataFrame) -> DataFrame:
    """The first step of the report on repeated purchases, which is by day too."""
    spec = REPORTS[FREQUENT]
    rows = with_derived_keys(rows, spec.first_keys)
    return rows.groupBy(*spec.first_keys).agg(*aggregates(spec.first_measures)).where(spec.having)


def update_history(spark: SparkSession, lake: str, store: str) -> list[date]:
    """Bring the rollups below ``store`` up to date with a lake; gives the days computed.

    The state is written last, so a run that breaks off is made up for by the next; it is taken before
    rows are read, so a batch that comes meanwhile is seen by the next. Days without rows any more
    are removed.
    """
    state, new = f"{store}/{STATE}", f"{store}/{STATE}_new"
    attempts_by_day(spark, lake).write.mode("overwrite").parquet(new)
    now = spark.read.parquet(new)
    known = spark.read.parquet(state) if paths.exists(spark, state) else now.limit(0)
    touched, gone = changed_days(now, known)
    days = [date.fromisoformat(day) for day in touched]

    @inheritable_thread_target(spark)
    def keep(name: str) -> None:
        if touched:
            rows = read_clean(spark, lake).where(F.col("ds").isin(days))
            keep_days(spark, day_state(name, rows), f"{store}/{name}", touched)
        forget_days(spark, f"{store}/{name}", gone)

    with ThreadPoolExecutor(max_workers=PARALLEL) as pool:
        list(pool.map(keep, (*KEPT, *DAY_STATES)))  # a failure is raised when the others have ended
    if touched or gone:
        update_tail(spark, lake, store, touched, gone)
    if touched or gone:
        paths.delete(spark, state)
        paths.rename(spark, new, state)
    else:
        paths.delete(spark, new)
    return days


def keep_days(spark: SparkSession, made: DataFrame, path: str, days: list[str]) -> None:
    forget_days(spark, path, days)  # a day may have no row left
    made.hint("rebalance", F.col("ds")).write.mode("append").partitionBy("ds").parquet(path)


def forget_days(spark: SparkSession, path: str, days: list[str]) -> None:
    for day in days if days and paths.exists(spark, path) else ():
        paths.delete(spark, f"{path}/ds={day}")


def stored_state(spark: SparkSession, store: str, name: str) -> DataFrame:
    """A kept state as it is stored; empty if nothing was ever written."""
    empty = spark.createDataFrame([], CLEAN)
    schema = (tail(empty, 0) if name == TAIL else day_state(name, empty)).schema
    path = f"{store}/{name}"
    return spark.read.schema(schema).parquet(path) if paths.exists(spark, path) else spark.createDataFrame([], schema)


def limit_slice(spark: SparkSession, store: str, share: float) -> Slice | None:
    """The slice of amounts that holds a quantile over all of history."""
    merged = stored_state(spark, store, SLICES).groupBy("slice").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    return slice_at(sorted(merged.collect(), key=lambda row: row.slice), share)  # as many as there are slices


def update_tail(spark: SparkSession, lake: str, store: str, touched: list[str], gone: list[str]) -> None:
    path, kept = f"{store}/{TAIL}", f"{store}/_tail_bound"
    found = limit_slice(spark, store, HIGH_VALUE_SHARE)
    bound = paths.read_text(spark, kept)
    if found is None:
        paths.delete(spark, path)
        paths.delete(spark, kept)
    elif bound is None or found.low < int(bound):
        # the bound is written when all days are there
        paths.delete(spark, kept)
        paths.delete(spark, path)
        lowest = limit_slice(spark, store, TAIL_SHARE).low
        keep_days(spark, tail(read_clean(spark, lake), lowest), path, [])
        paths.write_text(spark, kept, str(lowest))
    else:
        forget_days(spark, path, gone)
        rows = read_clean(spark, lake).where(F.col("ds").isin([date.fromisoformat(day) for day in touched]))
        keep_days(spark, tail(rows, int(bound)), path, touched)


def kept_threshold(spark: SparkSession, store: str) -> int | None:
    """The exact high-value limit over all of history, from what is kept."""
    found = limit_slice(spark, store, HIGH_VALUE_SHARE)
    if found is None or found.low == found.high:
        return found and found.low
    inside = stored_state(spark, store, TAIL).where(F.col("amount_vnd").between(found.low, found.high))
    return value_in(inside.groupBy(F.col("amount_vnd").alias("v")).agg(F.sum("n").alias("n")), found)


def by_grain(state: DataFrame, bounds: LatestBounds) -> DataFrame:
    """Days of the latest year, once for each grain they belong to."""
    return state.where(bounds.contains("year")).withColumn("grain", F.explode(bounds.grains_of_row())).drop("ds")


def merge_days(name: str, state: DataFrame, bounds: LatestBounds) -> DataFrame:
    """A rollup of the latest grains out of the states of its days."""
    keys = ("grain", *ROLLUPS[MERGED[name]].keys)
    merged = [(F.max(m) if sql.startswith("max") else F.sum(m)).alias(m) for m, sql in added_up(name).items()]
    return by_grain(state, bounds).groupBy(*keys).agg(*merged)


def merged_rollups(spark: SparkSession, store: str, bounds: LatestBounds) -> dict[str, DataFrame]:
    """The rollups of the latest day, month and year, as ``build_reports`` would have made them."""
    made = {ROLLUPS[MERGED[name]].name: merge_days(name, stored_state(spark, store, name), bounds) for name in MERGED}
    keys = ("grain", *PLACE)
    customers = distinct_counts(by_grain(stored_state(spark, store, SETS), bounds), keys, CUSTOMERS)
    customers = customers.select(*(F.col(k).alias(f"_{k}") for k in keys), CUSTOMERS)
    places = made["latest_by_merchant"]
    together = places.join(customers, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left")
    made["latest_by_merchant"] = together.select(*places.columns, F.coalesce(CUSTOMERS, F.lit(0)).alias(CUSTOMERS))
    high = by_grain(stored_state(spark, store, TAIL).where(is_high_value(kept_threshold(spark, store))), bounds)
    made["latest_high_value"] = high.groupBy("grain", *TAIL_KEYS).agg(F.sum("n").alias("n"), F.max("amount_vnd").alias("largest"))
    return made


def kept_rollup(spark: SparkSession, store: str, name: str) -> DataFrame:
    """A stored rollup, as ``build_reports`` would have made it."""
    rows = stored_state(spark, store, name)
    if name != FREQUENT:
        return rows
    spec = REPORTS[FREQUENT]
    return finish(rows.groupBy(*spec.keys).agg(*aggregates(spec.measures)), spec, sort=False)


def kept_rollups(spark: SparkSession, store: str, scratch: str, bounds: LatestBounds) -> dict[str, DataFrame]:
    """Everything that ``build_reports`` reads, out of what is kept. Merged rollups are stored below
    ``scratch``, as several reports read each."""
    kept = {name: kept_rollup(spark, store, name) for name in KEPT}
    merged = merged_rollups(spark, store, bounds)

    @inheritable_thread_target(spark)
    def write(name: str) -> None:
        merged[name].write.mode("overwrite").parquet(f"{scratch}/{name}")

    with ThreadPoolExecutor(max_workers=PARALLEL) as pool:
        list(pool.map(write, merged))
    return kept | {name: spark.read.parquet(f"{scratch}/{name}") for name in merged}
