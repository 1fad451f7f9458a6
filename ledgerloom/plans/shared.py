"""All reports from a few rollups instead of one scan per report.

Every report of a grain family reads the same latest year, and many have equal
or nested keys. So the table is aggregated eight times, each result is stored in
the shared scratch folder, and the 35 datasets are derived from those:

* the latest year once per key set, a row being counted in each grain (day,
  month, year) it belongs to;
* the whole history once by user and day, once by merchant and day, once by day and
  day type, and once for repeated purchases within an hour.
"""

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.grains import GRAINS, LatestBounds
from ledgerloom.plans.catalog import DAY_MEASURES, ERROR, FRAUD, SPREAD, Dataset, select_datasets
from ledgerloom.plans.reports import (
    aggregates,
    finish,
    high_value_threshold,
    is_high_value,
    report,
    with_derived_keys,
)
from ledgerloom.plans.spread import user_days


@dataclass(frozen=True)
class Rollup:
    """Aggregate of the clean table that several reports are derived from."""

    name: str
    keys: tuple[str, ...]
    measures: dict[str, str]
    latest: bool = False
    where: str | None = None
    high_value: bool = False


@dataclass(frozen=True)
class Derived:
    """A report as a selection from a rollup, or a smaller aggregate of one."""

    rollup: str
    columns: dict[str, str] = field(default_factory=dict)
    where: str | None = None


BY_USER_DAY = "by_user_day"

ROLLUPS = {
    r.name: r
    for r in (
        Rollup(
            "latest_by_hour", ("hour",),
            {"n": "count(*)", "errors": f"count_if({ERROR})", "frauds": f"count_if({FRAUD})"},
            latest=True,
        ),
        Rollup(
            "latest_by_merchant", ("merchant_name", "merchant_city", "merchant_state"),
            {
                "n": "count(*)",
                "total": "sum(amount_vnd)",
                "amounts": "count(amount_vnd)",
                "largest": "max(amount_vnd)",
                "customers": "count(DISTINCT user_id)",
                "frauds": f"count_if({FRAUD})",
            },
            latest=True,
        ),
        Rollup(
            "latest_by_user", ("user_id",),
            {
                "errors": f"count_if({ERROR})",
                "error_total": f"sum(amount_vnd) FILTER (WHERE {ERROR})",
                "frauds": f"count_if({FRAUD})",
            },
            latest=True, where=f"{ERROR} OR {FRAUD}",
        ),
        Rollup(
            "latest_high_value", ("hour", "merchant_city", "merchant_name"),
            {"n": "count(*)", "largest": "max(amount_vnd)"},
            latest=True, high_value=True,
        ),
        Rollup(
            BY_USER_DAY, ("ds", "user_id"),
            {**DAY_MEASURES, "merchants": "count(DISTINCT merchant_name)", "cities": "count(DISTINCT merchant_city)"},
        ),
        Rollup(
            "by_merchant_day", ("ds", "merchant_name", "merchant_city"),
            {"n": "count(*)", "frauds": f"count_if({FRAUD})"},
        ),
        # a purchase may be stored under another day than its own
        Rollup(
            "by_day_type", ("ds", "day_type"),
            {"n": "count(*)", "total": "sum(amount_vnd)", "amounts": "count(amount_vnd)"},
        ),
    )
}

#: R6 shares nothing with the others, so its own result is stored.
FREQUENT = "user_frequent"

DERIVED = {
    "hourly_analysis": Derived("latest_by_hour", {"transaction_count": "n"}),
    "hourly_unusual_analysis": Derived(
        "latest_by_hour", {"error_transaction_count": "errors"}, where="errors > 0"
    ),
    "fraud_by_hour": Derived("latest_by_hour", {"fraud_count": "frauds"}, where="frauds > 0"),
    "city_analysis": Derived(
        "latest_by_merchant",
        {
            "transaction_count": "sum(n)",
            "total_amount_vnd": "sum(total)",
            "avg_amount_vnd": "try_divide(sum(total), sum(amounts))",
        },
    ),
    "merchant_analysis": Derived(
        "latest_by_merchant",
        {
            "transaction_count": "n",
            "total_amount_vnd": "total",
            "avg_amount_vnd": "try_divide(total, amounts)",
            "max_amount_vnd": "largest",
            "unique_customers": "customers",
        },
    ),
    "fraud_by_merchant": Derived(
        "latest_by_merchant", {"fraud_count": "sum(frauds)"}, where="frauds > 0"
    ),
    "fraud_by_city": Derived(
        "latest_by_merchant", {"fraud_count": "sum(frauds)"}, where="frauds > 0"
    ),
    "user_error_analysis": Derived(
        "latest_by_user",
        {"error_count": "errors", "total_error_amount_vnd": "error_total"},
        where="errors > 0",
    ),
    "user_fraud_analysis": Derived(
        "latest_by_user", {"fraud_count": "frauds"}, where="frauds > 0"
    ),
    "high_value_analysis": Derived(
        "latest_high_value", {"high_value_count": "n", "max_amount_vnd": "largest"}
    ),
    "user_analysis": Derived("by_user_day", SPREAD["user_analysis"]),
    "fraud_rate_by_merchant": Derived(
        "by_merchant_day",
        {"total_transactions": "sum(n)", "fraud_transactions": "sum(frauds)"},
    ),
}

#: Rollups that each report reads, the special ones included.
SOURCES = {name: (d.rollup,) for name, d in DERIVED.items()} | {
    "daily_summary": ("by_user_day", "by_merchant_day"),
    "weekday_vs_weekend": ("by_day_type",),
    FREQUENT: (FREQUENT,),
}


def build_reports(
    df: DataFrame,
    scratch: str,
    names: Iterable[str] | None = None,
    grains: Iterable[str] | None = None,
    threshold: int | str | None = "exact",
    parallel: int = 4,
    failures: dict[str, Exception] | None = None,
    bounds: LatestBounds | None = None,
    kept: dict[str, DataFrame] | None = None,
    row_count: int | None = None,
) -> dict[str, DataFrame]:
    """The chosen datasets by id, each reading rollups stored below ``scratch``.

    The rollups are written here, ``parallel`` at a time; the returned frames are
    lazy and need ``scratch`` until they have been written. With ``failures``, a rollup
    that fails is no error: its datasets are left out and noted there. ``kept`` are rollups
    that need not be computed. ``row_count`` is about how many rows ``df`` has.
    """
    spark, kept = df.sparkSession, kept or {}
    chosen = select_datasets(names, grains)
    wanted_grains = tuple(g for g in GRAINS if any(d.grain == g for d in chosen))
    needed = list(dict.fromkeys(s for d in chosen for s in SOURCES[d.report.name]))
    if wanted_grains and bounds is None:
        bounds = LatestBounds.of(df)

    failed: dict[str, Exception] = {}

    @inheritable_thread_target(spark)
    def attempt(name: str) -> None:
        try:
            store(name)
        except Exception as error:
            if failures is None:
                raise
            failed[name] = error

    def store(name: str) -> None:
        if name == FREQUENT:
            result = report(df, FREQUENT, sort=False)
        else:
            rollup, limit = ROLLUPS[name], threshold
            if rollup.high_value and isinstance(limit, str):
                limit = high_value_threshold(df, limit)
            result = roll_up(df, rollup, bounds, wanted_grains, limit, row_count)
        result.write.mode("overwrite").parquet(f"{scratch}/{name}")

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        list(pool.map(attempt, [n for n in needed if n not in kept]))
    rollups = {n: kept[n] if n in kept else spark.read.parquet(f"{scratch}/{n}") for n in needed if n not in failed}
    built = {}
    for d in chosen:
        missing = [s for s in SOURCES[d.report.name] if s in failed]
        if missing:
            failures[d.id] = failed[missing[0]]
        else:
            built[d.id] = derive(d, rollups)
    return built


def roll_up(
    df: DataFrame,
    rollup: Rollup,
    bounds: LatestBounds | None,
    grains: tuple[str, ...],
    threshold: int | None,
    row_count: int | None = None,
) -> DataFrame:
    if rollup.name == BY_USER_DAY:
        return user_days(df, DAY_MEASURES, row_count)
    rows, keys = df, rollup.keys
    if rollup.latest:
        # The last grain is the widest and contains the others.
        rows = rows.where(bounds.contains(grains[-1]))
    if rollup.where:
        rows = rows.where(rollup.where)
    if rollup.high_value:
        rows = rows.where(is_high_value(threshold))
    rows = with_derived_keys(rows, keys)
    if rollup.latest:
        rows = rows.withColumn("grain", F.explode(bounds.grains_of_row(grains)))
        keys = ("grain", *keys)
    return rows.groupBy(*keys).agg(*aggregates(rollup.measures))


def derive(dataset: Dataset, rollups: dict[str, DataFrame]) -> DataFrame:
    spec = dataset.report
    if spec.name == FREQUENT:
        return rollups[FREQUENT]
    if spec.name == "daily_summary":
        return daily_summary(rollups["by_user_day"], rollups["by_merchant_day"])
    if spec.name == "weekday_vs_weekend":
        return weekday_vs_weekend(rollups["by_day_type"])
    plan = DERIVED[spec.name]
    rows = rollups[plan.rollup]
    if dataset.grain:
        rows = rows.where(F.col("grain") == dataset.grain)
    if plan.where:
        rows = rows.where(plan.where)
    columns = aggregates(plan.columns)
    if spec.keys == ROLLUPS[plan.rollup].keys:
        rows = rows.select(*spec.keys, *columns)
    else:
        rows = rows.groupBy(*spec.keys).agg(*columns)
    return finish(rows, spec, sort=False)


def days(by_user_day: DataFrame) -> DataFrame:
    return by_user_day.groupBy("ds").agg(
        F.sum("n").alias("n"),
        F.sum("total").alias("total"),
        F.sum("amounts").alias("amounts"),
        F.count("user_id").alias("users"),
        F.sum("errors").alias("errors"),
        F.sum("frauds").alias("frauds"),
        F.max("largest").alias("largest"),
        F.min("smallest").alias("smallest"),
    )


def daily_summary(by_user_day: DataFrame, by_merchant_day: DataFrame) -> DataFrame:
    """Two one-row-per-day frames brought together; a NULL day matches itself."""
    places = by_merchant_day.groupBy(F.col("ds").alias("place_ds")).agg(
        F.count_distinct("merchant_name").alias("merchants"),
        F.count_distinct("merchant_city").alias("cities"),
    )
    return (
        days(by_user_day)
        .join(places, F.col("ds").eqNullSafe(F.col("place_ds")))
        .select(
            "ds",
            F.col("n").alias("total_transactions"),
            F.col("total").alias("total_revenue_vnd"),
            F.try_divide("total", "amounts").alias("avg_transaction_vnd"),
            F.col("users").alias("unique_users"),
            F.col("merchants").alias("unique_merchants"),
            F.col("cities").alias("unique_cities"),
            F.col("errors").alias("error_transactions"),
            F.col("frauds").alias("fraud_transactions"),
            F.col("largest").alias("max_transaction_vnd"),
            F.col("smallest").alias("min_transaction_vnd"),
        )
    )


def weekday_vs_weekend(by_day_type: DataFrame) -> DataFrame:
    return (
        by_day_type.groupBy("day_type")
        .agg(
            F.sum("n").alias("transaction_count"),
            F.sum("total").alias("total_amount_vnd"),
            F.try_divide(F.sum("total"), F.sum("amounts")).alias("avg_amount_vnd"),
            F.count("ds").alias("unique_days"),
            F.try_divide(F.sum("n"), F.count("*")).alias("avg_transactions_per_day"),
        )
    )
