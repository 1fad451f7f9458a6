"""One report as one lazy query over the clean transactions."""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import day_type, hour_of_day, percent
from ledgerloom.operators.grains import LatestBounds
from ledgerloom.operators.quantile import approximate_quantile, exact_quantile
from ledgerloom.plans.catalog import DAY_MEASURES, REPORTS, SPREAD, Report
from ledgerloom.plans.spread import day_totals, user_days

HIGH_VALUE_SHARE = 0.95


def aggregates(measures: dict[str, str]) -> list[Column]:
    return [F.expr(sql).alias(name) for name, sql in measures.items()]


def with_derived_keys(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    if "hour" in keys:
        df = df.withColumn("hour", hour_of_day(F.col("time")))
    if "day_type" in keys:
        df = df.withColumn("day_type", day_type(F.col("transaction_date")))
    return df


def finish(df: DataFrame, spec: Report, sort: bool) -> DataFrame:
    """Computed ratio, column order and, on demand, the report's sort order."""
    if spec.ratio:
        name, part, whole = spec.ratio
        df = df.withColumn(name, percent(F.col(part), F.col(whole)))
    df = df.select(*spec.columns)
    return df.orderBy(*sort_columns(spec)) if sort else df


def sort_columns(spec: Report) -> list[Column]:
    return [F.desc(name) if down else F.asc(name) for name, down in spec.order]


def high_value_threshold(df: DataFrame, mode: str = "exact") -> int | None:
    """F6's limit: P95 over the whole table, not over one grain."""
    if mode == "exact":
        return exact_quantile(df, "amount_vnd", HIGH_VALUE_SHARE)
    if mode == "approx":
        return approximate_quantile(df, "amount_vnd", HIGH_VALUE_SHARE).first().threshold
    raise ValueError(f"threshold mode {mode!r}")


def is_high_value(threshold: int | None) -> Column:
    return F.col("amount_vnd") >= F.lit(threshold).cast("bigint")


def report(
    df: DataFrame,
    name: str,
    grain: str | None = None,
    *,
    bounds: LatestBounds | None = None,
    threshold: int | str | None = "exact",
    sort: bool = True,
    row_count: int | None = None,
) -> DataFrame:
    """Report ``name`` over ``df``, at ``grain`` for the families that have one.

    ``bounds`` and ``threshold`` are looked up in ``df`` unless given;
    ``threshold`` is a value, or the mode to find it: ``exact`` or ``approx``.
    ``row_count`` is about how many rows ``df`` has; where it matters they are counted unless given.
    """
    spec = REPORTS[name]
    if spec.by_grain != (grain is not None):
        raise ValueError(f"{name}: grain {grain!r}")
    rows = df
    if grain:
        rows = rows.where((bounds or LatestBounds.of(df)).contains(grain))
    if spec.where:
        rows = rows.where(spec.where)
    if spec.high_value:
        if isinstance(threshold, str):
            threshold = high_value_threshold(df, threshold)
        rows = rows.where(is_high_value(threshold))
    if name in SPREAD:
        return finish(spread_report(rows, spec, row_count), spec, sort)
    rows = with_derived_keys(rows, spec.first_keys or spec.keys)
    if spec.first_measures:
        rows = rows.groupBy(*spec.first_keys).agg(*aggregates(spec.first_measures))
        if spec.having:
            rows = rows.where(spec.having)
    return finish(rows.groupBy(*spec.keys).agg(*aggregates(spec.measures)), spec, sort)


def spread_report(df: DataFrame, spec: Report, row_count: int | None) -> DataFrame:
    measures = {m: sql for m, sql in DAY_MEASURES.items() if any(m in re.findall(r"\w+", c) for c in SPREAD[spec.name].values())}
    made = (user_days if "user_id" in spec.keys else day_totals)(df.select(*spec.reads), measures, row_count)
    return made.select(*spec.keys, *aggregates(SPREAD[spec.name]))


def top(result: DataFrame, name: str, k: int) -> DataFrame:
    """O2: the first ``k`` rows of a report in its own order."""
    return result.orderBy(*sort_columns(REPORTS[name])).limit(k)
