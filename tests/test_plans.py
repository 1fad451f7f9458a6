"""What the physical plans must look like at scale."""

import re

import pytest

from ledgerloom.fixtures import transactions_from_lineitem
from ledgerloom.operators.grains import LatestBounds
from ledgerloom.plans import DATASETS, REPORTS, report, shared
from ledgerloom.plans.shared import ROLLUPS, SOURCES, roll_up
from ledgerloom.sinks import lake as lake_sink
from ledgerloom.sources import read_clean
from tests.data import frame


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """A lake partitioned by day, holding the hand-written rows."""
    path = str(tmp_path_factory.mktemp("lake"))
    from pyspark.sql import functions as F

    df = frame(spark).withColumn("outcome", F.lit("clean"))
    lake_sink.write_lake(df, path, "b")
    return read_clean(spark, path)


@pytest.fixture(scope="module")
def bounds(stored):
    return LatestBounds.of(stored)


@pytest.mark.parametrize("key", DATASETS)
def test_columns_and_partitions(stored, bounds, key):
    d = DATASETS[key]
    text = plan(report(stored, d.report.name, d.grain, bounds=bounds, threshold=1))
    read = set()
    for schema in re.findall(r"ReadSchema: struct<(.*?)>", text):
        read |= {f.split(":")[0] for f in schema.split(",") if f}
    assert read <= set(d.report.reads) - {"ds"}
    if d.grain:
        (filters,) = set(re.findall(r"PartitionFilters: \[(.*?)\]", text))
        assert "ds" in filters and (">=" in filters or "=" in filters)
    assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text
    assert text.count("FileScan") == 1


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("user_fraud_analysis", "EqualTo(is_fraud,Yes)"),
        ("hourly_unusual_analysis", "Not(EqualTo(has_errors,))"),
        ("high_value_analysis", "GreaterThanOrEqual(amount_vnd,1)"),
    ],
)
def test_row_filters_reach_the_scan(stored, bounds, name, pushed):
    assert pushed in plan(report(stored, name, "year", bounds=bounds, threshold=1))


def test_latest_day_reads_no_data_column(stored):
    from ledgerloom.operators.grains import latest_bounds_frame

    assert "ReadSchema: struct<>" in plan(latest_bounds_frame(stored))


@pytest.mark.parametrize("name", ["merchant_analysis", "user_analysis", "daily_summary"])
def test_distinct_counts_spread_a_hot_group(stored, bounds, name):
    """The first shuffle is by group and counted value, not by group alone."""
    grain = "year" if REPORTS[name].by_grain else None
    text = plan(report(stored, name, grain, bounds=bounds, sort=False))
    shuffles = re.findall(r"hashpartitioning\((.*?), \d+\)", text)
    assert len(shuffles) == 2
    by_value = shuffles[-1]
    assert "user_id" in by_value or "merchant_name" in by_value
    assert len(by_value.split(",")) > len(REPORTS[name].keys)


def test_every_aggregate_combines_before_its_shuffle(stored, bounds):
    for d in DATASETS.values():
        text = plan(report(stored, d.report.name, d.grain, bounds=bounds, threshold=1, sort=False))
        assert text.count("partial_") >= 1, d.id


@pytest.mark.parametrize("name", ROLLUPS)
def test_rollups_scan_once(stored, bounds, name):
    text = plan(roll_up(stored, ROLLUPS[name], bounds, ("day", "month", "year"), 1))
    assert text.count("FileScan") == 1
    assert ("Generate explode" in text) == ROLLUPS[name].latest


def test_each_report_has_a_source():
    assert set(SOURCES) == set(REPORTS)
    assert {s for sources in SOURCES.values() for s in sources} == {*ROLLUPS, shared.FREQUENT}


def test_lake_write_gathers_days(spark):
    df = frame(spark)
    from pyspark.sql import functions as F

    hinted = df.withColumn("outcome", F.lit("clean")).hint("rebalance", F.col("outcome"), F.col("ds"))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(hinted)


def test_unused_dimensions_are_not_joined(spark):
    text = plan(transactions_from_lineitem(spark, "/root/testdata/sf0.001", ["time", "ds"]))
    assert "Join" not in text and text.count("FileScan") == 1
