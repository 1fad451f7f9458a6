import datetime
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.grains import LatestBounds
from ledgerloom.plans import DATASETS, REPORTS, build_reports, report
from ledgerloom.plans.catalog import ERROR, FRAUD, select_datasets
from ledgerloom.plans.reports import top
from ledgerloom.session import scratch_dir
from tests.data import ROWS, as_set, expected, frame, records


@pytest.fixture(scope="module")
def clean(spark):
    return frame(spark).cache()


@pytest.fixture(scope="module")
def shared(spark, clean):
    return build_reports(clean, scratch_dir(spark, "test"))


def test_registry_has_35_datasets():
    assert len(REPORTS) == 15 and len(DATASETS) == 35
    assert len({d.file_stem for d in DATASETS.values()}) == 35
    assert {d.path for d in DATASETS.values()} >= {"hourly_analysis/day", "daily_summary"}


def test_predicate_texts_match_the_columns(spark, clean):
    rows = clean.collect()
    assert clean.where(ERROR).count() == sum(bool(r.has_errors) for r in rows) == 7
    assert clean.where(FRAUD).count() == sum(r.is_fraud == "Yes" for r in rows) == 8


@pytest.mark.parametrize("key", DATASETS)
def test_plain(clean, key):
    d = DATASETS[key]
    got = report(clean, d.report.name, d.grain)
    assert got.columns == d.report.columns
    assert as_set(got.collect()) == as_set(expected(records(), d.report.name, d.grain))


@pytest.mark.parametrize("key", DATASETS)
def test_shared(clean, shared, key):
    d = DATASETS[key]
    plain = report(clean, d.report.name, d.grain)
    assert shared[key].schema.simpleString() == plain.schema.simpleString()
    assert as_set(shared[key].collect()) == as_set(expected(records(), d.report.name, d.grain))


@pytest.mark.parametrize("key", DATASETS)
def test_sorted(clean, key):
    d = DATASETS[key]
    rows = report(clean, d.report.name, d.grain).collect()
    if d.report.sort:
        measure = [r[d.report.sort] for r in rows]
        ranked = [m for m in measure if m is not None]
        assert ranked == sorted(ranked, reverse=True)


def test_some_rows_by_hand(clean):
    rows = report(clean, "hourly_analysis", "day").collect()
    assert [tuple(r) for r in rows] == [(None, 2), (15, 2), (16, 2)]
    rates = {
        (str(r.ds), r.merchant_name): (r.total_transactions, r.fraud_transactions, r.fraud_rate_percent)
        for r in report(clean, "fraud_rate_by_merchant").collect()
    }
    assert rates["2023-12-31", None] == (1, 1, 100.0)
    assert rates["2023-12-30", "Cafe"] == (2, 1, 50.0)
    assert rates["2024-02-01", "Shop"] == (3, 1, 33.33)
    frequent = {r.user_id: tuple(r)[1:] for r in report(clean, "user_frequent").collect()}
    assert frequent[1] == (3, 7, 7 / 3)
    kinds = {r.day_type: (r.transaction_count, r.unique_days) for r in report(clean, "weekday_vs_weekend").collect()}
    assert kinds == {"Weekend": (14, 5), "Weekday": (10, 3)}


def test_latest_bounds(clean):
    assert LatestBounds.of(clean) == LatestBounds(
        datetime.date(2024, 2, 3), datetime.date(2024, 2, 1), datetime.date(2024, 1, 1)
    )


def test_high_value_limit_is_over_all_rows(clean):
    # P95 of the whole table lies above everything bought on the latest day.
    assert report(clean, "high_value_analysis", "day").count() == 0
    assert report(clean, "high_value_analysis", "year").count() == 1


def test_approximate_threshold_runs(clean):
    got = report(clean, "high_value_analysis", "year", threshold="approx")
    assert got.count() >= 1


def test_top(clean):
    rows = top(report(clean, "city_analysis", "year", sort=False), "city_analysis", 2).collect()
    assert [r.merchant_city for r in rows] == ["Hanoi", "Hue"]


def test_empty_table(spark):
    empty = frame(spark, [])
    built = build_reports(empty, scratch_dir(spark, "test"))
    for key, d in DATASETS.items():
        assert report(empty, d.report.name, d.grain).count() == 0, key
        assert built[key].count() == 0, key


def test_latest_day_without_errors_or_fraud(spark):
    quiet = [r for r in ROWS if r[-1] < datetime.date(2024, 2, 3)] + [
        (1, "15", "8.00", "Bar", "Hue", "TT", "", "No", datetime.date(2024, 2, 3))
    ]
    df = frame(spark, quiet)
    built = build_reports(df, scratch_dir(spark, "test"))
    for key in ("hourly_unusual_analysis_day", "fraud_by_city_day", "user_error_analysis_day"):
        assert built[key].count() == 0
    assert built["hourly_analysis_day"].count() == 1


def test_a_hot_merchant_and_user(spark):
    """A third of the rows are copies of one; all are counted."""
    hot = ("1", "09")
    rows = ROWS + [(1, "09", "10.00", "Cafe", "Hue", "TT", "", "Yes", datetime.date(2024, 2, 3))] * 12
    df = frame(spark, rows)
    built = build_reports(df, scratch_dir(spark, "test"))
    for key, d in DATASETS.items():
        want = as_set(expected(records(rows), d.report.name, d.grain))
        assert as_set(built[key].collect()) == want, (key, hot)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_tables(spark, seed):
    """Both forms against plain loops, on rows with gaps, copies and a hot group."""
    rng = random.Random(seed)

    def one():
        day = datetime.date(2023, 11, 1) + datetime.timedelta(days=rng.choice([0, 1, 40, 95, 96, 120]))
        return (
            rng.choice([1, 1, 1, 2, 3, 4, None]),
            rng.choice(["00", "09", "09", "23", "bad", None]),
            rng.choice(["1.00", "2.50", "-3.10", "99999.99", None, f"{rng.randrange(900)}.37"]),
            rng.choice(["Cafe", "Cafe", "Bar", "", None]),
            rng.choice(["Hue", "Hanoi", None]),
            rng.choice(["TT", "HN", "", None]),
            rng.choice(["", "", "Bad PIN", "Yes", None]),
            rng.choice(["No", "No", "Yes", None]),
            day,
        )

    rows = [one() for _ in range(200)]
    rows += [rows[0]] * 100
    df = frame(spark, rows).cache()
    built = build_reports(df, scratch_dir(spark, "test"))
    for key, d in DATASETS.items():
        want = as_set(expected(records(rows), d.report.name, d.grain))
        assert as_set(built[key].collect()) == want, key
        assert as_set(report(df, d.report.name, d.grain).collect()) == want, key


@pytest.mark.parametrize("grains", [["day"], ["month"], ["day", "year"]])
def test_chosen_grains(spark, clean, grains):
    names = ["city_analysis", "daily_summary"]
    built = build_reports(clean, scratch_dir(spark, "test"), names, grains)
    assert set(built) == {f"city_analysis_{g}" for g in grains} | {"daily_summary"}
    for key, df in built.items():
        d = DATASETS[key]
        assert as_set(df.collect()) == as_set(expected(records(), d.report.name, d.grain))


def test_wrong_arguments(clean):
    with pytest.raises(ValueError):
        report(clean, "hourly_analysis")
    with pytest.raises(ValueError):
        report(clean, "daily_summary", "day")
    with pytest.raises(ValueError):
        select_datasets(names=["nothing"])
    with pytest.raises(ValueError):
        select_datasets(grains=["week"])


def test_text_partition_column(spark, clean):
    """A table whose ``ds`` was read as text gives the same grains."""
    text = clean.withColumn("ds", F.col("ds").cast("string"))
    for grain in ("day", "month", "year"):
        assert as_set(report(text, "hourly_analysis", grain).collect()) == as_set(
            expected(records(), "hourly_analysis", grain)
        )
