import pytest

from ledgerloom import jobs, sources
from ledgerloom.operators.grains import LatestBounds
from ledgerloom.operators.quantile import exact_quantile
from ledgerloom.plans import DATASETS, build_reports, report
from ledgerloom.plans.history import kept_rollups, kept_threshold, update_history
from ledgerloom.sinks.compaction import compact
from tests.data import as_set
from tests.test_ingest import clean, raw


def from_kept(spark, lake, store, scratch):
    """All reports out of what is kept; of the lake, only names of folders are looked at."""
    bounds = LatestBounds.of_lake(spark, lake)
    kept = kept_rollups(spark, store, f"{scratch}/merged", bounds)
    rows = sources.read_clean(spark, lake).where("1 = 0")
    return build_reports(rows, f"{scratch}/kept", bounds=bounds, kept=kept, threshold=None)


def reports(spark, lake, store, scratch):
    return from_kept(spark, lake, store, scratch), build_reports(sources.read_clean(spark, lake), f"{scratch}/full")


def test_only_touched_days_are_computed(spark, tmp_path):
    lake, store = str(tmp_path / "lake"), str(tmp_path / "store")
    assert update_history(spark, lake, store) == []
    rows = [raw(Day=str(d), User=str(d % 3), Time=f"0{d % 4}:10") for d in range(1, 9)] * 2
    jobs.store_batch_records(clean(spark, rows), lake, "one")
    assert [d.day for d in update_history(spark, lake, store)] == list(range(1, 9))
    assert update_history(spark, lake, store) == []
    jobs.store_batch_records(clean(spark, [raw(Day="3", User="9"), raw(Day="12")]), lake, "two")
    assert [d.day for d in update_history(spark, lake, store)] == [3, 12]
    # a corrected batch takes a day away
    jobs.store_batch_records(clean(spark, [raw(Day="3", User="9")]), lake, "two")
    assert [d.day for d in update_history(spark, lake, store)] == [3]
    assert not (tmp_path / "store" / "by_user_day" / "ds=2002-09-12").exists()
    some, full = reports(spark, lake, store, tmp_path)
    for key in DATASETS:
        assert as_set(some[key].collect()) == as_set(full[key].collect()), key


def test_a_broken_run_is_made_up_for(spark, tmp_path, monkeypatch):
    lake, store = str(tmp_path / "lake"), str(tmp_path / "store")
    jobs.store_batch_records(clean(spark, [raw(), raw(Day="2")]), lake, "one")
    from ledgerloom.plans import history

    with monkeypatch.context() as m:
        m.setattr(history, "frequent_days", lambda rows: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            update_history(spark, lake, store)
    assert len(update_history(spark, lake, store)) == 2
    some, full = reports(spark, lake, store, tmp_path)
    assert as_set(some["daily_summary"].collect()) == as_set(full["daily_summary"].collect())


def test_daily_run_on_a_lake(spark, tmp_path):
    lake, store, warehouse, dest = (str(tmp_path / n) for n in ("lake", "store", "w", "d"))
    jobs.store_batch_records(clean(spark, [raw(), raw(Day="2")]), lake, "one")
    assert jobs.run_daily_lake(spark, lake, store, warehouse, dest).count() == len(DATASETS)
    summary = spark.read.option("header", True).csv(f"{dest}/daily_summary.csv")
    assert summary.count() == 2


def varied(days, seed=0):
    """Purchases of some users at some places, small and large, with errors, fraud and NULLs."""
    return [
        raw(
            Day=str(d), User=str(7 * u % 5), Time=f"{(d + u) % 24:02d}:10", Amount=f"${(u * u * 37 + d + seed) % 900}.50" if u % 11 else "",
            Merchant=f"m{u % 3}" if u % 7 else None, Errors="Bad PIN" if u % 4 == 0 else "", Fraud="Yes" if u % 5 == 0 else "No",
        )
        for d in days
        for u in range(25)
    ]


def spoil(lake, *days):
    """Files of other days can't be read any more."""
    for path in lake.glob("outcome=clean/ds=*/batch=*/*.parquet"):
        if path.parts[-3] not in {f"ds=2002-09-{d:02d}" for d in days}:
            path.write_bytes(b"not a table")
            (path.parent / f".{path.name}.crc").unlink(missing_ok=True)


def test_a_second_run_reads_touched_days_only(spark, tmp_path):
    """All 35 datasets, day, month and year, customers and the high-value limit, though the files of all other
    days are spoiled; equal to reports out of the whole lake."""
    lake, store, whole = (str(tmp_path / n) for n in ("lake", "store", "whole"))
    first, second = varied(range(1, 6)), varied([2, 9], seed=500)
    for target in (lake, whole):
        jobs.store_batch_records(clean(spark, first), target, "one")
    assert len(update_history(spark, lake, store)) == 5
    for target in (lake, whole):
        jobs.store_batch_records(clean(spark, second), target, "two")
    spoil(tmp_path / "lake", 2, 9)
    assert [d.day for d in update_history(spark, lake, store)] == [2, 9]
    full = sources.read_clean(spark, whole)
    limit = exact_quantile(full, "amount_vnd", 0.95)
    assert kept_threshold(spark, store) == limit
    some = from_kept(spark, lake, store, tmp_path)
    want = build_reports(full, f"{tmp_path}/whole_rollups")
    for key in DATASETS:
        assert as_set(some[key].collect()) == as_set(want[key].collect()), key


def test_a_limit_that_falls_below_what_is_kept(spark, tmp_path):
    """Large amounts are corrected away: the tail is counted anew."""
    lake, store = str(tmp_path / "lake"), str(tmp_path / "store")
    jobs.store_batch_records(clean(spark, [raw(Amount=f"${k}.00") for k in range(1, 41)]), lake, "small")
    jobs.store_batch_records(clean(spark, [raw(Day="2", Amount=f"${k}000.00") for k in range(1, 41)]), lake, "large")
    limits = []
    for batch in (None, [raw(Day="2")], [], [raw(Amount="")]):
        if batch is not None:
            jobs.store_batch_records(clean(spark, batch), lake, "large")
        update_history(spark, lake, store)
        limits.append(kept_threshold(spark, store))
        assert limits[-1] == exact_quantile(sources.read_clean(spark, lake), "amount_vnd", 0.95)
        key = "high_value_analysis_year"
        some = from_kept(spark, lake, store, tmp_path)[key]
        full = report(sources.read_clean(spark, lake), "high_value_analysis", "year", threshold=limits[-1])
        assert as_set(some.collect()) == as_set(full.collect())
    assert limits[0] > limits[1] > limits[2] == limits[3]
    for batch in ("small", "large"):
        jobs.store_batch_records(clean(spark, []), lake, batch)
    update_history(spark, lake, store)
    assert kept_threshold(spark, store) is None


def test_kept_states_of_a_compacted_lake(spark, tmp_path):
    lake, store = str(tmp_path / "lake"), str(tmp_path / "store")
    for batch in range(2):
        jobs.store_batch_records(clean(spark, varied([1, 2], batch)), lake, str(batch))
    update_history(spark, lake, store)
    compact(spark, lake, least_files=2)
    jobs.store_batch_records(clean(spark, varied([2], 9)), lake, "1")
    assert [d.day for d in update_history(spark, lake, store)] == [1, 2]
    some, full = reports(spark, lake, store, tmp_path)
    for key in ("merchant_analysis_month", "user_error_analysis_day", "fraud_by_hour_year", "daily_summary"):
        assert as_set(some[key].collect()) == as_set(full[key].collect()), key
