"""Aggregates that shuffle before they group, and what reads a stored table."""

import re
import threading

import pytest

from checks import queries
from ledgerloom import jobs
from ledgerloom.fixtures import transactions_from_lineitem
from ledgerloom.plans import history, report, spread
from ledgerloom.plans.shared import BY_USER_DAY, ROLLUPS, roll_up
from tests.data import as_set, expected, frame, records
from tests.test_ingest import clean, raw
from tests.test_plans import plan


@pytest.mark.parametrize("name, parts", [("user_analysis", 5), ("daily_summary", 10)])
def test_tasks_hold_the_same_however_many_rows(spark, monkeypatch, name, parts):
    """24 rows, 5 a task; nothing is grouped or made several of by hashing before the first shuffle."""
    monkeypatch.setattr(spread, "TASK_ROWS", 5)
    made = report(frame(spark), name, sort=False)
    text = plan(made)
    assert f", {parts})" in re.findall(r"hashpartitioning\(.*?, \d+\)", text)[-1]
    assert "Expand" not in text and "Aggregate" not in text.split("Exchange hashpartitioning")[-1]
    assert as_set(made.collect()) == as_set(expected(records(), name, None))


def test_the_rollup_by_user_and_day_does_so_too(spark, monkeypatch):
    monkeypatch.setattr(spread, "TASK_ROWS", 5)
    assert "Expand" not in plan(roll_up(frame(spark), ROLLUPS[BY_USER_DAY], None, (), None))


def test_facts_are_joined_in_as_many_tasks_as_they_fill(spark, monkeypatch):
    monkeypatch.setattr(spread, "TASK_ROWS", 1000)
    text = plan(transactions_from_lineitem(spark, "/root/testdata/sf0.001", ["user_id", "ds"]))
    n = -(-spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count() // 1000)
    assert "hashpartitioning(l_orderkey" in text and text.count(f", {n})") >= 2


@pytest.mark.parametrize("name", ["shared_daily_summary", "published_files"])
def test_what_reads_transactions_several_times_joins_once(spark, monkeypatch, name):
    seen = []

    def noted(*args, **kwargs):
        seen.append(args[1] if name == "published_files" else args[0])
        raise InterruptedError

    monkeypatch.setattr(*((jobs, "run_daily") if name == "published_files" else (queries, "build_reports")), noted)
    with pytest.raises(InterruptedError):
        queries.registered()[name](spark, "/root/testdata/sf0.001")
    assert "Join" not in plan(seen[0]) and seen[0].count() == queries.table(spark, "/root/testdata/sf0.001", "lineitem").count()


def test_states_of_days_are_made_at_the_same_time(spark, tmp_path, monkeypatch):
    lake, store = str(tmp_path / "lake"), str(tmp_path / "store")
    jobs.store_batch_records(clean(spark, [raw(), raw(Day="2")]), lake, "one")
    both, real = threading.Barrier(2, timeout=60), history.keep_days

    def keep_days(session, made, path, days):
        if path.endswith(("by_user_day", "by_merchant_day")) and "flags" not in path:
            both.wait()
        real(session, made, path, days)

    monkeypatch.setattr(history, "keep_days", keep_days)
    assert len(history.update_history(spark, lake, store)) == 2
