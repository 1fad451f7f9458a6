"""Batches and their manifests, compaction, and what readers see meanwhile."""

import os
import time
from collections import Counter
from datetime import date, timedelta
from decimal import Decimal

import pytest

from ledgerloom import jobs, sources
from ledgerloom.operators.grains import LatestBounds
from ledgerloom.plans.history import update_history
from ledgerloom.schema import FX
from ledgerloom.sinks import compaction, generations, lake as lake_sink, manifests, paths
from ledgerloom.sinks.compaction import compact
from ledgerloom.streaming.ingest import store_batch
from tests.data import as_set
from tests.test_ingest import START, clean, messages, rates, raw


def store(spark, lake, batch, *rows):
    return lake_sink.write_lake(clean(spark, list(rows)), lake, batch)


def days(spark, lake) -> Counter:
    return Counter(r.ds.day for r in sources.read_clean(spark, lake).collect())


def folders(lake) -> set[str]:
    return {"/".join(p.parts[-4:-1]) for p in lake.glob("outcome=*/ds=*/batch=*/*.parquet")}


@pytest.fixture
def lake(tmp_path):
    return str(tmp_path / "lake")


def test_manifest_of_a_batch(spark, lake, tmp_path):
    manifest = store(spark, lake, "one", raw(Day="1"), raw(Day="1"), raw(Day="2"), "{bad", raw(Day="31"))
    assert (manifest.accepted, manifest.refused, manifest.state) == (3, 2, manifests.STORED)
    assert {f"outcome={f.outcome}/ds={f.ds}/batch={f.folder}" for f in manifest.folders} == folders(tmp_path / "lake")
    assert all(f.files == 1 and f.bytes > 0 for f in manifest.folders)
    store(spark, lake, "a b:c", raw(Day="3"))
    assert days(spark, lake) == {1: 2, 2: 1, 3: 1}
    counts = {r.batch: (r.accepted, r.refused) for r in manifests.batch_counts(spark, lake).collect()}
    assert counts == {"one": (3, 2), "a b:c": (1, 0)}
    assert manifests.read_manifest(spark, lake, "none") is None


@pytest.mark.parametrize("key", ["", "a/b", "a@1", "compacted", "added"])
def test_keys_with_a_meaning_are_refused(spark, lake, key):
    with pytest.raises(ValueError):
        store(spark, lake, key, raw())


def test_batches_without_records(spark, lake):
    assert store(spark, lake, "none") is None
    assert not os.path.exists(lake)
    store(spark, lake, "one", raw(), "{bad")
    # corrected to nothing: the records go, the manifest says so
    manifest = store(spark, lake, "one")
    assert (manifest.folders, manifest.accepted, manifest.refused) == ((), 0, 0)
    assert sources.read_clean(spark, lake).count() == 0


def listed_by(monkeypatch, act) -> int:
    """File-system entries that reached the driver."""
    seen = []
    sizes, names = paths.sizes, paths.names

    def counted(function):
        def call(spark, pattern):
            found = function(spark, pattern)
            seen.append(len(found))
            return found

        return call

    with monkeypatch.context() as m:
        m.setattr(paths, "sizes", counted(sizes))
        m.setattr(paths, "names", counted(names))
        act()
    return sum(seen)


def test_listing_does_not_grow_with_the_days_of_a_lake(spark, tmp_path, monkeypatch):
    """3,000 days of other batches are not looked at when a batch is stored or stored again."""
    costs = []
    for n_days in (3, 3000):
        root = tmp_path / str(n_days)
        for k in range(n_days):
            folder = root / "outcome=clean" / f"ds={date(1990, 1, 1) + timedelta(days=k)}" / "batch=old"
            folder.mkdir(parents=True)
            (folder / "part-0.parquet").touch()

        def act():
            store(spark, str(root), "b", raw(Day="1"), raw(Day="2"), "{bad")
            store(spark, str(root), "b", raw(Day="2"), raw(Day="3"))

        costs.append(listed_by(monkeypatch, act))
        assert {p.parts[-2] for p in root.glob("outcome=*/ds=*/batch=b")} == {"ds=2002-09-02", "ds=2002-09-03"}
        assert len(list(root.glob("outcome=clean/ds=*/batch=old/part-0.parquet"))) == n_days
    assert costs[0] == costs[1] < 40


@pytest.mark.parametrize("step", ["place", "write_manifest", "delete"])
def test_an_attempt_that_broke_off_is_replaced(spark, lake, tmp_path, monkeypatch, step):
    """Folders that only the lost attempt had go with the next one."""
    store(spark, lake, "one", raw(Day="1"), raw(Day="2"))
    calls = []

    def broken(*args):
        calls.append(args)
        if len(calls) == (2 if step == "write_manifest" else 1):
            raise KeyboardInterrupt
        return real(*args)

    owner = paths if step == "delete" else lake_sink
    real = getattr(owner, step)
    with monkeypatch.context() as m:
        m.setattr(owner, step, broken)
        with pytest.raises(KeyboardInterrupt):
            store(spark, lake, "one", raw(Day="5"), raw(Day="6"), "{bad")
    store(spark, lake, "two", raw(Day="5"))
    store(spark, lake, "one", raw(Day="1"), raw(Day="9"))
    assert days(spark, lake) == {1: 1, 5: 1, 9: 1}
    assert sources.read_rejected(spark, lake).count() == 0
    assert folders(tmp_path / "lake") == {
        "outcome=clean/ds=2002-09-01/batch=one",
        "outcome=clean/ds=2002-09-09/batch=one",
        "outcome=clean/ds=2002-09-05/batch=two",
    }


def test_a_lock_left_behind_is_broken(spark, lake, monkeypatch):
    store(spark, lake, "one", raw())
    lock = f"{generations.generations_path(lake)}/.lock"
    assert paths.claim(spark, lock)
    old = time.time() - generations.STALE_SECONDS - 60
    os.utime(lock, (old, old))
    store(spark, lake, "two", raw())
    assert not os.path.exists(lock) and days(spark, lake) == {1: 2}


def fill(spark, lake, n=4):
    for k in range(n):
        store(spark, lake, f"b{k}", *(raw(Day=str(d), User=str(k)) for d in range(1, 4)), raw(Day="1", User=str(k)), "{bad")


def contents(spark, lake):
    return as_set(sources.read_clean(spark, lake).collect()), as_set(sources.read_rejected(spark, lake).collect())


def test_readers_see_each_row_once(spark, lake, tmp_path, monkeypatch):
    """Before, during and after a compaction, and through a frame made before it."""
    fill(spark, lake)
    before = contents(spark, lake)
    assert sum(before[0].values()) == 16 and sum(before[1].values()) == 4
    early = sources.read_clean(spark, lake)
    during = []
    commit = generations.commit

    def watched(*args):
        during.append(contents(spark, lake))
        commit(*args)
        during.append(contents(spark, lake))

    monkeypatch.setattr(generations, "commit", watched)
    done = compact(spark, lake, least_files=4)
    assert len(done) == 4
    assert during == [before, before] and contents(spark, lake) == before
    assert as_set(early.collect()) == before[0]
    # the old files go with the next one
    assert len(list((tmp_path / "lake").glob("outcome=clean/ds=*/batch=*/*.parquet"))) == 15
    assert compact(spark, lake, least_files=4) == []
    assert folders(tmp_path / "lake") == {
        f"outcome=clean/ds=2002-09-0{d}/batch=compacted@1" for d in (1, 2, 3)
    } | {"outcome=rejected/ds=__HIVE_DEFAULT_PARTITION__/batch=compacted@1"}
    assert contents(spark, lake) == before
    assert LatestBounds.of_lake(spark, lake).day == date(2002, 9, 3)


def test_replay_of_a_compacted_batch(spark, lake):
    fill(spark, lake)
    compact(spark, lake, least_files=2)
    store(spark, lake, "b1", raw(Day="2", User="77"), raw(Day="8", User="77"))
    rows = sources.read_clean(spark, lake).collect()
    assert Counter(r.ds.day for r in rows) == {1: 6, 2: 4, 3: 3, 8: 1}
    assert Counter(r.user_id for r in rows) == {0: 4, 2: 4, 3: 4, 77: 2}
    assert sources.read_rejected(spark, lake).count() == 3
    # again, now with rows in a folder of a later number
    compact(spark, lake, least_files=1)
    store(spark, lake, "b1", raw(Day="1", User="78"))
    assert Counter(r.user_id for r in sources.read_clean(spark, lake).collect()) == {0: 4, 2: 4, 3: 4, 78: 1}
    compact(spark, lake, least_files=1)
    assert days(spark, lake) == {1: 7, 2: 3, 3: 3}


def test_a_day_that_changes_meanwhile_is_left(spark, lake, monkeypatch):
    fill(spark, lake)
    stage = compaction.stage

    def meanwhile(*args):
        out = stage(*args)
        monkeypatch.setattr(compaction, "stage", stage)
        store(spark, lake, "b2", raw(Day="3", User="2"))  # corrected: two days lose rows
        store(spark, lake, "new", raw(Day="2", User="9"), raw(Day="4"))
        return out

    monkeypatch.setattr(compaction, "stage", meanwhile)
    done = compact(spark, lake, least_files=2)
    assert done == []  # all days had rows of the batch that was replaced
    assert days(spark, lake) == {1: 6, 2: 4, 3: 4, 4: 1}
    assert len(compact(spark, lake, least_files=2)) == 4
    assert days(spark, lake) == {1: 6, 2: 4, 3: 4, 4: 1}


def test_a_batch_that_comes_meanwhile_counts(spark, lake, monkeypatch):
    """It is stored with the number of the rewriting under way, which does not cover it."""
    fill(spark, lake)
    stage = compaction.stage

    def meanwhile(*args):
        out = stage(*args)
        monkeypatch.setattr(compaction, "stage", stage)
        store(spark, lake, "new", raw(Day="2", User="9"))
        return out

    monkeypatch.setattr(compaction, "stage", meanwhile)
    assert len(compact(spark, lake, least_files=2)) == 4
    assert days(spark, lake) == {1: 8, 2: 5, 3: 4}
    store(spark, lake, "new", raw(Day="3", User="9"))
    assert days(spark, lake) == {1: 8, 2: 4, 3: 5}


def test_a_compaction_that_breaks_off_is_not_seen(spark, lake, monkeypatch):
    fill(spark, lake)
    before = contents(spark, lake)
    with monkeypatch.context() as m:
        m.setattr(generations, "commit", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            compact(spark, lake, least_files=2)
    assert contents(spark, lake) == before
    store(spark, lake, "b0", raw(Day="1", User="0"))
    assert days(spark, lake) == {1: 7, 2: 3, 3: 3}
    assert len(compact(spark, lake, least_files=2)) == 4
    compact(spark, lake, least_files=2)
    assert days(spark, lake) == {1: 7, 2: 3, 3: 3}


def test_only_days_with_many_small_files(spark, lake):
    fill(spark, lake, 3)
    store(spark, lake, "other", raw(Day="9"))
    assert {d for _, d in compact(spark, lake, least_files=3)} == {"2002-09-01", "2002-09-02", "2002-09-03", "__HIVE_DEFAULT_PARTITION__"}
    assert compact(spark, lake, least_files=1, small_bytes=1) == []


def test_kept_history_survives_compaction(spark, lake, tmp_path):
    history = str(tmp_path / "history")
    fill(spark, lake)
    assert len(update_history(spark, lake, history)) == 3
    compact(spark, lake, least_files=2)
    assert update_history(spark, lake, history) == []
    store(spark, lake, "b1", raw(Day="2"))
    assert [d.day for d in update_history(spark, lake, history)] == [1, 2, 3]
    assert update_history(spark, lake, history) == []
    jobs.store_batch_records(clean(spark, []), lake, "b1")
    assert [d.day for d in update_history(spark, lake, history)] == [2]


def test_history_state_stays_with_executors(spark, lake, tmp_path):
    """Only touched days come to the driver."""
    from ledgerloom.plans import history

    fill(spark, lake)
    now = history.attempts_by_day(spark, lake)
    assert now.count() == 12
    assert history.changed_days(now, now) == ([], [])
    known = now.where("ds <> '2002-09-02' OR batch <> 'b1'")
    assert history.changed_days(now, known) == (["2002-09-02"], [])
    assert history.changed_days(now.where("ds = '2002-09-01'"), now) == ([], ["2002-09-02", "2002-09-03"])


def refused_without_rates(spark, lake):
    """Two batches of which only broken records should have been refused."""
    none = spark.createDataFrame([], FX)
    for batch, day in (("one", "1"), ("two", "2")):
        store_batch(messages(spark, [raw(Day=day), raw(Day="3", User="7"), "{bad", raw(Amount="", Day="4")]), none, lake, batch)


def test_refused_records_are_taken_in_again(spark, lake, tmp_path, monkeypatch):
    refused_without_rates(spark, lake)
    assert days(spark, lake) == {4: 2}  # no amount, so no rate is wanted
    history = str(tmp_path / "history")
    update_history(spark, lake, history)
    seen = []
    commit = generations.commit

    def watched(*args, **options):
        seen.append([sum(c.values()) for c in contents(spark, lake)])
        commit(*args, **options)
        seen.append([sum(c.values()) for c in contents(spark, lake)])

    with monkeypatch.context() as m:
        m.setattr(generations, "commit", watched)
        assert jobs.retake_refused(spark, lake, rates(spark)) == 4
    assert seen == [[2, 6], [6, 2]]  # at any time each record once
    assert days(spark, lake) == {1: 1, 2: 1, 3: 2, 4: 2}
    assert {r.reject_reason for r in sources.read_rejected(spark, lake).collect()} == {"malformed_message"}
    assert jobs.retake_refused(spark, lake, rates(spark)) == 0
    assert days(spark, lake) == {1: 1, 2: 1, 3: 2, 4: 2}
    counts = {r.batch: (r.accepted, r.refused) for r in manifests.batch_counts(spark, lake).collect()}
    assert counts == {"one": (3, 1), "two": (3, 1)}
    assert [d.day for d in update_history(spark, lake, history)] == [1, 2, 3]


def test_replay_after_taking_in_again(spark, lake):
    refused_without_rates(spark, lake)
    jobs.retake_refused(spark, lake, rates(spark))
    store(spark, lake, "one", raw(Day="3", User="8"))
    rows = sources.read_clean(spark, lake).collect()
    assert sorted((r.ds.day, r.user_id) for r in rows) == [(2, 0), (3, 7), (3, 8), (4, 0)]
    assert sources.read_rejected(spark, lake).count() == 1
    compact(spark, lake, least_files=1)
    store(spark, lake, "two")
    assert days(spark, lake) == {3: 1}
    assert sources.read_rejected(spark, lake).count() == 0


def test_a_retake_that_breaks_off_changes_nothing(spark, lake, monkeypatch):
    refused_without_rates(spark, lake)
    before = contents(spark, lake)
    with monkeypatch.context() as m:
        m.setattr(generations, "commit", lambda *args, **options: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            jobs.retake_refused(spark, lake, rates(spark))
    assert contents(spark, lake) == before
    compact(spark, lake, least_files=1)  # a later number does not make its folders count
    assert contents(spark, lake) == before
    assert jobs.retake_refused(spark, lake, rates(spark)) == 4
    assert days(spark, lake) == {1: 1, 2: 1, 3: 2, 4: 2}


def test_a_new_reason_is_kept(spark, lake):
    """Still refused, but for something else."""
    store_batch(messages(spark, [raw(Amount="$9999999999.00")]), spark.createDataFrame([], FX), lake, "one")
    huge = spark.createDataFrame([(START, "USD", Decimal("99999999999999"))], FX)
    assert [r.reject_reason for r in sources.read_rejected(spark, lake).collect()] == ["no_rate"]
    assert jobs.retake_refused(spark, lake, huge) == 0
    assert [r.reject_reason for r in sources.read_rejected(spark, lake).collect()] == ["amount_out_of_range"]
    assert jobs.retake_refused(spark, lake, rates(spark)) == 1
