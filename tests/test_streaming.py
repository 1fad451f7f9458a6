import json
import shutil
from collections import Counter
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

import pytest

from ledgerloom import jobs, sources
from ledgerloom.operators.clean import accepted, clean_raw, parse_messages
from ledgerloom.plans import report
from ledgerloom.schema import FX
from ledgerloom.streaming.ingest import store_batch
from tests.data import as_set
from tests.test_ingest import START, messages, raw


@pytest.fixture
def world(spark, tmp_path):
    return World(spark, tmp_path)


class World:
    """A folder of archived messages, a lake and a checkpoint."""

    def __init__(self, spark, path):
        self.spark = spark
        self.inbox, self.lake = str(path / "in"), str(path / "lake")
        self.checkpoint = str(path / "checkpoint")
        self.rate = 25000

    def send(self, rows, at=START):
        messages(self.spark, rows, at).coalesce(1).write.mode("append").parquet(self.inbox)

    def rates(self, spark):
        return spark.createDataFrame([(START, "USD", Decimal(self.rate))], FX)

    def run(self, fmt="parquet", inbox=None):
        stream = sources.read_message_stream(
            self.spark, fmt, inbox or self.inbox, {"maxFilesPerTrigger": "1"}
        )
        query = jobs.ingest_stream(
            stream, self.rates, self.lake, self.checkpoint, {"availableNow": True}
        )
        query.awaitTermination()
        return query

    def clean(self):
        return sources.read_clean(self.spark, self.lake)


def test_batches_are_appended_and_resumed(world):
    world.send([raw(), raw(Day="2")])
    world.send([raw(Day="3"), "{bad"])
    first = world.run()
    assert world.clean().count() == 3
    world.send([raw(Day="4")])
    second = world.run()
    assert str(first.id) == str(second.id)
    assert world.clean().count() == 4
    world.run()
    assert world.clean().count() == 4
    assert sources.read_rejected(world.spark, world.lake).count() == 1


def test_replayed_batch_adds_nothing(world, tmp_path):
    """The last batch was stored, but its commit was lost."""
    world.send([raw(), raw(), raw(Day="2"), "{bad"])
    world.send([raw(Day="3")])
    world.run()
    before = as_set(world.clean().drop("processed_at").collect())
    commits = sorted((tmp_path / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    for lost in (commits[-1], commits[-1].with_name(f".{commits[-1].name}.crc")):
        if lost.exists():
            shutil.move(lost, tmp_path / lost.name.lstrip("."))
    world.run()
    assert commits[-1].exists(), "the batch ran again"
    assert as_set(world.clean().drop("processed_at").collect()) == before
    assert sources.read_rejected(world.spark, world.lake).count() == 1


def test_replayed_batch_after_new_rates(world, tmp_path):
    """A rate came between the attempt that was lost and the replay: records change sides."""
    world.rates = lambda spark: spark.createDataFrame([], FX)
    world.send([raw(), raw(Day="2"), "{bad"])
    world.run()
    assert (world.clean().count(), sources.read_rejected(world.spark, world.lake).count()) == (0, 3)
    for lost in (tmp_path / "checkpoint" / "commits").glob("*0*"):
        shutil.move(lost, tmp_path / lost.name.lstrip("."))
    world.rates = lambda spark: spark.createDataFrame([(START, "USD", Decimal(25000))], FX)
    world.run()
    assert (world.clean().count(), sources.read_rejected(world.spark, world.lake).count()) == (2, 1)


def test_late_rows_reach_their_own_day(world):
    world.send([raw(Day="5"), raw(Day="5")])
    world.run()
    world.send([raw(Day="1"), raw(Day="6")])
    world.run()
    counts = Counter(r.ds for r in world.clean().collect())
    assert counts == {date(2002, 9, 5): 2, date(2002, 9, 1): 1, date(2002, 9, 6): 1}
    summary = {r.ds: r.total_transactions for r in report(world.clean(), "daily_summary").collect()}
    assert summary == dict(counts)


def test_stream_equals_batch(world):
    rows = [raw(Day=str(d), User=str(d % 3), Amount=f"${d}.55") for d in range(1, 20)] + [raw()] * 3
    world.send(rows)
    world.run()
    batch = accepted(clean_raw(parse_messages(messages(world.spark, rows)), world.rates(world.spark)))
    assert as_set(world.clean().drop("processed_at").collect()) == as_set(
        batch.drop("processed_at").collect()
    )


def test_rate_follows_the_time_of_ingest(world):
    """A new rate is seen by later batches and changes no earlier record."""
    world.send([raw(Amount="$1.00", Day="1")], START + timedelta(hours=1))
    world.run()
    change = START + timedelta(hours=2)
    world.rates = lambda spark: spark.createDataFrame(
        [(START, "USD", Decimal(25000)), (change, "USD", Decimal(26000))], FX
    )
    world.send([raw(Amount="$1.00", Day="2")], change)
    world.send([raw(Amount="$1.00", Day="3")], change - timedelta(seconds=1))
    world.run()
    amounts = {r.ds.day: r.amount_vnd for r in world.clean().collect()}
    assert amounts == {1: 25000, 2: 26000, 3: 25000}


def test_text_source(world, tmp_path):
    inbox = tmp_path / "text"
    inbox.mkdir()
    (inbox / "a.txt").write_text(json.dumps(raw()) + "\n" + json.dumps(raw(Day="2")) + "\n")
    world.run("text", str(inbox))
    assert world.clean().count() == 2


def test_empty_batch_writes_nothing(world, tmp_path):
    store_batch(messages(world.spark, []), world.rates(world.spark), world.lake, "x")
    assert not (tmp_path / "lake").exists()


def test_two_queries_do_not_overwrite_each_other(world, tmp_path):
    world.send([raw()])
    world.run()
    world.checkpoint = str(tmp_path / "second")
    world.inbox = str(tmp_path / "other")
    world.send([raw()])
    world.run()
    assert world.clean().count() == 2
