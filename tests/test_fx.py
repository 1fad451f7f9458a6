import bisect
import random
from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import fx
from ledgerloom.schema import FX
from ledgerloom.sources import read_rates_json

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def rates_frame(spark, rates):
    return spark.createDataFrame([(t, "USD", Decimal(r)) for t, r in rates], FX)


def brute(rates, time):
    """Last rate at or before ``time``; of two at one instant the larger."""
    best = {}
    for t, r in rates:
        best[t] = max(best.get(t, r), r)
    starts = sorted(best)
    i = bisect.bisect_right(starts, time)
    return best[starts[i - 1]] if i else None


def irregular(seed, n):
    """Bursts of rates, long silences and repeated instants."""
    rng = random.Random(seed)
    time, out = START, []
    for _ in range(n):
        time += timedelta(microseconds=rng.choice([0, 1, 1000, 10**6, 3600 * 10**6, 40 * 86400 * 10**6]))
        out.append((time, rng.randrange(20_000, 30_000)))
    return out


def times_around(rates, seed):
    rng = random.Random(seed)
    out = [START - timedelta(days=1), rates[-1][0] + timedelta(days=400)]
    for t, _ in rates:
        out += [t, t - timedelta(microseconds=1), t + timedelta(microseconds=1)]
    span = (rates[-1][0] - START) // timedelta(microseconds=1)
    out += [START + timedelta(microseconds=rng.randrange(span + 1)) for _ in range(200)]
    return out


@pytest.mark.parametrize("shuffled", [False, True])
@pytest.mark.parametrize(
    "n, buckets, depth", [(1, 50_000, 1), (2, 50_000, 1), (60, 50_000, 1), (60, 50_000, 64), (60, 3, 1), (60, 1, 1), (60, 7, 2)]
)
def test_rate_as_of(spark, monkeypatch, shuffled, n, buckets, depth):
    monkeypatch.setattr(fx, "MAX_BUCKETS", buckets)
    monkeypatch.setattr(fx, "LEAST_DEPTH", depth)
    if shuffled:
        monkeypatch.setattr(fx, "MAX_BROADCAST_RATES", 0)
    rates = irregular(n, n)
    times = times_around(rates, n)
    # Equal records are kept apart by nothing, and all must come back.
    records = spark.createDataFrame([(i, t) for i, t in enumerate(times + times[:50])], "i int, at timestamp")
    got = fx.with_rate(records, rates_frame(spark, rates), "at")
    assert got.columns == ["i", "at", "vnd_per_usd"]
    rows = got.collect()
    assert len(rows) == len(times) + 50
    found = {r.i: r.vnd_per_usd for r in rows}
    for i, t in enumerate(times):
        assert found[i] == brute(rates, t), (i, t)


def test_lookup_stays_small(spark):
    rates = irregular(3, 200)
    distinct = fx.distinct_rates(rates_frame(spark, rates))
    buckets = fx.Buckets.over(distinct)
    assert fx.rates_by_bucket(distinct, buckets).count() <= buckets.rates + buckets.count


@pytest.mark.parametrize("shuffled", [False, True])
def test_bounds_cut_the_rates_evenly(spark, monkeypatch, shuffled):
    monkeypatch.setattr(fx, "LEAST_DEPTH", 8)
    if shuffled:
        monkeypatch.setattr(fx, "MAX_BROADCAST_RATES", 0)
    distinct = fx.distinct_rates(rates_frame(spark, irregular(4, 300)))
    times = sorted(r.effective_from for r in distinct.collect())
    buckets = fx.Buckets.over(distinct)
    assert (buckets.rates, buckets.depth, buckets.count) == (len(times), 8, -(-len(times) // 8))
    rows = sorted(fx.rates_by_bucket(distinct, buckets).collect())
    assert [len(r.times) for r in rows[:-1]] == [8] * (len(rows) - 1)
    assert [us for r in rows for us in r.times] == [round(t.timestamp() * 1_000_000) for t in (t.replace(tzinfo=timezone.utc) for t in times)]


@pytest.mark.parametrize("most", [1, 2, 3, 7, 8, 9, 100])
def test_binary_search(spark, most):
    times = list(range(0, 2 * most, 2))
    df = spark.range(-1, 2 * most + 2).withColumn("times", F.array(*map(F.lit, times)))
    for row in df.select("id", fx.at_or_before(F.col("times"), F.col("id"), most).alias("n")).collect():
        assert row.n == bisect.bisect_right(times, row.id)


@pytest.mark.parametrize("shuffled", [False, True])
def test_a_burst_of_rates_after_quiet_years(spark, monkeypatch, shuffled):
    """Ten years without a change, then a million rates within an hour: no row of the lookup is long."""
    if not shuffled:
        monkeypatch.setattr(fx, "MAX_BROADCAST_RATES", 2_000_000)
    n, burst = 1_000_000, START + timedelta(days=3650)
    start_us = int(burst.timestamp() * 1_000_000)
    rates = spark.range(n).select(
        F.timestamp_micros(F.lit(start_us) + F.col("id") * 3600).alias("effective_from"),
        F.lit("USD").alias("currency"),
        (20_000 + F.col("id") % 7919).cast("decimal(18,4)").alias("vnd_per_usd"),
    ).union(rates_frame(spark, [(START, 15_000)]))
    distinct = fx.distinct_rates(rates)
    buckets = fx.Buckets.over(distinct)
    assert buckets.rates == n + 1 and buckets.depth == 64
    sizes = fx.rates_by_bucket(distinct, buckets).agg(F.max(F.size("times")), F.count("*")).first()
    assert tuple(sizes) == (64, -(-(n + 1) // 64))
    rng = random.Random(1)
    times = [(i, rng.randrange(-10_000_000, 3_700_000_000)) for i in range(2000)]
    records = spark.createDataFrame(times, "i int, us long").withColumn("at", F.timestamp_micros(F.lit(start_us) + F.col("us")))
    found = {r.i: r.vnd_per_usd for r in fx.with_rate(records, rates, "at").collect()}
    for i, us in times:
        assert found[i] == (15_000 if us < 0 else 20_000 + min(us // 3600, n - 1) % 7919)


def test_large_rate_tables_are_not_broadcast(spark, monkeypatch):
    records = spark.createDataFrame([(1, START)], "i int, at timestamp")
    rates = rates_frame(spark, irregular(5, 20))
    small = fx.with_rate(records, rates, "at")._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint=(strategy=broadcast)" in small
    monkeypatch.setattr(fx, "MAX_BROADCAST_RATES", 0)
    large = fx.with_rate(records, rates, "at")._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in large


def test_one_instant_needs_no_join(spark):
    rates = irregular(8, 30)
    records = spark.createDataFrame([(1,), (2,)], "i int")
    for time in times_around(rates, 8)[:40]:
        got = fx.with_one_rate(records, rates_frame(spark, rates), F.lit(time))
        assert {r.vnd_per_usd for r in got.collect()} == {brute(rates, time)}
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert fx.with_one_rate(records, rates_frame(spark, []), F.lit(START)).first().vnd_per_usd is None


def test_no_rates_and_other_currencies(spark):
    records = spark.createDataFrame([(1, START)], "i int, at timestamp")
    other = spark.createDataFrame(
        [(START, "EUR", Decimal(27000)), (START, "USD", None), (None, "USD", Decimal(1))], FX
    )
    for rates in (rates_frame(spark, []), other):
        assert fx.with_rate(records, rates, "at").first().vnd_per_usd is None


def test_conversion_on_both_sides_of_a_change(spark):
    change = START + timedelta(hours=12)
    rates = rates_frame(spark, [(START, 24000), (change, 25000)])
    df = spark.createDataFrame(
        [(1, change - timedelta(seconds=1)), (2, change), (3, START - timedelta(seconds=1))],
        "i int, at timestamp",
    ).withColumn("amount_usd", F.lit("10.00").cast("decimal(12,2)"))
    got = {r.i: r.amount_vnd for r in fx.with_amount_vnd(df, rates, "at").collect()}
    assert got == {1: 240000, 2: 250000, 3: None}


def test_rates_from_json(spark, tmp_path):
    (tmp_path / "lines").mkdir()
    (tmp_path / "files").mkdir()
    (tmp_path / "lines" / "a.json").write_text(
        '{"date": "2024-01-01", "usd": {"vnd": 24000.5, "eur": 0.9}}\n'
        '{"date": "2024-01-02", "usd": {"vnd": 24001.12345}}\n{bad\n{"date": "2024-01-03"}\n'
    )
    (tmp_path / "files" / "a.json").write_text('{\n "date": "2024-01-01",\n "usd": {"vnd": 25380}\n}\n')
    lines = read_rates_json(spark, str(tmp_path / "lines"))
    assert lines.schema.simpleString() == FX.simpleString()
    assert sorted(str(r.vnd_per_usd) for r in lines.collect()) == ["24000.5000", "24001.1235"]
    (row,) = read_rates_json(spark, str(tmp_path / "files"), whole_files=True).collect()
    assert row.vnd_per_usd == 25380 and row.currency == "USD"
