import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import runs, sharding
from ledgerloom.llm.mixing import mix, mix_plan
from ledgerloom.llm.runs import numbered_copies
from ledgerloom.llm.sharding import bounds, ring, shard, shard_plan, walk
from tests.llm.data import STRANGE, nothing, plain, strange, words


def fill(sizes, weights, budget, repeats):
    """Shares by weight, what is over the most of a source given to the others, by bisection."""
    sources = sorted((s for s in sizes if s is not None), key=str)
    weight = {s: weights[i % len(weights)] for i, s in enumerate([*sources, *([None] if None in sizes else [])])}
    low, high = 0.0, 1e12
    for _ in range(200):
        level = (low + high) / 2
        if sum(min(repeats * n, weight[s] * level) for s, n in sizes.items()) < budget * sum(sizes.values()):
            low = level
        else:
            high = level
    return {s: min(repeats * n, weight[s] * low) for s, n in sizes.items()}


def check_plan(rows, longest_slack=1):
    sizes, taken, longest, copies = Counter(), Counter(), Counter(), defaultdict(set)
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.size * r.copies
        longest[r.source] = max(longest[r.source], r.size)
        if r.size:
            copies[r.source].add(r.copies)
    want = fill(dict(sizes), (3, 1, 2), 1.5, 2)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], rel=1e-9, abs=1e-6)
        assert 0 <= r.copies <= 2
    for source in sizes:
        assert abs(taken[source] - want[source]) <= longest_slack * max(longest.values()), source
        # a document comes a second time only when all others have come once
        assert max(copies[source], default=0) - min(copies[source], default=0) <= 1
    assert sum(taken.values()) <= 1.5 * sum(sizes.values())
    return taken


def corpus(spark):
    rng = random.Random(3)
    rows = [(i, words(i, rng.randrange(0, 60)), rng.choice(["a", "b", "c", "d", None, "é", "z"] + ["hot"] * 6)) for i in range(900)]
    rows += [(i, "one two", "tiny") for i in range(3)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)


def test_mix_of_a_corpus(spark):
    docs = corpus(spark)
    rows = mix_plan(docs).collect()
    assert len(rows) == docs.count()
    size = {r.doc_id: len(r.text.split()) for r in docs.where("not source <=> 'tiny'").collect()}
    assert all(r.size == size[r.doc_id] for r in rows if r.source != "tiny")
    check_plan(rows)
    assert plain(mix_plan(docs.repartition(2)).collect()) == plain(rows), "the mix doesn't depend on the partitions"
    mixed = Counter((r.doc_id, r.source) for r in mix(docs).collect())
    assert mixed == Counter({(r.doc_id, r.source): r.copies for r in rows if r.copies})


def test_queues_are_served_by_finish_time(spark):
    """The mix is a beginning of all queues in order of finish time."""
    docs = corpus(spark)
    plan = {(r.doc_id, r.source): r for r in mix_plan(docs).collect()}
    # with the budget raised, nothing that was taken goes
    more = {(r.doc_id, r.source): r for r in mix_plan(docs, budget=1.7).collect()}
    assert all(more[k].copies >= plan[k].copies for k in plan)


def test_strange_mix(spark):
    docs = strange(spark)
    rows = mix_plan(docs).collect()
    assert len(rows) == len(STRANGE)
    check_plan(rows, 2)
    spaced = re.compile("[^\x20\x09-\x0d]+")
    assert Counter(r.size for r in rows) == Counter(len(spaced.findall(r[1] or "")) for r in STRANGE)
    mixed = mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.copies for r in rows)
    assert set(plain(mixed.collect())) <= set(plain(docs.collect()))


def test_empty_mix(spark):
    assert mix_plan(nothing(spark)).count() == 0
    assert mix(nothing(spark)).count() == 0
    blank = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id long, text string, source string")
    assert {r.size * r.copies for r in mix_plan(blank).collect()} == {0}


@pytest.mark.parametrize("step", [3, 10_000])
def test_numbered_copies(spark, monkeypatch, step):
    monkeypatch.setattr(runs, "STEP", step)
    df = spark.createDataFrame([("a", 7), ("b", 0), ("c", 1), ("d", 3)], "x string, n long")
    got = sorted((r.x, r.k) for r in numbered_copies(df, "n", "k", 7).collect())
    assert got == [(x, k) for x, n in [("a", 7), ("c", 1), ("d", 3)] for k in range(n)]


def one_by_one(loads, owners, room):
    """The walk with every row on its own: shard by (arc, rank)."""
    taken, place = [0] * len(room), {}
    waiting = [(a, k) for a, n in enumerate(loads) for k in range(n)]
    on = 0
    while waiting:
        still = []
        for a, k in waiting:
            s = owners[(a + on) % len(owners)]
            if taken[s] < room[s]:
                place[a, k] = (s, taken[s])
                taken[s] += 1
            else:
                still.append((a, k))
        waiting, on = still, on + 1
    return place


@pytest.mark.parametrize("seed", range(5))
def test_walk_against_single_rows(seed):
    rng = random.Random(seed)
    owners = [rng.randrange(5) for _ in range(20)] + list(range(5))
    loads = [rng.choice([0, 1, 3, 50]) for _ in owners]
    room = bounds(sum(loads), 5, rng.choice([0, 0.1]))
    got = {}
    for arc, first, last, s, slot in walk(loads, owners, room):
        for k in range(first, last):
            assert (arc, k) not in got
            got[arc, k] = (s, slot + k - first)
    assert got == one_by_one(loads, owners, room)


def check_shards(rows, shards):
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts[s] for s in range(shards)) <= 1
    for s in counts:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))


def test_shards_of_a_corpus(spark):
    docs = corpus(spark)
    rows = shard_plan(docs).collect()
    assert len(rows) == docs.count()
    check_shards(rows, 24)
    text = {(r.doc_id, r.text) for r in docs.collect()}
    assert {(r.doc_id, r.size, r.text_crc32) for r in rows} == {(i, len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t in text}
    assert plain(shard_plan(docs.repartition(2)).collect()) == plain(rows)


def test_few_rows_move(spark):
    docs = corpus(spark).where("not source <=> 'tiny'")

    def moved(slack, shards):
        old = {r.doc_id: r.shard for r in shard_plan(docs, shards=shards, slack=slack).collect()}
        new = {r.doc_id: r.shard for r in shard_plan(docs, shards=shards + 1, slack=slack).collect()}
        return sum(old[i] != new[i] for i in old) / len(old)

    assert moved(0.25, 8) < 0.25
    assert moved(0.0, 8) < 0.45  # a modulus moves 8 of 9


def test_own_arc_first(spark):
    """Rows of arcs that fit stay with the shard of the next point."""
    points = ring(spark, 6, 32)
    docs = corpus(spark)
    rows = {r.doc_id: r.shard for r in shard_plan(docs, shards=6, nodes=32, slack=5.0).where("size > 30").collect()}
    at = docs.select("doc_id", F.xxhash64(F.lit(sharding.SEED), "doc_id", "text").alias("at")).collect()
    for row in at:
        if row.doc_id in rows and row.doc_id > 2:
            position = row.at % (1 << 64)
            owner = next((s for p, s in points if p >= position), points[0][1])
            assert rows[row.doc_id] == owner


@pytest.mark.parametrize("step", [2, 10_000])
def test_very_many_equal_rows(spark, monkeypatch, step):
    monkeypatch.setattr(runs, "STEP", step)
    docs = strange(spark).union(strange(spark).where("doc_id in (1, 4) or doc_id is null")).union(strange(spark).limit(0))
    docs = docs.union(strange(spark).where("doc_id = 1")).union(strange(spark).where("doc_id = 8"))
    placed = shard(docs, shards=3)
    rows = placed.collect()
    check_shards(rows, 3)
    assert plain(placed.drop("shard", "slot").collect()) == plain(docs.drop("shard", "slot").collect())
    mixed = mix(docs)
    assert mixed.count() == sum(r.copies for r in mix_plan(docs).collect())


def test_strange_shards(spark):
    docs = strange(spark)
    rows = shard_plan(docs, shards=5).collect()
    assert len(rows) == len(STRANGE)
    check_shards(rows, 5)
    placed = shard(docs, shards=5)
    assert placed.columns == [c for c in docs.columns if c not in ("shard", "slot")] + ["shard", "slot"]
    check_shards(placed.collect(), 5)
    assert plain(placed.drop("shard", "slot").collect()) == plain(docs.drop("shard", "slot").collect())
    assert shard(nothing(spark)).count() == 0


def test_sharding_is_native(spark):
    plan = shard_plan(corpus(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
