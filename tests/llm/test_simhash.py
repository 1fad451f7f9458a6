import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerloom.llm import simhash
from ledgerloom.llm.components import components
from ledgerloom.llm.simhash import as_hex, fingerprint, keep_one_per_component, link_fingerprints, simhash_components
from tests.llm.data import STRANGE, nothing, strange, words


def brute_fingerprint(text, n=3):
    own = (text or "").encode().lower().split()
    grams = [own[i : i + n] for i in range(len(own) - n + 1)] if len(own) >= n else [own] if own else []
    hashes = [xxhash.xxh64_intdigest(b" ".join(g), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def smallest_reached(nodes, linked):
    label = {n: n for n in nodes}

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    nodes = list(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                x, y = sorted((top(a), top(b)))
                label[y] = x
    return {n: top(n) for n in nodes}


def test_fingerprints(spark):
    docs = strange(spark)
    got = docs.select("text", as_hex(fingerprint(F.col("text"))).alias("fp")).collect()
    assert len(got) == len(STRANGE)
    for row in got:
        assert row.fp == f"{brute_fingerprint(row.text):016x}"


def test_equals_spark_hash(spark):
    """One shingle: the fingerprint is its hash."""
    row = spark.sql("select 'ab cd' as text").select(fingerprint(F.col("text")).alias("fp"), F.xxhash64("text").alias("h")).first()
    assert row.fp == row.h


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 4])
def test_links_against_all_pairs(spark, radius):
    rng = random.Random(radius)
    points = {rng.getrandbits(64) for _ in range(12)} | {0, (1 << 64) - 1}
    for p in list(points):
        for _ in range(5):
            for _ in range(rng.randrange(1, 4)):
                p ^= 1 << rng.randrange(64)
            points.add(p)
    signed = [int(np.uint64(p).astype(np.int64)) for p in points]
    fps = spark.createDataFrame([(p,) for p in signed], "fp long")
    links = link_fingerprints(fps, radius)
    for row in links.collect():
        assert ((row.a ^ row.b) & ((1 << 64) - 1)).bit_count() <= radius
    want = smallest_reached(sorted(signed), lambda a, b: ((a ^ b) & ((1 << 64) - 1)).bit_count() <= radius)
    got = dict.fromkeys(signed) | {r.node: r.label for r in components(links).collect()}
    groups = {p: (p if got[p] is None else got[p]) for p in signed}
    assert groups == want


def test_components_of_chains_and_hubs(spark):
    rng = random.Random(5)
    ids = list(range(400))
    rng.shuffle(ids)
    links = list(zip(ids[:200], ids[1:200])) + [(ids[200], x) for x in ids[201:390]] + [(ids[395], ids[395]), (None, 3)]
    links += [links[0]] * 3
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {x: min(ids[:200]) for x in ids[:200]} | {x: min(ids[200:390]) for x in ids[200:390]}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_documents_against_all_pairs(spark):
    docs = strange(spark)
    rows = simhash_components(docs).collect()
    assert len(rows) == len(STRANGE)
    fps = {r.fp for r in rows}
    root = smallest_reached(sorted(fps), lambda a, b: ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2)
    for row in rows:
        ids = [r.doc_id for r in rows if root[r.fp] == root[row.fp] and r.doc_id is not None]
        assert row.component_id == (min(ids) if ids else None)
    # all texts without words are one group
    assert {r.component_id for r in rows if r.fp == 0} == {3}


def test_one_of_each_component_stays(spark):
    docs = strange(spark)
    kept = keep_one_per_component(docs)
    assert kept.columns == docs.columns
    rows = {(r.doc_id, r.root): r for r in simhash_components(docs).collect()}
    groups = {r.root for r in rows.values()}
    assert kept.count() == len(groups)
    assert {r.root for r in simhash_components(kept).collect()} == groups
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 2 and 2 not in ids and 4 not in ids and ids.count(None) == 2


def test_the_same_survivor_in_any_order(spark):
    """Rows with one id and text that differ in other columns: which one stays does not hang on their order."""
    rows = [(1, "a b c d", name, None) for name in "abcdef"] + [(2, "a b c d", "g", "x"), (None, "a b c d", "h", None)]
    kept = []
    for seed in range(5):
        random.Random(seed).shuffle(rows)
        docs = spark.createDataFrame(rows, "doc_id long, text string, _key string, row_hash string").repartition(seed + 1)
        kept.append([tuple(r) for r in keep_one_per_component(docs).collect()])
    assert len(kept[0]) == 1 and kept[0][0][0] == 1 and all(k == kept[0] for k in kept)


def test_variants_are_spread_over_tasks(spark, monkeypatch):
    fps = spark.range(2000).select(F.xxhash64("id").alias("fp")).coalesce(1)
    monkeypatch.setattr(simhash, "ROWS_PER_TASK", 10_000)
    assert simhash.split_count(fps, 65) == 13
    text = link_fingerprints(fps, 2)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(fp" in text and ", 13)" in text


def test_near_copies_fall_together(spark):
    text = words(3, 4000)
    docs = spark.createDataFrame([(5, text), (2, text + " end"), (9, words(4, 4000)), (1, words(5, 4000))], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash_components(docs, max_bits=6).collect()}
    assert got == {5: 2, 2: 2, 9: 9, 1: 1}


def test_empty_table(spark):
    assert simhash_components(nothing(spark)).count() == 0
    assert keep_one_per_component(nothing(spark)).count() == 0
