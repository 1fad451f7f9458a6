import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import resampling
from ledgerloom.llm.resampling import (
    crc_spans,
    feature_buckets,
    quickselect,
    resample,
    resampling_plan,
    sort_key,
)
from tests.llm.data import STRANGE, nothing, plain, strange, words


def features(text, longest):
    own = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())
    return own, [b" ".join(own[i : i + r]) for r in range(1, longest + 1) for i in range(len(own) - r + 1)]


def brute(rows, target, longest=1, buckets=10_000, seed=2024):
    """(n_words, n_features, weight, score) of each (id, text)."""
    s, t = Counter(), Counter()
    for counts, texts in ((s, [x for _, x in rows]), (t, target)):
        for text in texts:
            counts.update(zlib.crc32(f) % buckets for f in features(text, longest)[1])
    own, wanted = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (own + buckets) / ((s[b] + 1) * (wanted + buckets))))

    for id_, text in rows:
        own_words, found = features(text, longest)
        weight = sum(gain(zlib.crc32(f) % buckets) for f in found)
        h = int(hashlib.sha256(f"{seed}:{'' if id_ is None else id_}".encode()).hexdigest()[:8], 16)
        yield len(own_words), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))


TARGET = [words(1, 40), "dawn potion wizards", None, "", words(77, 30)]


def items(spark):
    return spark.createDataFrame([(t,) for t in TARGET], "text string")


def test_crc_of_spans():
    rng = random.Random(1)
    data = bytes(rng.randrange(256) for _ in range(5000))
    bounds = [(a := rng.randrange(5000), min(5000, a + rng.choice([0, 1, 3, 39, 40, 41, 900]))) for _ in range(300)]
    starts, ends = (np.array(x) for x in zip(*bounds))
    got = ~crc_spans(np.full(300, 0xFFFFFFFF, np.uint32), np.frombuffer(data, np.uint8), starts, ends)
    assert got.tolist() == [zlib.crc32(data[a:b]) for a, b in bounds]


@pytest.mark.parametrize("longest", [1, 3])
def test_features(longest):
    texts = ["a B c", "", "x", "one, two; Three four é文", "  ", "z" * 100 + " y"]
    data = "".join(texts).encode()
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    _, found = feature_buckets(np.frombuffer(data, np.uint8), offsets, longest, 997)
    got = sorted((r, b) for rows, buckets in found for r, b in zip(rows.tolist(), buckets.tolist()))
    assert got == sorted((i, zlib.crc32(f) % 997) for i, t in enumerate(texts) for f in features(t, longest)[1])


@pytest.mark.parametrize("longest,percent,least", [(1, 10, 20), (2, 50, 1), (1, 100, 0), (1, 0, 20)])
def test_strange_rows(spark, longest, percent, least):
    docs = strange(spark)
    options = {"longest_run": longest, "percent": percent, "least_words": least}
    plan = resampling_plan(docs, items(spark), **options).collect()
    want = list(brute([(r[0], r[1]) for r in STRANGE], TARGET, longest))
    got = sorted((str(r.doc_id), r.n_words, r.n_features, r.weight, r.score) for r in plan)
    assert got == sorted((str(row[0]), *w) for row, w in zip(STRANGE, want))
    fit = sum(w[0] >= least for w in want)
    drawn = sorted((r for r in plan if r.rank is not None), key=lambda r: r.rank)
    assert [r.rank for r in drawn] == list(range(1, fit * percent // 100 + 1))
    places = [(-r.score, r.doc_id is None, r.doc_id or 0, r.row_hash) for r in drawn]
    assert places == sorted(places)
    assert all(r.n_words >= least for r in drawn)
    worst = max(places, default=None)
    left = [(-r.score, r.doc_id is None, r.doc_id or 0, r.row_hash) for r in plan if r.rank is None and r.n_words >= least]
    assert worst is None or all(p >= worst for p in left)
    kept = resample(docs, items(spark), **options)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in drawn)
    assert set(plain(kept.collect())) <= set(plain(docs.collect()))


def test_copies_across_the_limit(spark):
    """A third of the rows are the same row; some of them are drawn."""
    rows = [(i, words(i, 30)) for i in range(60)] + [(1000, TARGET[0])] * 30
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    plan = resampling_plan(docs, items(spark), percent=20).collect()
    assert sorted(r.rank for r in plan if r.rank) == list(range(1, 19))
    hot = [r for r in plan if r.doc_id == 1000]
    assert len(hot) == 30 and len({r.score for r in hot}) == 1
    assert resample(docs, items(spark), percent=20).count() == 18
    by_rank = {r.rank: r.doc_id for r in plan if r.rank}
    want = sorted(((-w[3], i) for (i, _), w in zip(rows, brute(rows, TARGET))))[:18]
    assert [by_rank[k + 1] for k in range(18)] == [i for _, i in want]


def test_quickselect(spark, monkeypatch):
    """Small samples, so that many rounds are needed; hot keys; every rank."""
    monkeypatch.setattr(resampling, "SAMPLE", 8)
    rng = random.Random(7)
    rows = [(-rng.randrange(20), False, i, rng.randrange(5), rng.choice([1, 1, 1, 2, 400])) for i in range(300)]
    rows += [(-3, True, None, h, 2) for h in range(3)]
    keys = spark.createDataFrame(rows, "s long, none boolean, id long, hash long, copies long")
    keys = keys.select(F.struct("s", "none", "id", "hash").alias("place"), "copies").repartition(3).persist()
    flat = sorted(tuple(0 if v is None else v for v in r[:4]) for r in rows for _ in range(r[4]))
    for rank in (1, 2, len(flat) // 3, len(flat) // 2, len(flat) - 1, len(flat)):
        place, taken = quickselect(keys, rank, len(flat), len(rows))
        assert sort_key(place) == flat[rank - 1]
        assert taken == rank - flat.index(flat[rank - 1])
    keys.unpersist()


def test_empty_tables(spark):
    assert resampling_plan(nothing(spark), items(spark)).count() == 0
    assert resample(nothing(spark), items(spark)).columns == nothing(spark).columns
    docs = strange(spark)
    plan = resampling_plan(docs, items(spark).limit(0)).collect()
    want = list(brute([(r[0], r[1]) for r in STRANGE], []))
    assert sorted(r.score for r in plan) == sorted(w[3] for w in want)


def test_target_like_documents_are_drawn(spark):
    """Half of the documents share their words with the target: they are most of the sample."""
    other = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do".split()
    rows = [(i, words(i, 60) if i % 2 else words(i, 60, other)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    drawn = resample(docs, items(spark)).collect()
    assert len(drawn) == 40 and sum(r.doc_id % 2 for r in drawn) == 40
