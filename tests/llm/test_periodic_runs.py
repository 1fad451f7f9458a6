import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import periodic_runs
from ledgerloom.llm.arrays import spread
from ledgerloom.llm.periodic_runs import collapse_runs, find_in_words, find_runs, scan_block
from ledgerloom.llm.queries import op12_periodic_runs
from tests.llm.data import STRANGE, nothing, plain, strange, words


def brute(own):
    """Every stretch that is the same at some lag; the smallest lag of each."""
    n, found = len(own), {}
    for lag in range(1, n):
        i = 0
        while i + lag < n:
            if own[i] == own[i + lag]:
                j = i
                while j + lag < n and own[j] == own[j + lag]:
                    j += 1
                if j + lag - i >= max(6, 4 * lag):
                    found.setdefault((i, j + lag), lag)
                i = j
            else:
                i += 1
    return sorted((a, b - a, lag) for (a, b), lag in found.items())


def left(own, runs):
    dropped = {i for start, length, period in runs for i in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(own) if i not in dropped)


def nested(rng, depth, letters):
    """Words with repeats of repeats."""
    if not depth:
        return [rng.randrange(letters) for _ in range(rng.randrange(1, 6))]
    out = []
    for _ in range(rng.randrange(1, 3)):
        part = nested(rng, depth - 1, letters)
        out += part * rng.choice([1, 1, 2, 4, 5, 6])
        if rng.random() < 0.3:
            out += part[: rng.randrange(len(part) + 1)]
    return out


def hashed(own):
    return spread(np.array([x + 1 for x in own], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def test_against_all_lags():
    rng, n_long = random.Random(1), 0
    for _ in range(400):
        own = nested(rng, rng.randrange(5), rng.choice([2, 3, 5, 50]))
        if rng.random() < 0.5:
            own = own * rng.choice([3, 4, 5]) + own[: rng.randrange(len(own) + 1)]
        own = own[:900]
        if own:
            want = brute(own)
            assert find_in_words(hashed(own), len(own)) == want
            n_long += sum(period >= periodic_runs.SHORT for _, _, period in want)
    assert n_long > 200  # the scales had work to do


@pytest.mark.parametrize("period", [1, 2, 3, 15, 16, 17, 31, 32, 33, 63, 64, 100, 257, 1000])
@pytest.mark.parametrize("extra", [-1, 0, 1])
def test_one_run_between_other_words(period, extra):
    """Long enough by a word, just long enough, one too short."""
    rng = random.Random(period)
    cycle = [rng.randrange(1 << 40) for _ in range(period)]
    length = max(6, 4 * period) + extra
    own = [rng.randrange(1 << 40) for _ in range(37)] + (cycle * (length // period + 1))[:length] + [rng.randrange(1 << 40) for _ in range(50)]
    assert find_in_words(hashed(own), len(own)) == ([(37, length, period)] if extra >= 0 else [])


def test_a_long_text_of_one_run_is_quick():
    """The work does not grow with the square of a run: few seeds, whatever the scale."""
    own = hashed(list(range(40)) * 10_000)
    seeds = []
    pairs = periodic_runs.equal_pairs

    def counted(*args):
        out = pairs(*args)
        seeds.append(len(out[0]))
        return out

    periodic_runs.equal_pairs = counted
    try:
        assert find_in_words(own, len(own)) == [(0, 400_000, 40)]
    finally:
        periodic_runs.equal_pairs = pairs
    assert sum(seeds) < len(own)


def test_texts_of_a_block_are_kept_apart():
    texts = ["a a a", "a a a", "x y x y x y x y", "", "q " * 7, "x y " * 40, "x y"]
    data = "".join(texts).encode()
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    for row, text in zip(scan_block(np.frombuffer(data, np.uint8), offsets), texts, strict=True):
        want = brute(text.split())
        assert [(r["start"], r["length"], r["period"]) for r in row["runs"]] == want
        assert row["collapsed"] == left(text.split(), want)


def test_strange_rows(spark):
    docs = strange(spark)
    found = find_runs(docs)
    assert found.columns == [*docs.columns, "periodic"]
    rows = found.collect()
    assert plain(found.drop("periodic").collect()) == plain(docs.collect())
    for row in rows:
        own = (row.text or "").split()
        assert row.periodic.n_words == len(own)
        if len(own) < 1000:  # the long ones are of random words
            assert [tuple(r) for r in row.periodic.runs] == brute(own)
        assert row.periodic.collapsed == left(own, [tuple(r) for r in row.periodic.runs])
    assert len(rows) == len(STRANGE)


def test_collapse(spark):
    docs = spark.createDataFrame(
        [(1, "say  no no no no no no\nmore", "x"), (2, None, "y"), (3, "ab cd " * 5, "z"), (4, "a b", None)],
        "doc_id long, text string, periodic string",
    )
    got = {r.doc_id: (r.text, r.periodic) for r in collapse_runs(docs).collect()}
    assert got == {1: ("say no more", "x"), 2: (None, "y"), 3: ("ab cd", "z"), 4: ("a b", None)}
    assert collapse_runs(docs).columns == docs.columns


def test_empty_table(spark):
    assert find_runs(nothing(spark)).count() == 0


def test_query_against_brute_force(spark, tmp_path):
    """The query with its planted repeats, over texts of up to 700 words."""
    rng = random.Random(3)
    texts = [None, "", " \t", "one"] + [words(i, rng.randrange(1, 700)) for i in range(300)]
    texts += [" ".join(map(str, nested(rng, 4, 4)[:400])) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "a " * 9)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in op12_periodic_runs(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    n_planted = 0
    for id_, text in rows:
        own = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(own), zlib.crc32(str(id_).encode()) if id_ is not None else 1
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            own = [own[i] if i < a else own[a + (i - a) % p] for i in range(n)]
            n_planted += 1
        runs, row = brute(own), got[id_]
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
        assert (row.n_runs, row.start, row.length, row.period) == (len(runs), *best)
        assert row.exponent_milli == (best[1] * 1000 // best[2] if runs else None)
        listed = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
        assert row.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(left(own, runs).encode()).hexdigest()
    assert n_planted > 20
