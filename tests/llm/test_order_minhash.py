import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm.order_minhash import (
    as_text,
    edit_report,
    edited,
    fingerprint,
    fingerprint_docs,
    kmers,
    likeness,
    likeness_of,
    signature,
    with_next,
)
from tests.llm.data import STRANGE, nothing, plain, strange, words


def like(a, b, **options):
    return float(likeness_of(signature(a.encode(), **options), signature(b.encode(), **options)))


@pytest.mark.parametrize("size", [1, 3, 8, 9, 12, 16])
def test_kmers_are_equal_when_their_bytes_are(size):
    rng = random.Random(size)
    text = bytes(rng.choice(b"ab") for _ in range(400))
    hashes = kmers(text, size).tolist()
    runs = [text[i : i + size] for i in range(len(text) - size + 1)]
    assert len(hashes) == len(runs)
    assert len(set(zip(hashes, runs))) == len(set(hashes)) == len(set(runs))
    assert len(kmers(b"ab", 8)) == 1 and kmers(b"ab", 8)[0] != kmers(b"ab\0", 8)[0]
    assert len(kmers(b"", size)) == 0


def plain_signature(text, size, picked, cells):
    """The definition by dictionaries; the order of numbered k-mers is the library's own."""
    hashes = kmers(text, size).tolist()
    low = (1 << len(hashes).bit_length()) - 1
    mask, seen, numbered = (1 << 64) - 1, {}, []

    def mix(x):
        x &= mask
        x = ((x ^ (x >> 32)) * 0xD6E8FEB86659FD93) & mask
        return x ^ (x >> 29)

    for at, h in enumerate(hashes):
        high = h & ~low
        occurrence = seen[high] = seen.get(high, -1) + 1
        order = mix(high * 0xC2B2AE3D27D4EB4F + occurrence * 0x9E3779B97F4A7C15)
        numbered.append((mix(order * 0x9E3779B97F4A7C15) & ~low | at, at))
    out = []
    for cell in range(cells):
        mine = sorted(k for k in numbered if k[0] * cells >> 64 == cell)[:picked]
        places = sorted(at for _, at in mine)
        t = 0
        for column in range(picked):
            t = mix(t * 0x9E3779B97F4A7C15 + (hashes[places[column]] if column < len(places) else 0) + column)
        out.append(max(t >> 48, 1) if mine else 0)
    return out


@pytest.mark.parametrize("size,picked,cells", [(8, 2, 64), (3, 1, 16), (12, 3, 4), (8, 2, 1)])
def test_signature_by_definition(size, picked, cells):
    for text in ("", "a", "abc" * 30, words(1, 60), words(2, 300), "aaaaaaaaaaaaaaaaaaaaaa"):
        assert signature(text.encode(), size, picked, cells).tolist() == plain_signature(text.encode(), size, picked, cells)


def test_likeness_follows_edits_and_order():
    text, other = words(5, 2000), " ".join(f"w{i}" for i in range(1500))
    assert like(text, text) == 1
    assert like(text, other) < 0.1
    shares = [like(other, " ".join(f"x{i}" if i < n else f"w{i}" for i in range(1500))) for n in (0, 150, 500, 1000, 1500)]
    assert shares == sorted(shares, reverse=True) and shares[1] > 0.5
    # the same k-mers in another order: plain MinHash sees hardly any difference
    parts = [other[i : i + 300] for i in range(0, len(other), 300)]
    moved = "".join(parts[len(parts) // 2 :] + parts[: len(parts) // 2])
    assert like(other, moved, picked=1) > 0.85
    assert like(other, moved) < 0.75
    # repeats count: k-mers are numbered
    assert like("abcdefghij" * 4, "abcdefghij" * 40) < 1


def test_defined_results(spark):
    docs = strange(spark)
    found = fingerprint_docs(docs)
    assert found.columns == [*docs.columns, "fingerprint"]
    assert plain(found.drop("fingerprint").collect()) == plain(docs.collect())
    for row in found.collect():
        assert row.fingerprint == as_text(signature((row.text or "").encode()))
        assert len(row.fingerprint) == 256
    assert {r.fingerprint for r in found.where("text is null or text = ''").collect()} == {"0" * 256}
    rows = [("a" * 30, "a" * 30), ("", ""), ("", "b"), (None, "c")]
    pairs = spark.createDataFrame(rows, "a string, b string")
    marks = pairs.select(likeness(F.when(F.col("a").isNotNull(), fingerprint(F.col("a"))), fingerprint(F.col("b"))).alias("x"))
    assert [r.x for r in marks.collect()] == [1.0, 1.0, 0.0, None]


def check(rows, got):
    """Each row against the one after it, by descending id, null last, then the hash of the text."""
    assert len(got) == len(rows)
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[2]))
    want = []
    for (id_, text, _), (_, after, _) in zip(ordered, [*ordered[1:], *ordered[:1]]):
        text, after = text or "", after or ""
        cut = len(text) // 3
        new = text[: len(text) - cut] + after[:cut]
        a, b, c = (signature(t.encode()) for t in (text, new, after))
        want.append((id_, len(text), hashlib.sha256(new.encode()).hexdigest(), as_text(a), as_text(b), float(likeness_of(a, b)), float(likeness_of(a, c))))
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got)


def with_hash(spark, df):
    return [tuple(r) for r in df.select("doc_id", "text", F.xxhash64("text")).collect()]


def test_report_of_strange_rows(spark):
    docs = strange(spark)
    check(with_hash(spark, docs), edit_report(docs).collect())


def test_report_over_many_ranges(spark):
    """More ranges than rows in some, a third of the rows without an id, all the same."""
    rows = [(i * 7 % 501, words(i, i % 40)) for i in range(300)] + [(None, "the same")] * 150
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for n in ("1", "23"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            check(with_hash(spark, docs), edit_report(docs).collect())
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_small_tables(spark):
    assert edit_report(nothing(spark)).count() == 0
    one = spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")
    (row,) = edit_report(one).collect()
    assert row.near_next == 1 and row.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()
    assert edited("abcdefg", "x") == "abcdex" and edited("ab", "xyz") == "ab"


def test_any_pair_function(spark):
    docs = spark.createDataFrame([("b", "2"), ("a", "1"), ("c", "3")], "name string, body string")
    got = with_next(docs, lambda doc, after: {"pair": doc.text + after.text}, "pair string", "name", "body").collect()
    assert sorted(tuple(r) for r in got) == [("a", "13"), ("b", "21"), ("c", "32")]


def test_numbers_are_numpy_free():
    assert isinstance(like("a", "a"), float) and np.allclose(like("", ""), 1.0)
