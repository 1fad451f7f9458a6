import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm.sampling import held_out
from ledgerloom.llm.queries import op9_site_quality
from ledgerloom.llm.site_quality import STRENGTH, page_text, site_quality, strength, with_site
from tests.llm.data import STRANGE, nothing, strange, words

SF_DIR = "/root/testdata/sf0.01"


def test_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rows = site_quality(docs, labels).join(labels, "doc_id").where(held_out()).collect()
    assert len(rows) > 50
    assert sum(r.kept == (r.quality == 1) for r in rows) / len(rows) > 0.97
    assert all(r.kept for r in rows if r.quality == 1), "good documents stay"


def sites(spark):
    """A good and a bad host, the bad one with a good path, and a host with one bad document."""
    good = [f"{a}{b}{c}" for a in "bcdf" for b in "aeiou" for c in "lmnrst"]
    rows = [(i, words(i, 90, good), "good", "a") for i in range(60)]
    rows += [(100 + i, words(i, 90, [w + "#$%" for w in good]), "bad", "a") for i in range(60)]
    rows += [(200 + i, words(i, 90, good), "bad", "b") for i in range(30)]
    rows += [(300, words(1, 90, [w + "#$%" for w in good]), "rare", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    return docs, docs.select("doc_id", (~F.col("text").contains("#")).cast("int").alias("quality"))


def test_sparse_sites_are_shrunk(spark):
    docs, labels = sites(spark)
    rows = site_quality(docs, labels).collect()
    by_host = {r.host: r.host_rate for r in rows}
    by_path = {(r.host, r.path): r.path_rate for r in rows}
    mean = 90 / 151
    assert by_host["good"] > 0.9 and by_host["bad"] < 0.4
    assert 0.1 < by_host["rare"] < mean, "one document says little about its host"
    assert by_path["bad", "b"] > 0.8 and by_path["bad", "a"] < 0.2
    assert all(r.kept == (r.doc_id < 100 or 200 <= r.doc_id < 300) for r in rows)


def test_strength_by_moments(spark):
    same = spark.createDataFrame([(100, 50.0)] * 50, "n long, good double")
    apart = spark.createDataFrame([(100, 5.0), (100, 95.0)] * 25, "n long, good double")
    assert strength(same, F.lit(0.5)) == 1000.0
    assert strength(apart, F.lit(0.5)) < 2
    assert strength(apart.limit(0), F.lit(0.5)) == 1000.0


def test_strange_rows(spark):
    docs = strange(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)] + [(None, 1), (2, None)], "doc_id long, quality int")
    rows = site_quality(docs, labels).collect()
    assert len(rows) == len(STRANGE)
    assert all(0 <= r.score <= 1 and r.kept is not None for r in rows)
    neutral = site_quality(docs, labels.limit(0)).collect()
    assert {round(r.score, 9) for r in neutral} == {0.5}
    assert site_quality(nothing(spark), labels).count() == 0


def test_hosts_are_null_safe(spark):
    docs, labels = sites(spark)
    docs = docs.withColumn("source", F.when(F.col("source") != "good", F.col("source")))
    rows = [r for r in site_quality(docs, labels).collect() if r.host is None]
    assert len(rows) == 60
    assert rows[0].host_rate == pytest.approx(rows[-1].host_rate) and rows[0].host_rate > 0.9


def test_addresses(spark):
    urls = [
        ("http://A.example.com/fr/825?page=2&ref=x", "a.example.com", "fr"),
        ("https://m.example.net/en/25#top", "m.example.net", "en"),
        ("https://x.example.org/one/two/three/", "x.example.org", "one"),
        ("http://x.example.org/page.html", "x.example.org", ""),
        ("http://x.example.org", "x.example.org", ""),
        ("no address", None, None),
        (None, None, None),
    ]
    rows = with_site(spark.createDataFrame([(u,) for u, *_ in urls], "url string"), "url").collect()
    assert [(r.url, r.host) for r in rows] == [(u, h) for u, h, _ in urls]
    assert [r.path for r in rows][:5] == [p for *_, p in urls][:5]
    deep = with_site(spark.createDataFrame([urls[2][:1]], "url string"), "url", levels=2).first()
    assert deep.path == "one/two"


def test_text_of_a_page(spark):
    html = "<html><style>p{x}</style><SCRIPT>var t='</p>';\ntrack(0)</SCRIPT><!-- ad\n0 --><p>One <b>two</b></p><li>three</li></html>"
    row = spark.createDataFrame([(html,), (None,)], "html string").select(page_text(F.col("html")).alias("t")).collect()
    assert row[0].t.split() == ["One", "two", "three"] and row[1].t is None


def plain_posteriors(rows):
    """Rates and scores by loops over documents, from each one's evidence: (host, path, evidence)."""
    p = [1 / (1 + math.exp(-e)) for *_, e in rows]
    hosts, paths = defaultdict(list), defaultdict(list)
    for (host, path, _), share in zip(rows, p):
        hosts[host].append(share)
        paths[host, path].append(share)
    overall = sum(p) / len(p)

    def weight(sites, parent):
        excess = n_docs = 0
        for site, shares in sites.items():
            m = min(max(parent(site), 1e-6), 1 - 1e-6)
            excess += len(shares) * (sum(shares) / len(shares) - m) ** 2 / (m * (1 - m))
            n_docs += len(shares)
        if n_docs <= len(sites):
            return STRENGTH[1]
        r = (excess - len(sites)) / (n_docs - len(sites))
        return min(max(1 / r - 1, STRENGTH[0]), STRENGTH[1]) if r > 0 else STRENGTH[1]

    w = weight(hosts, lambda _: overall)
    host_rate = {h: (sum(x) + w * overall) / (len(x) + w) for h, x in hosts.items()}
    v = weight(paths, lambda site: host_rate[site[0]])
    for (host, path, e), share in zip(rows, p):
        x, parent = paths[host, path], host_rate[host]
        rate = min(max((sum(x) - share + v * parent) / (len(x) - 1 + v), 1e-6), 1 - 1e-6)
        yield parent, (sum(x) + v * parent) / (len(x) + v), 1 / (1 + math.exp(-(e + math.log(rate / (1 - rate)))))


def test_posteriors_against_loops(spark):
    """Many hosts of one document, some large ones with paths that differ, null hosts and paths."""
    rng = random.Random(2)
    good = [f"{a}{b}{c}" for a in "bcdf" for b in "aeiou" for c in "lmnrst"]
    rows = []
    for i in range(500):
        host = rng.choice([f"one{i}", f"one{i}", "big", "bad", None])
        path = rng.choice(["a", "b", None])
        junk = rng.random() < {"bad": 0.9, "big": 0.1 if path == "a" else 0.5}.get(host, 0.3)
        rows.append((i, words(i, rng.randrange(5, 90), [w + "#$%" * junk for w in good]), host, path, int(not junk)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, host string, path string, quality int")
    got = site_quality(docs.drop("quality"), docs.select("doc_id", "quality"), host_column="host", path_column="path").collect()
    want = list(plain_posteriors([(r.host, r.path, r.evidence) for r in got]))
    assert len(got) == 500 and len({r.host for r in got}) > 150
    for row, (host_rate, path_rate, score) in zip(got, want, strict=True):
        assert (row.host_rate, row.path_rate, row.score) == pytest.approx((host_rate, path_rate, score), rel=1e-6)


def test_query_has_documents_and_pages(spark):
    rows = op9_site_quality(spark, SF_DIR).collect()
    n = {kind: sum(r.kind == kind for r in rows) for kind in ("document", "page")}
    assert n == {"document": 1000, "page": 250}
    assert all((r.doc_id is None) == (r.kind == "page") == (r.page_id is not None) for r in rows)
    hosts = {r.host for r in rows if r.kind == "page"}
    assert len(hosts) == 58 and all("." in h for h in hosts) and {r.path for r in rows if r.kind == "page"} == {"de", "en", "es", "fr"}
