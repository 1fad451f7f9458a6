from itertools import product

import numpy as np
import pyarrow as pa
import pytest

from ledgerloom.llm import toxicity
from ledgerloom.llm.arrays import blocks
from ledgerloom.llm.sampling import held_out, labelled_sample
from ledgerloom.llm.toxicity import Crf, drop_toxic, marginals, row_edges, score_toxicity, train
from tests.llm.data import STRANGE, nothing, strange

SF_DIR = "/root/testdata/sf0.1"


def enumerated(emission, m):
    """Log-odds of each tag by summing over all taggings."""
    n = len(emission)
    total = np.zeros((n, 2))
    for tags in product((0, 1), repeat=n):
        score, before = 0.0, 0
        for i, tag in enumerate(tags):
            step = {(0, 0): 0.0, (0, 1): m.enter, (1, 0): m.leave, (1, 1): m.stay}[before, tag]
            score += (step if i or tag else 0.0) + tag * emission[i]
            before = tag
        for i, tag in enumerate(tags):
            total[i, tag] += np.exp(score)
    return np.log(total[:, 1] / total[:, 0])


@pytest.mark.parametrize("seed", range(6))
def test_marginals_against_enumeration(seed):
    rng = np.random.default_rng(seed)
    lengths = [1, 4, 7, 2, 1]
    row = np.repeat(np.arange(len(lengths)), lengths)
    emission = rng.normal(0, 2, len(row))
    m = Crf(enter=rng.normal(), leave=rng.normal(), stay=rng.normal(0, 2))
    got = marginals(emission, *row_edges(row), m)
    for r in range(len(lengths)):
        assert got[row == r] == pytest.approx(enumerated(emission[row == r], m), abs=1e-4)


def test_fit_uses_the_chain():
    """Tags that last, seen through noisy words: single words tell 70 % of the tags."""
    rng = np.random.default_rng(0)
    first, last = row_edges(np.repeat(np.arange(200), 50))
    labels = np.zeros(10_000, dtype=bool)
    for t in range(1, 10_000):
        labels[t] = False if first[t] else labels[t - 1] ^ (rng.random() < 0.08)
    seen = labels ^ (rng.random(10_000) < 0.3)
    places = np.where(seen, rng.integers(0, 25, 10_000), rng.integers(25, 50, 10_000))[None].astype(np.int32)
    m = toxicity.fit_crf(places, labels, first, last)
    found = marginals(m.bias + m.weights[places[0]].astype(float), first, last, m) > 0
    assert (found == labels).mean() > 0.8


@pytest.fixture(scope="module")
def trained(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    return docs, labels, train(docs, labels)


def test_held_out_rows(trained):
    """Measured: 85 of 97 toxic rows found (12 have no word that tells), 1 of 728 others flagged."""
    docs, labels, model = trained
    scored = score_toxicity(docs, model).join(labels, "doc_id").where(held_out()).collect()
    found = [r.toxicity.score >= 0.5 for r in scored if r.toxic == 1]
    wrong = [r.toxicity.score >= 0.5 for r in scored if r.toxic == 0]
    assert np.mean(found) > 0.8
    assert np.mean(wrong) < 0.01


def test_spans_are_words_of_the_text(trained):
    docs, _, model = trained
    for r in score_toxicity(docs.limit(500), model).collect():
        assert 0 <= r.toxicity.score <= 1
        end = 0
        for s in r.toxicity.spans:
            assert end <= s.start < s.end <= len(r.text)
            assert r.text[s.start : s.end].strip() == r.text[s.start : s.end]
            end = s.end


def test_repeated_words_count_once(trained, spark):
    _, _, model = trained
    docs = spark.createDataFrame([(1, "word"), (2, "word " * 1000)], "doc_id long, text string")
    a, b = (r.toxicity.score for r in score_toxicity(docs, model).orderBy("doc_id").collect())
    assert a == pytest.approx(b)


def test_spans_hold_repeated_words():
    texts = ["you idiot idiot Idiot!", "idiot", "idiot é idiot idiot", "calm calm calm", "", "idiot idiot"]
    ((data, offsets),) = blocks(pa.array(["idiot"], pa.large_string()))
    lowered, starts, ends, *_ = toxicity.tokens(data, offsets)
    model = Crf(bias=-5.0)
    model.weights[toxicity.token_features(lowered, starts, ends)] = 4
    found = [r for data, offsets in blocks(pa.array(texts, pa.large_string())) for r in toxicity.score_block(data, offsets, model)]
    assert [[t[s["start"] : s["end"]] for s in r["spans"]] for t, r in zip(texts, found)] == [
        ["idiot idiot Idiot"], ["idiot"], ["idiot", "idiot idiot"], [], [], ["idiot idiot"],
    ]


def test_strange_rows(trained, spark):
    _, _, model = trained
    docs = strange(spark)
    rows = score_toxicity(docs, model).collect()
    assert len(rows) == len(STRANGE)
    blank = {r.toxicity.score for r in rows if r.doc_id in (3, 4, 5, 6)}
    assert len(blank) == 1 and blank.pop() < 0.5
    kept = drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() > 10
    assert drop_toxic(nothing(spark), model).count() == 0


def test_without_labels(spark):
    docs = strange(spark)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert max(r.toxicity.score for r in score_toxicity(docs, train(docs, none)).collect()) < 1e-9
    one = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, toxic int")
    assert min(r.toxicity.score for r in score_toxicity(docs, train(docs, one)).collect()) > 1 - 1e-9
    few = spark.createDataFrame([(i, i % 2) for i in range(20)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    assert score_toxicity(docs, train(docs, few)).count() == len(STRANGE)


def test_sample_is_bounded_and_leaves_fold_0_out(spark):
    rows = [(i, f"text {i}", i % 2) for i in range(400)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] * 2, "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    sample = labelled_sample(docs, labels, "toxic", {0: 30, 1: 1000}, 8)
    out = {r.text for r in docs.where(held_out()).collect()}
    assert sum(y == 0 for _, y in sample) == 30
    assert not {t for t, _ in sample} & out and all(len(t) <= 8 for t, _ in sample)
    assert sample == labelled_sample(docs.repartition(7), labels, "toxic", {0: 30, 1: 1000}, 8)
