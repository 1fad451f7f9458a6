import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import language_id
from ledgerloom.llm.language_id import UNKNOWN, family_of, fit, fit_machine, identify, train
from ledgerloom.llm.sampling import held_out
from tests.llm.data import STRANGE, nothing, plain, strange

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def trained(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang")
    return docs, train(docs)


def test_held_out_rows(trained):
    docs, model = trained
    rows = identify(docs.drop("lang"), model).join(docs.select("doc_id", "lang"), "doc_id").where(held_out()).collect()
    assert np.mean([r.language.lang == r.lang for r in rows]) > 0.98
    assert all(family_of(r.language.lang) == r.language.family for r in rows)
    assert all(0 <= r.language.score <= 1 for r in rows)


def test_families_first(trained):
    _, model = trained
    assert model.root.machines.names == ["de", "es"]  # each family by its first language
    assert {n: b.machines.names for n, b in model.root.below.items()} == {"de": ["de", "en"], "es": ["es", "fr"]}


def weights(node):
    yield node.machines.weights
    for below in node.below.values():
        if not isinstance(below, str):
            yield from weights(below)


def test_training_is_repeatable(trained):
    docs, model = trained
    again = train(docs.repartition(6))
    assert all(np.array_equal(a, b) for a, b in zip(weights(again.root), weights(model.root), strict=True))


def plain_counts(text, bits):
    """Runs of three bytes, by a loop."""
    data = bytes([32]) + bytes(c if c > 127 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in text.encode()) + bytes([32])
    counts = np.zeros(1 << bits)
    for i in range(len(data) - 2):
        run = data[i] << 16 | data[i + 1] << 8 | data[i + 2]
        counts[(run * 2654435761 & 0xFFFFFFFF) >> (32 - bits)] += 1
    return counts


def plain_votes(node, counts):
    """The winner by all pairs, one after the other."""
    names = node.machines.names
    wins, sums, margins = dict.fromkeys(names, 0), dict.fromkeys(names, 0.0), dict.fromkeys(names, np.inf)
    k = 0
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            m = float(counts @ node.machines.weights[:, k] / max(1, counts.sum()) + node.machines.biases[k])
            wins[a if m > 0 else b] += 1
            sums[a] += m
            sums[b] -= m
            margins[a], margins[b] = min(margins[a], m), min(margins[b], -m)
            k += 1
    best = sorted(names, key=lambda n: (-wins[n], -sums[n], n))[0]
    below = node.below[best]
    if isinstance(below, str):
        return below, margins[best]
    lang, inner = plain_votes(below, counts)
    return lang, min(margins[best], inner)


def test_votes_by_all_pairs(trained):
    docs, model = trained
    rows = identify(docs.drop("lang"), model).collect()
    for row in rows[:300]:
        if any(c.isalpha() for c in row.text or ""):
            lang, margin = plain_votes(model.root, plain_counts(row.text, model.bits))
            assert row.language.lang == lang
            assert row.language.score == pytest.approx(1 / (1 + np.exp(-2 * min(margin, 30))), abs=1e-3)


def made_up(lang, rng, n):
    """Words of a made-up language: its own syllables."""
    letters = np.random.default_rng(lang).permutation(list("abcdefghijklmnopqrstuvwxyz"))
    parts = ["".join(letters[[i, j, k]]) for i, j, k in np.random.default_rng(lang).integers(0, 26, (12, 3))]
    return " ".join("".join(rng.choice(parts, 2)) for _ in range(n))


def test_three_hundred_languages(spark):
    """Each is learned, from three rows of any length, and found again."""
    rng = np.random.default_rng(1)
    rows = [(lang * 10 + k, made_up(lang, rng, 2000 if k == 0 else 30), f"x{lang:03d}") for lang in range(300) for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(8)
    model = train(docs)

    def leaves(node):
        for below in node.below.values():
            yield from [below] if isinstance(below, str) else leaves(below)

    learned = {r.lang for r in docs.where(~held_out()).select("lang").distinct().collect()}
    assert sorted(leaves(model.root)) == sorted(learned) and len(learned) > 290
    assert sum(w.nbytes for w in weights(model.root)) < 2 * language_id.MODEL_BYTES
    tests = spark.createDataFrame([(lang, made_up(lang, rng, 60)) for lang in range(300) if f"x{lang:03d}" in learned], "i int, text string")
    found = identify(tests, model).collect()
    assert np.mean([r.language.lang == f"x{r.i:03d}" for r in found]) > 0.9


def test_long_texts_teach_their_language(spark):
    """French comes in texts of 6,800 characters and more only, its letters late in some of them."""
    fr = "le petit chat noir mange une pomme rouge dans le jardin avec ses amis pendant que la pluie tombe sur la ville "
    en = "the small black cat eats a red apple in the garden with its friends while the rain falls on the town "
    rows = [(i, (". 1 2 3 " * 900 if i % 2 else "") + fr * 62, "fr") for i in range(40)] + [(100 + i, en * 2, "en") for i in range(40)]
    model = train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    tests = spark.createDataFrame([(fr * 60,), (fr,), (en * 60,), (en,)], "text string")
    assert [r.language.lang for r in identify(tests, model).collect()] == ["fr", "fr", "en", "en"]


def test_a_language_of_equal_rows_is_learned(spark):
    rows = [(7, "aaa bbb", "xx")] * 3000 + [(i, "ccc ddd", "yy") for i in range(50)]
    model = train(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5))
    tests = spark.createDataFrame([("bbb aaa",), ("ddd ccc",)], "text string")
    assert [r.language.lang for r in identify(tests, model).collect()] == ["xx", "yy"]


def test_machine_separates():
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, (200, 5)).astype(np.float32)
    y = np.where(x @ np.array([1, -2, 0.5, 0, 1]) + 0.3 > 0, 1, -1).astype(np.float32)
    w, b = fit_machine(x, y)
    assert (np.sign(x @ w + b) == y).mean() > 0.95


def test_unlisted_and_single_languages():
    alone = fit([("hello there", "xx")])
    assert alone.predict(np.zeros(9, np.uint8)) == {"lang": "xx", "family": "xx", "score": pytest.approx(1)}
    three = fit([(t * 5, lang) for t, lang in [("aaa bbb ", "xx"), ("ccc ddd ", "yy"), ("eee fff ", "en")]])
    assert three.root.machines.names == ["en", "xx", "yy"]


@pytest.mark.parametrize("n", [50, 500])
def test_machine_of_few_rows_is_the_same(monkeypatch, n):
    """Moving rows' shares and moving weights are one and the same."""
    rng = np.random.default_rng(n)
    x = rng.normal(0, 1, (n, 40)).astype(np.float32)
    y = np.where(rng.random(n) > 0.4, 1, -1).astype(np.float32)
    found = []
    for rows in (x, np.concatenate([x] * 7)):
        w, b = fit_machine(rows, np.resize(y, len(rows)))
        found.append((w, b))
    assert np.allclose(found[0][0], found[1][0], atol=1e-3) and found[0][1] == pytest.approx(found[1][1], abs=1e-3)


def test_other_columns_stay(trained, spark):
    """All but one named like ``into``, which is replaced."""
    docs = strange(spark).withColumn("language", F.lit("before"))
    found = identify(docs, trained[1])
    assert found.columns == docs.columns
    assert plain(found.drop("language").collect()) == plain(docs.drop("language").collect())
    assert identify(docs, trained[1], into="lang2").columns == [*docs.columns, "lang2"]


def test_strange_rows(trained, spark):
    _, model = trained
    docs = strange(spark)
    rows = identify(docs, model).collect()
    assert len(rows) == len(STRANGE)
    for r in rows:
        blank = r.text is None or not any(c.isalpha() for c in r.text)
        assert (r.language.lang == UNKNOWN) == blank
    assert identify(nothing(spark), model).count() == 0


def test_nothing_to_learn_from(spark):
    docs = strange(spark)
    model = train(nothing(spark))
    assert {(r.language.lang, r.language.score) for r in identify(docs, model).collect()} == {(UNKNOWN, 0.0)}
    assert identify(docs, train(docs)).count() == len(STRANGE)
