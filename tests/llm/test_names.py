"""Columns that operators might use themselves come through with their values."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm.decontaminate import cut_contamination, drop_contaminated, find_contamination
from ledgerloom.llm.language_id import fit as fit_languages, identify
from ledgerloom.llm.pii import find_pii, mask_pii
from ledgerloom.llm.quality_rules import keep_good
from ledgerloom.llm.toxicity import drop_toxic, score_toxicity, train
from tests.llm.data import plain, words

NAMES = ("_key", "_pii", "_found", "_toxicity", "_place", "language", "toxicity", "pii", "found")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, words(i, 120), "en", "web") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return docs.withColumns({name: F.concat(F.lit(name), F.col("doc_id")) for name in NAMES})


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "nothing of this occurs")], "item_id long, text string")


@pytest.fixture(scope="module")
def model(spark, docs):
    return train(docs, spark.createDataFrame([], "doc_id long, toxic int"))


def values(df, *without):
    return plain(df.select(*(c for c in df.columns if c not in without)).collect())


def test_values_come_through(docs, items, model):
    kept = keep_good(docs)
    assert kept.columns == docs.columns and set(values(kept)) <= set(values(docs))
    for same in (mask_pii(docs), drop_contaminated(docs, items), cut_contamination(docs, items), drop_toxic(docs, model)):
        assert same.columns == docs.columns and values(same) == values(docs)


def test_only_into_is_replaced(docs, items, model):
    for found, into in (
        (find_pii(docs), "pii"),
        (find_contamination(docs, items), "found"),
        (score_toxicity(docs, model), "toxicity"),
        (identify(docs, fit_languages([("a b", "en")])), "language"),
    ):
        assert found.columns == docs.columns and values(found, into) == values(docs, into)
