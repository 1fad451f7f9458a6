"""Rows that operators must get through: nulls, empty and very long texts, ties, repeated
rows, and columns whose names operators might use themselves."""

import random

PROSE = "the quick brown fox jumps over the lazy dog while seven wizards mix a very bold potion at dawn".split()


def words(seed: int, n: int, vocabulary=PROSE) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(vocabulary) for _ in range(n))


STRANGE_SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "_key string, _hash string, _copies long, _k long, _found string, _toxicity string, shard string, "
    "slot string, n long, fp long, copies string, tags map<string,string>"
)
_EXTRA = ("key", "hash", 7, 8, "found", "toxicity", "shard", "slot", 9, 10, "copies", {"a": "b"})
_NONE = (None,) * len(_EXTRA)

STRANGE = [
    (1, words(1, 80), "en", "web", 1, *_EXTRA),
    (1, words(1, 80), "en", "web", 1, *_EXTRA),  # a repeated row
    (1, words(2, 80), "en", "web", 1, *_EXTRA),  # the same id, another text
    (2, words(1, 80), "en", None, 1, *_EXTRA),  # the same text
    (3, None, None, None, None, *_NONE),
    (4, None, "en", "web", None, *_EXTRA),
    (5, "", "en", "web", 0, *_EXTRA),
    (6, " \t\n ", "de", "news", 4, *_EXTRA),
    (7, "12 34 !!", "de", "news", 8, *_EXTRA),
    (8, "w", "fr", "news", 1, *_EXTRA),
    (9, words(9, 60_000), "fr", "books", 300_000, *_EXTRA),
    (10, "x" * 500_000, "en", "books", 500_000, *_EXTRA),  # one long word
    (None, words(11, 70), "en", "web", 1, *_EXTRA),
    (None, words(12, 70), "en", "web", 1, *_EXTRA),
    (None, words(12, 70), "en", "web", 1, *_EXTRA),
    (13, "Émile naïve ſtraße 文字 \U0001f600 end", "fr", "web", 1, *_EXTRA),
]


def strange(spark):
    return spark.createDataFrame(STRANGE, STRANGE_SCHEMA).repartition(3)


def nothing(spark):
    return spark.createDataFrame([], STRANGE_SCHEMA)


def plain(rows) -> list[str]:
    return sorted(map(repr, rows))
