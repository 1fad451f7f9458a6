"""Bounded samples of labelled documents, and the rows that are kept out of them."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def fold(id_column: str = "doc_id") -> Column:
    """crc32 of the id as text, mod 5; fold 0 is held out. An id of null is in no fold."""
    return F.pmod(F.crc32(F.col(id_column).cast("string")), F.lit(FOLDS))


def held_out(id_column: str = "doc_id") -> Column:
    return F.coalesce(fold(id_column) == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows_per_value: dict[int, int], max_chars: int) -> list[tuple[str, int]]:
    """``(text, label)`` of at most the given rows for each value of ``label``, on the driver.

    Rows of fold 0, rows without text or label and texts over ``max_chars`` are left out; of
    the rest, those with the smallest hash of the id are taken, so the choice is the same in
    every run. An id with several labels has the largest.
    """
    known = (
        labels.where(fold() > 0).groupBy("doc_id").agg(F.max(label).alias("_y")).withColumn("_order", F.xxhash64("doc_id"))
    )
    texts = docs.select("doc_id", "text").where(F.length("text") <= max_chars)
    out = []
    for value, most in sorted(rows_per_value.items()):
        chosen = known.where(F.col("_y") == value).orderBy("_order", "doc_id").limit(most)
        rows = texts.join(F.broadcast(chosen), "doc_id").orderBy("_order", "doc_id", "text").limit(most)
        out += [(row.text, value) for row in rows.select("text").collect()]
    return out
