import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import distinct
from ledgerloom.operators.distinct import bit_is_set, distinct_counts, value_sets


@pytest.mark.parametrize("dense", [1, 20, 2048])
def test_counts_of_unions(spark, monkeypatch, dense):
    """Days put together in any way count each value once: NULL keys and values, negative values, buckets
    that are lists on one day and bitmaps on another."""
    monkeypatch.setattr(distinct, "DENSE", dense)
    rng = random.Random(dense)
    rows = [(d, rng.choice(["a", "b", None]), rng.choice([None, rng.randrange(-40, 40), rng.randrange(70_000)])) for d in range(4) for _ in range(80)]
    rows += [(3, "hot", v) for v in range(0, 90_000, 7)] + [(2, "hot", v) for v in range(50)] * 3 + [(1, "none", None)]
    df = spark.createDataFrame(rows, "ds int, place string, user_id int").repartition(3)
    sets = value_sets(df, ("ds", "place"), "user_id").persist()
    many = sets.where("bits IS NOT NULL")
    assert sets.groupBy("ds", "place", "bucket").count().where("count > 1").isEmpty()
    assert sets.where((F.size("positions") > 0) & F.col("bits").isNotNull()).isEmpty()
    assert sets.where("positions IS NULL").count() == many.count() and (many.count() > 0) == (dense <= 2048)
    for days in ([0], [3], [0, 1], [2, 3], [0, 1, 2, 3]):
        got = {r.place: r.n for r in distinct_counts(sets.where(F.col("ds").isin(days)), ["place"], "n").collect()}
        want = {}
        for d, place, user in rows:
            if d in days and user is not None:
                want.setdefault(place, set()).add(user)
        assert got == {place: len(users) for place, users in want.items()}
    sets.unpersist()


def test_bits(spark):
    values = [0, 1, 7, 8, 9, 4095, 32_767]
    bitmap = spark.createDataFrame([(v,) for v in values], "v long").agg(F.bitmap_construct_agg("v").alias("bits"))
    found = bitmap.crossJoin(spark.range(32_768)).where(bit_is_set(F.col("bits"), F.col("id")))
    assert sorted(r.id for r in found.select("id").collect()) == values


def test_a_value_takes_little_room(spark):
    """A place with few values is no bitmap."""
    df = spark.range(100).select(F.col("id").alias("place"), (F.col("id") * 40_000).alias("user_id"))
    assert value_sets(df, ["place"], "user_id").where("bits IS NOT NULL").isEmpty()
