"""Mixing sources to target weights by weighted fair queueing.

The documents of a source are shuffled by hash and queue up as often as the mix may repeat them.
Each gets a virtual finish time: the words of its source up to and including it, divided by the
weight of the source. The queue with the least finish time is always served next, so
all queues are sorted by finish time as one, over all partitions by range, and cut at the
total budget. A source that runs out leaves its share to the others by weight.

Running totals never pass one task whole: rows are cut into cells by hash (within a
source) or ranges (of finish time), a cell's total is added up, and cells get the sum
of those before.

Defined results: sources are ordered by code point, null last, and take the weights in turn;
a null or word-less text has size 0 and is taken as often as its place in the queue allows; repeated
rows queue up one by one; an empty table gives an empty mix. A document is taken whole or
not at all, so a source ends within one document of its target; very long ones as well. ``mix`` returns the columns of
``docs``, whatever their names.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .names import columns, fresh
from .runs import cell_bits, numbered_copies, row_hash, row_key, same
from .scratch import stored

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
REPEATS = 2
SEED = 17


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in the text; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], budget: float, repeats: int) -> DataFrame:
    """``sizes`` (source, source_size) with the weight and target of each source.

    The budget is shared by weight; targets stop at ``repeats`` times the source's size, and what
    is over is shared among the rest, until none is above. One row a source: the table is
    ordered in one task, the shares are settled by sums alone.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    listed = stored(
        sizes.withColumn("_n", F.row_number().over(order) - 1).select(
            "source",
            "source_size",
            F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("_n") % len(weights) + 1).cast("int")).alias("weight"),
            (F.col("source_size") * repeats).cast("double").alias("most"),
        ),
        "sources",
    )
    total = listed.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        # sources that are full at this level of words for each unit of weight
        is_full = F.col("most") <= F.col("weight") * F.lit(level)
        sums = listed.agg(
            F.count_if(is_full).alias("n"),
            F.sum(F.when(is_full, F.col("most")).otherwise(0.0)).alias("given"),
            F.sum(F.when(is_full, 0.0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if sums.n == full or not sums.open:
            break
        full, level = sums.n, (budget * total - sums.given) / sums.open
    target = F.least("most", F.col("weight") * F.lit(level))
    return listed.withColumn("target", target).drop("most")


def mix_plan(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    budget: float = BUDGET,
    repeats: int = REPEATS,
) -> DataFrame:
    """One row per document: id, ``row_hash``, source, size, source_size, target and
    ``copies``, how often the mix takes it."""
    spark = docs.sparkSession
    runs = stored(
        docs.select(
            F.col(id_column).alias("id"),
            F.col(source_column).alias("source"),
            word_count(F.col(text_column)).alias("size"),
            row_hash(docs).alias("row_hash"),
        )
        .groupBy("id", "source", "size", "row_hash")
        .agg(F.count("*").alias("n")),
        "runs",
    )
    per_source = stored(
        runs.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.max("n").alias("largest")),
        "sources",
    )
    targets = source_targets(per_source.select("source", "source_size"), weights, budget, repeats)
    total = per_source.agg(F.sum("source_size"), F.max("largest")).first()
    words, largest = total[0] or 0, total[1] or 0

    # place in the shuffled queue of the source
    shuffled = runs.withColumn("at", F.xxhash64(F.lit(SEED), "id", "row_hash"))
    shuffled = shuffled.withColumn("cell", F.shiftrightunsigned("at", 64 - cell_bits(docs)))
    cells = stored(
        shuffled.groupBy("source", "cell").agg(F.sum(F.col("size") * F.col("n")).alias("words")), "cells"
    )
    before = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(
        cells.select("source", "cell", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset")), "offsets"
    )
    up_to = Window.partitionBy("source", "cell").orderBy("at", "id", "row_hash").rowsBetween(Window.unboundedPreceding, -1)
    queued = shuffled.withColumn("ahead", F.coalesce(F.sum(F.col("size") * F.col("n")).over(up_to), F.lit(0)))
    queued = same(queued, offsets, "source", "cell").select(
        *queued.columns, (F.col("ahead") + F.col("offset")).alias("start")
    )
    queued = same(queued.drop("ahead", "cell"), targets, "source").select(
        *(c for c in queued.columns if c not in ("ahead", "cell")), "source_size", "target", "weight"
    )
    # one row per document: equal rows stand in the queue one behind the other
    queued = stored(numbered_copies(queued, "n", "k", largest), "queued")

    finish = (F.col("lap") * F.col("source_size") + F.col("start") + (F.col("k") + 1) * F.col("size")) / F.col("weight")
    laps = queued.withColumn("lap", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))).withColumn("finish", finish)
    order = ["finish", "source", "lap", "at", "id", "row_hash", "k"]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(
        laps.select(*order, "size").repartitionByRange(ranges, *order).withColumn("part", F.spark_partition_id()), "ranged"
    )
    # one row a range of finish times
    parts = ranged.groupBy("part").agg(F.sum("size").alias("words"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    limit = F.lit(int(budget * words))
    parts = parts.withColumn("offset", F.coalesce(F.sum("words").over(earlier), F.lit(0))).where(F.col("offset") <= limit)
    parts = stored(parts, "parts")
    reached = ranged.join(parts, "part")
    key = ["id", "source", "row_hash", "at", "k"]
    whole = reached.where(F.col("offset") + F.col("words") <= limit).select(*key)
    within = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    cut = (
        reached.where(F.col("offset") + F.col("words") > limit)
        .withColumn("upto", F.col("offset") + F.sum("size").over(within))
        .where(F.col("upto") <= limit)
        .select(*key)
    )
    taken = stored(whole.union(cut).groupBy(*key).agg(F.count("*").alias("copies")), "taken")
    found = same(queued, taken, "id", "source", "row_hash", "at", "k", how="left")
    return found.select(
        F.col("id").alias(id_column),
        "row_hash",
        F.col("source").alias(source_column),
        "size",
        "source_size",
        "target",
        F.coalesce("copies", F.lit(0)).cast("long").alias("copies"),
    )


def mix(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", **options) -> DataFrame:
    """The mix: rows of ``docs``, each as often as the plan takes it."""
    key, copies, number = (fresh(docs, name) for name in ("_key", "_copies", "_k"))
    plan = mix_plan(docs, id_column, text_column, source_column, **options)
    plan = stored(
        plan.where("copies > 0")
        .groupBy(F.struct(F.col(id_column).alias("id"), F.col("row_hash").alias("hash")).alias(key))
        .agg(F.sum("copies").alias(copies)),
        "plan",
    )
    # equal rows are one row here; the plan has the copies of all of them
    rows = docs.withColumn(key, row_key(docs, id_column)).dropDuplicates([key])
    largest = plan.agg(F.max(copies)).first()[0] or 0
    return numbered_copies(rows.join(plan, key), copies, number, largest).select(*columns(docs))
