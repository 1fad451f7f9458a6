"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``nodes`` random points of a ring of hashes; a document belongs to the next point
clockwise. A shard takes no more than its bound; what is over goes on clockwise, point
by point, to shards with room. With ``slack`` 0 the bounds add up to all rows, so counts are
at most one apart; with more slack fewer rows move when a shard is added.

The walk is done for whole arcs: the rows of an arc are only counted, and the counts (one
for each point of the ring, whatever the data) say which stretch of an arc goes to which
shard. Then every row finds its place by its rank in its arc, which is a running total in
its cell of the arc plus that of the cells before.

Only DataFrame operations. Defined results: a null text has no bytes and the checksum of an
empty one; a null id is a value; repeated rows get places of their own; an empty
table gives an empty one.
"""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import runs
from .names import fresh
from .runs import cell_bits, numbered_copies, row_hash, row_key
from .scratch import stored

SHARDS = 24
NODES = 64
SLACK = 0.0
SEED = 29
#: Bytes of a row besides its text.
ROW_BYTES = 8


def unsigned(x: int) -> int:
    return x % (1 << 64)


def ring(spark: SparkSession, shards: int, nodes: int) -> list[tuple[int, int]]:
    """Points in order: position on the ring (unsigned), shard."""
    points = spark.range(shards * nodes, numPartitions=1).select(
        (F.col("id") % shards).alias("shard"), F.xxhash64(F.lit(SEED), F.col("id") % shards, F.expr(f"id div {shards}")).alias("at")
    )
    return sorted((unsigned(p.at), p.shard) for p in points.collect())


def arc_table(spark: SparkSession, points: list[tuple[int, int]]) -> tuple[DataFrame, int]:
    """For each slice of the ring, named by leading bits of a position: the number of
    points before it and the points in it. As many rows as twice the points, at most four times."""
    bits = max(1, len(points).bit_length() + 1)
    inside: list[list[int]] = [[] for _ in range(1 << bits)]
    for at, _ in points:
        inside[at >> (64 - bits)].append(at - (1 << 64) if at >> 63 else at)
    rows, before = [], 0
    for number, here in enumerate(inside):
        rows.append((number, before, here))
        before += len(here)
    return spark.createDataFrame(rows, "slice long, before int, points array<long>"), bits


def bounds(total: int, shards: int, slack: float) -> list[int]:
    """Most rows of each shard."""
    if slack:
        return [-(-int(total * (1 + slack)) // shards)] * shards
    return [total // shards + (s < total % shards) for s in range(shards)]


def walk(loads: list[int], owners: list[int], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Stretches ``(arc, from, to, shard, slot)``: rows of the arc from a rank up to another,
    and the slot of the first. In round r every arc offers what it has left to the
    shard r points on; who comes first in the ring is served first."""
    left, taken, out = list(loads), [0] * len(room), []
    active, on = [a for a, n in enumerate(loads) if n], 0
    while active:
        for a in active:
            shard = owners[(a + on) % len(owners)]
            n = min(left[a], room[shard] - taken[shard])
            if n > 0:
                first = loads[a] - left[a]
                out.append((a, first, first + n, shard, taken[shard]))
                taken[shard] += n
                left[a] -= n
        active, on = [a for a in active if left[a]], on + 1
    return out


def shard_plan(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shards: int = SHARDS,
    nodes: int = NODES,
    slack: float = SLACK,
) -> DataFrame:
    """One row per document: id, ``row_hash``, ``size`` in bytes, ``text_crc32``,
    ``shard`` and ``slot``, its number in the shard from 0 without gaps."""
    return place_rows(docs, id_column, text_column, shards, nodes, slack)[0].drop("n")


def place_rows(
    docs: DataFrame, id_column: str, text_column: str, shards: int, nodes: int, slack: float
) -> tuple[DataFrame, int]:
    """The plan, with ``n`` rows equal to each in all columns, and the largest ``n``."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_column), F.lit(""))
    points = ring(spark, shards, nodes)
    slices, bits = arc_table(spark, points)
    counted = (
        docs.select(
            F.col(id_column).alias("id"),
            (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.xxhash64(F.lit(SEED), F.col(id_column), F.col(text_column)).alias("at"),
            row_hash(docs).alias("row_hash"),
        )
        .groupBy("id", "size", "text_crc32", "at", "row_hash")
        .agg(F.count("*").alias("n"))
    )
    position = F.col("before") + F.size(F.filter("points", lambda p: p < F.col("at")))
    placed = stored(
        counted.withColumn("slice", F.shiftrightunsigned("at", 64 - bits))
        .join(F.broadcast(slices), "slice")  # bounded by the ring
        .withColumn("arc", (position % len(points)).cast("int"))
        .withColumn("cell", F.shiftrightunsigned("at", 64 - cell_bits(docs)))
        .drop("slice", "before", "points"),
        "placed",
    )
    cells = stored(placed.groupBy("arc", "cell").agg(F.sum("n").alias("rows"), F.max("n").alias("largest")), "cells")
    totals = cells.groupBy("arc").agg(F.sum("rows").alias("rows"), F.max("largest").alias("largest")).collect()
    loads = [0] * len(points)
    for row in totals:
        loads[row.arc] = row.rows
    stretches = spark.createDataFrame(
        walk(loads, [shard for _, shard in points], bounds(sum(loads), shards, slack)),
        "on int, first long, last long, shard int, slot long",
    )
    before = Window.partitionBy("arc").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select("arc", "cell", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    ahead = Window.partitionBy("arc", "cell").orderBy("at", "id", "row_hash").rowsBetween(Window.unboundedPreceding, -1)
    ranked = placed.withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0))).join(offsets, ["arc", "cell"])
    largest = max((row.largest for row in totals), default=0)
    rank = F.col("offset") + F.col("ahead") + F.col("k")
    plan = (
        numbered_copies(ranked, "n", "k", largest)
        .withColumn("rank", rank)
        # at most one stretch for each point and one for each shard
        .join(F.broadcast(stretches), (F.col("arc") == F.col("on")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last")))
        .select(
            F.col("id").alias(id_column),
            "row_hash",
            "size",
            "text_crc32",
            "shard",
            (F.col("slot") + F.col("rank") - F.col("first")).alias("slot"),
            "n",
        )
    )
    return plan, largest


def shard(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shards: int = SHARDS,
    nodes: int = NODES,
    slack: float = SLACK,
) -> DataFrame:
    """``docs`` with the columns ``shard`` and ``slot``, which replace columns of that name."""
    key, part = fresh(docs, "_key"), fresh(docs, "_part")
    plan, largest = place_rows(docs, id_column, text_column, shards, nodes, slack)
    named = F.struct(F.col(id_column).alias("id"), F.col("row_hash").alias("hash")).alias(key)
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("shard", "slot")]
    rows = docs.withColumn(key, row_key(docs, id_column)).select(*kept, key)
    if largest <= runs.STEP:
        placed = rows.dropDuplicates([key]).join(plan.select(named, "shard", "slot"), key)
        return placed.select(*kept, "shard", "slot")
    # a row with very many equals is written by several tasks, each with a part of its slots
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    plan = plan.select(named, "shard", "slot", F.when(F.col("n") > runs.STEP, F.col("slot") % parts).otherwise(0).alias(part))
    one = rows.groupBy(key).agg(F.first(F.struct(*kept)).alias("row"), F.count("*").alias("n"))
    last = F.when(F.col("n") > runs.STEP, F.lit(parts - 1)).otherwise(0).cast("long")
    one = one.select(key, "row", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias(part))
    return one.join(plan, [key, part]).select("row.*", "shard", "slot")
