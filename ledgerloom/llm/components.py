"""Connected components of a graph given as a table of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import stored


def components(links: DataFrame) -> DataFrame:
    """``(node, label)``: the smallest node that each linked node reaches.

    ``links`` has columns ``a`` and ``b`` of one type; direction and repeats do not
    matter. Each round every node hangs itself below its smallest neighbour, the trees
    that this makes are flattened by doubling, and each becomes one node of the graph of the
    next round. Only nodes smaller than all their neighbours are left, at most half, so
    rounds and doublings are logarithmic even for one long chain. All joins read stored
    tables on both sides, so that adaptive execution can split the links of a node that
    has very many.
    """
    edges = stored(
        links.select("a", "b")
        .union(links.select("b", "a"))
        .where("a is not null and b is not null and a != b")
        .distinct(),
        "links",
    )
    labels = edges.select(F.col("a").alias("node"), F.col("a").alias("label")).where("false")
    while not edges.isEmpty():
        roots = flattened(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root")))
        above = roots.withColumnsRenamed({"node": "label"})
        old = labels.join(above, "label", "left").select("node", F.coalesce("root", "label").alias("label"))
        first = roots.select("node", F.col("root").alias("label"))
        # what is linked in a later round has been a node of the first
        labels = stored(first if labels.isEmpty() else old, "labels")
        left, right = (roots.withColumnsRenamed({"node": side, "root": f"root_{side}"}) for side in "ab")
        moved = stored(edges.join(left, "a").select("b", "root_a"), "links")
        contracted = moved.join(right, "b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
        edges = stored(contracted.where("a != b").distinct(), "links")
    return labels


def flattened(parents: DataFrame) -> DataFrame:
    """``(node, root)`` with the last of the chain from each node in place of the next."""
    parents = stored(parents, "trees")
    while True:
        up = parents.select(F.col("node").alias("root"), F.col("root").alias("further"))
        moved = stored(
            parents.join(up, "root").select(
                "node", F.col("further").alias("root"), (F.col("further") != F.col("root")).alias("moved")
            ),
            "trees",
        )
        if moved.where("moved").isEmpty():
            return parents
        parents = moved.select("node", "root")
