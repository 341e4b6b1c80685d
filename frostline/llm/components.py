"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frostline.llm.common import stored


def _ancestors(pointers: DataFrame) -> DataFrame:
    """Pointers over twice the distance; a node without a pointer is its own ancestor."""
    above = pointers.select(F.col("node").alias("up"), F.col("up").alias("far"))
    return pointers.join(above, "up", "left").select("node", F.coalesce("far", "up").alias("up"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and root (the smallest node that links reach) of every node that has a link.

    Each round hangs every node below its smallest neighbour, follows these pointers over four steps, and goes on with
    the links between the nodes it got to, until none is left. Where a pointer leads further, the links along it still
    connect what is left. All steps combine before they shuffle, so a node with a great many links is no burden to one
    task.
    """
    edges = links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).filter("a < b").distinct()
    edges, hung = stored(edges, "links"), None
    while not edges.isEmpty():
        pointers = stored(edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("up")), "pointers")
        ends = stored(_ancestors(_ancestors(pointers)), "ends")
        if hung is None:
            tops = edges.select(F.col("a").alias("node")).join(ends, "node", "left_anti").distinct()
            hung = ends.unionByName(tops.select("node", F.col("node").alias("up")))
        else:
            further = ends.select(F.col("node").alias("up"), F.col("up").alias("end"))
            hung = hung.join(further, "up", "left").select("node", F.coalesce("end", "up").alias("up"))
        hung = stored(hung, "hung")
        left, right = (ends.select(F.col("node").alias(c), F.col("up").alias(f"{c}_end")) for c in "ab")
        ended = edges.join(left, "a", "left").join(right, "b", "left")
        ended = ended.select(F.coalesce("a_end", "a").alias("x"), F.coalesce("b_end", "b").alias("y")).filter("x <> y")
        edges = stored(ended.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
    if hung is None:
        return links.select(F.col(a).alias("node"), F.col(a).alias("root")).limit(0)
    return hung.select("node", F.col("up").alias("root"))
