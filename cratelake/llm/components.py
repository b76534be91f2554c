"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratelake.llm.store import stored


def components(links: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``links(a, b)``; the label is a node of the component.

    Each round sends a node to its smallest neighbour, if that is smaller, and goes on with the
    links between the nodes that are left. Nodes are hashes, so a round leaves a fixed share
    of them at most, whatever the shape. The rounds' maps are put together at the end. A node
    with many links is one group of a minimum, which is worked out before the shuffle; joins on
    it are split by size at run time.
    """
    links = stored(links.where("a <> b").select("a", "b").distinct(), "links")
    maps = []
    while not maps or not links.isEmpty():
        both = links.union(links.select("b", "a"))
        step = stored(
            both.groupBy(F.col("a").alias("node"))
            .agg(F.min("b").alias("b"))
            .select("node", F.least("node", "b").alias("label")),
            "step",
        )
        maps.append(step)
        left = step.select(F.col("node").alias("a"), F.col("label").alias("la"))
        right = step.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        links = stored(
            links.join(left, "a").join(right, "b").where("la <> lb")
            .select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).distinct(),
            "links",
        )
    final = maps.pop()
    while maps:
        later = final.select(F.col("node").alias("label"), F.col("label").alias("end"))
        final = stored(
            maps.pop().join(later, "label", "left")
            .select("node", F.coalesce("end", "label").alias("label")),
            "labels",
        )
    return final
