"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf.llm.tables import stored


def connected(links: DataFrame) -> DataFrame:
    """``(node, root)`` for each node of ``links(a, b)``, both ``long``; the root is the smallest node reachable.

    Alternates between hanging larger neighbours, then smaller ones, below the smallest node known, until
    every node hangs directly below a root. Each round ends in a written table. Nodes are compared as
    signed numbers. Nulls and links from a node to itself are ignored; without links the result is empty.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
    links = stored(links.distinct(), "links")
    while True:
        both = links.unionByName(links.select(F.col("root").alias("node"), F.col("node").alias("root")))
        least = both.groupBy("node").agg(F.least(F.min("root"), F.col("node")).alias("least"))
        links = both.join(least, "node").where("root > node").select(F.col("root").alias("node"), "least")
        links = links.distinct()
        least = links.groupBy("node").agg(F.min("least").alias("root"))
        moved = links.join(least, "node").where("least <> root").select(F.col("least").alias("node"), "root")
        links = stored(least.unionByName(moved).distinct(), "links")
        parents = links.select(F.col("root").alias("node")).distinct()
        unsettled = links.join(parents, "node", "left_semi").limit(1).count()
        doubled = links.groupBy("node").count().where("count > 1").limit(1).count()
        if not unsettled and not doubled:
            return links.unionByName(parents.select("node", F.col("node").alias("root")))
