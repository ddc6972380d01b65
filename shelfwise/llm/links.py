"""Connected components of a table of links, by contraction.

Each step gives every vertex its smallest neighbour as parent and replaces the
links by links between parents, so hubs and long chains shrink alike. All state
lies in staged tables; the driver only asks whether links are left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.staging import staged


def components(links: DataFrame) -> DataFrame:
    """(node, component) for each vertex of links (a, b) of longs; the smallest vertex names a component.

    Links to oneself, repeated links and links with a null end change nothing; a
    vertex without links to others has no row.
    """
    left = staged(links.where("a <> b").select("a", "b").distinct(), "links")
    labels = None
    while not left.isEmpty():
        both = left.unionAll(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = both.groupBy("a").agg(F.min("b").alias("b"))
        parents = staged(nearest.select(F.col("a").alias("node"), F.least("a", "b").alias("parent")), "parents")
        if labels is None:
            labels = parents.select("node", F.col("parent").alias("component"))
        else:
            step = parents.select(F.col("node").alias("component"), "parent")
            labels = staged(
                labels.join(step, "component", "left").select("node", F.coalesce("parent", "component").alias("component")),
                "labels",
            )
        up = left.join(parents.select(F.col("node").alias("a"), F.col("parent").alias("c")), "a").select("b", "c")
        up = up.join(parents.select(F.col("node").alias("b"), F.col("parent").alias("d")), "b").select("c", "d")
        left = staged(up.where("c <> d").select(F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b")).distinct(), "links")
    if labels is None:
        return links.sparkSession.createDataFrame([], "node long, component long")
    return labels
