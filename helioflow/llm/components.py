"""Connected components by repeated contraction, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioflow.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of an undirected graph.

    ``edges`` has long columns ``a`` and ``b``; direction, loops and repeats don't matter, edges
    with a null end are ignored. Returns ``node, component`` for every node of a proper edge;
    ``component`` is the smallest node of its component. No edges: no rows.

    Each round hooks every node to its smallest neighbour, follows the hooks to their roots by
    pointer jumping, and contracts the edges to roots. The nodes at least halve in each round.
    Tables are written and read back, by which Spark knows their sizes: checkpoints carry estimates, whose digits double with each join.
    A hub's rows are spread by partial aggregation and by Spark's skew join.
    """
    edges = stored(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .distinct()
    )
    labels = None
    while not edges.isEmpty():
        ends = edges.select(F.col("hi").alias("node"), F.col("lo").alias("other")).unionByName(
            edges.select(F.col("lo").alias("node"), F.col("hi").alias("other"))
        )
        hooks = ends.groupBy("node").agg(F.min("other").alias("other"))
        hooks = _roots(stored(hooks.select("node", F.least("node", "other").alias("root"))))
        if labels is None:
            labels = hooks
        else:
            labels = stored(
                labels.join(hooks.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left")
                .select("node", F.coalesce("to", "root").alias("root"))
            )
        edges = stored(
            edges.join(hooks.select(F.col("node").alias("hi"), F.col("root").alias("a")), "hi")
            .join(hooks.select(F.col("node").alias("lo"), F.col("root").alias("b")), "lo")
            .where(F.col("a") != F.col("b"))
            .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
            .distinct()
        )
    if labels is None:
        return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return labels.select("node", F.col("root").alias("component"))


def _roots(hooks: DataFrame) -> DataFrame:
    """Follow hooks, which always point to a smaller node, until all of them end at a root."""
    while True:
        longer = stored(
            hooks.join(hooks.select(F.col("node").alias("root"), F.col("root").alias("next")), "root")
            .select("node", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved"))
        )
        hooks = longer.select("node", "root")
        if longer.where("moved").isEmpty():
            return hooks
