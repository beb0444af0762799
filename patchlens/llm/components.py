"""Connected components of an edge table, in DataFrame operations only."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchlens.llm.scratch import saved


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (a, b); a component is named by its smallest node.

    Each round points every node to its smallest neighbour and contracts the edges to those
    pointers, so a chain shrinks by more than half and a star, however large, takes two rounds.
    Groups are only ever minimised (partially before the shuffle) or joined to one row per node,
    never gathered. Loops, repeated edges and null ends are harmless; no edges give no rows.
    """
    pairs = saved(
        edges.where(F.col("a") != F.col("b"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    node = pairs.schema["a"].dataType
    label = edges.sparkSession.createDataFrame([], f"node {node.simpleString()}, component {node.simpleString()}")
    first = True
    while not pairs.isEmpty():
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = saved(both.groupBy(F.col("a").alias("at")).agg(F.min("b").alias("to"))).select(
            "at", F.least("at", "to").alias("to")
        )
        if first:
            label = hook.select(F.col("at").alias("node"), F.col("to").alias("component"))
        else:
            moved = label.join(hook, F.col("component") == F.col("at"), "left")
            label = saved(moved.select("node", F.coalesce("to", "component").alias("component")))
        left = hook.select(F.col("at").alias("a"), F.col("to").alias("low"))
        right = hook.select(F.col("at").alias("b"), F.col("to").alias("high"))
        pairs = saved(
            pairs.join(left, "a")
            .join(right, "b")
            .where(F.col("low") != F.col("high"))
            .select(F.least("low", "high").alias("a"), F.greatest("low", "high").alias("b"))
            .distinct()
        )
        first = False
    return label
