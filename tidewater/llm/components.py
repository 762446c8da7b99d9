"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import keep


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a, b``); the component is its smallest node.

    Each round maps every node to the smallest of itself and its neighbours and the edges to edges
    between those; a star collapses in one round, however many arms it has. Rounds end when no edge
    joins different nodes. What a round keeps is written to the shared folder. Minima are combined
    before the shuffle; a node with very many edges is split by the joins' skew handling.
    """
    edges = keep(edges.select("a", "b").where("a is not null and b is not null and a <> b").distinct(), "edges")
    found = None
    while True:
        ends = edges.select("a", "b").union(edges.select("b", "a"))
        least = keep(ends.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("to")), "least")
        if found is None:
            found = least.withColumnRenamed("to", "component")
        else:
            step = least.withColumnRenamed("node", "component")
            found = keep(
                found.join(step, "component", "left").select("node", F.coalesce("to", "component").alias("component")), "components"
            )
        if edges.isEmpty():
            return found
        a, b = least.toDF("a", "x"), least.toDF("b", "y")
        edges = keep(edges.join(a, "a").join(b, "b").select(F.col("x").alias("a"), F.col("y").alias("b")).where("a <> b").distinct(), "edges")
