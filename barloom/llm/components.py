"""Connected components of a large graph: rounds of star contraction, each a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import written


def _arcs(edges: DataFrame) -> DataFrame:
    """Each edge from both of its ends."""
    return edges.select(
        F.explode(
            F.array(
                F.struct(F.col("a").alias("node"), F.col("b").alias("other")),
                F.struct(F.col("b").alias("node"), F.col("a").alias("other")),
            )
        ).alias("e")
    ).select("e.*")


def _to_least(arcs: DataFrame) -> DataFrame:
    """Every neighbour, and the node itself, tied to the least of the node's neighbourhood."""
    least = arcs.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("m"))
    tied = arcs.join(least, "node").select(F.col("other").alias("x"), "m")
    return tied.unionAll(least.select(F.col("node").alias("x"), "m")).filter("x <> m")


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) of integers to rows (node, root): root is the least node reachable. Nodes have an edge at least.

    Each round first ties a node's larger neighbours to the least one around (large star), then a node and its smaller
    neighbours to the least of those (small star). Trees get shallower every round, in about log(n) rounds, until all
    are stars. A hub only ever meets its neighbours in a minimum and a join whose large partitions Spark splits.
    """
    now = written(edges.filter("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return now.selectExpr("a AS node", "b AS root").unionAll(now.selectExpr("b AS node", "b AS root").distinct())
        before = state
        arcs = _arcs(now)
        least = arcs.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("m"))
        large = arcs.filter("other > node").join(least, "node").filter("other <> m").select(
            F.col("other").alias("a"), F.col("m").alias("b")).distinct()
        down = large.withColumnsRenamed({"a": "node", "b": "other"})
        now = written(
            _to_least(down).select(F.greatest("x", "m").alias("a"), F.least("x", "m").alias("b")).distinct(), "edges"
        )
