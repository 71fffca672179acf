"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from tonearm.llm.blocks import discard, written

FILE_ROWS = 500_000


def _round(edges: DataFrame) -> DataFrame:
    """One round over edges (u, v) with u > v: (u, v, moved).

    Every node takes the smallest of its neighbours as its parent; the other ones are joined to that
    one instead. Then every edge leads on to the parent of its lower end, so that paths are halved. `moved`
    marks the rows that the round changed. Every edge gives at most one, so that the rows don't become more,
    and equal edges become one as soon as they lead to a parent.
    """
    parents = edges.groupBy("u").agg(F.min("v").alias("p"))
    others = edges.join(parents, "u").where("v <> p").select(F.col("v").alias("u"), F.col("p").alias("v"))
    hooked = parents.select("u", F.col("p").alias("v"), F.lit(False).alias("hook")).unionByName(others.withColumn("hook", F.lit(True)))
    above = parents.select(F.col("u").alias("v"), F.col("p").alias("above"))
    return hooked.join(above, "v", "left").select(
        "u", F.coalesce("above", "v").alias("v"), (F.col("hook") | F.col("above").isNotNull()).alias("moved")
    )


def connected_components(edges: DataFrame, purpose: str) -> DataFrame:
    """(node, root) of every node of the edges (u, v): root is the smallest node reachable.

    Rounds go on until a round moves nothing, which is when all edges are stars; each round is
    written, in files of about `FILE_ROWS` rows, and the one before it removed. The number of rounds grows with the logarithm of the size of
    the components. Nothing is collected; the steps are grouped minima and joins, which Spark can split
    for hot nodes.
    """
    directed = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    first = Observation()
    stars, moved = written(directed.distinct().observe(first, F.count("*").alias("rows")), purpose), 1
    rows = first.get["rows"]
    while moved:
        seen, before = Observation(), stars
        counted = _round(before).observe(seen, F.count("*").alias("rows"), F.count_if("moved").alias("moved"))
        stars = written(counted.coalesce(1 + rows // FILE_ROWS), purpose)
        rows, moved = seen.get["rows"], seen.get["moved"]
        discard(before)
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
