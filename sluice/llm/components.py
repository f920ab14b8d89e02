"""Connected components by alternating stars, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import written

#: Rows sent to every task, at most.
BROADCAST_ROWS = 400_000
#: Tasks over which the edges of one node are spread.
SALTS = 16


def components(edges: DataFrame) -> DataFrame:
    """From edges (a, b) of longs: rows (node, label), label the least node of the component.

    Nodes appear if an edge between different nodes does. Each round links every larger neighbour
    of a node to its least neighbour, then every node and its smaller neighbours to the least of
    them, and is written to the shared folder; rounds end when the edges no longer change, after
    about the logarithm of the longest path. An empty table gives no rows.
    """
    now = edges.select(
        F.greatest("a", "b").cast("long").alias("u"), F.least("a", "b").cast("long").alias("v")
    ).filter("u <> v").distinct()
    now = written(now, "edges")
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before or not state[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
            )
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _to_each(both.filter("v > u"), least, state[0]).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _to_each(large, least, state[0])
        now = written(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v")
            .unionByName(least.select("u", F.col("m").alias("v")))
            .distinct(),
            "edges",
        )


def _to_each(edges: DataFrame, least: DataFrame, count: int) -> DataFrame:
    """Edges with the least neighbour of their node.

    `least` has two rows an edge at most: few are sent to every task. Many are copied `SALTS`
    times, so that the edges of a node with very many are spread over as many tasks.
    """
    if 2 * count <= BROADCAST_ROWS:
        return edges.join(F.broadcast(least), "u")
    salted = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return edges.withColumn("salt", F.pmod(F.hash("v"), F.lit(SALTS))).join(salted, ["u", "salt"]).drop("salt")
