"""Connected components by alternating large-star and small-star steps.

Each step sends every edge through one aggregate for the neighbourhood minimum
(combined before the shuffle, so a vertex with very many neighbours is no hot
task) and one join back, which Spark splits where a vertex is skewed. The edge
list is checkpointed to the shared folder after each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.llm.common import kept_table


EDGES_PER_FILE = 500_000


def _with_minimum(edges: DataFrame) -> DataFrame:
    lowest = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(lowest, "u").withColumn("m", F.least("u", "m"))


def large_star(edges: DataFrame) -> DataFrame:
    """Each vertex links its larger neighbours to the smallest vertex it knows."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (
        _with_minimum(both)
        .where(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
    )


def small_star(edges: DataFrame) -> DataFrame:
    """Each vertex links itself and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    linked = _with_minimum(down)
    return (
        linked.select(F.explode(F.array(F.col("u"), F.col("v"))).alias("u"), F.col("m").alias("v"))
        .where(F.col("u") != F.col("v"))
        .distinct()
    )


def _state(edges: DataFrame) -> tuple:
    # The sum of hashes may wrap; as decimal it does not.
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every vertex of ``edges(u, v)``; component is the smallest vertex.

    Null ends and self links are ignored, repeated edges count once. No edges:
    an empty table. Vertices may be of any ordered type.
    """
    edges = edges.select("u", "v").where("u <> v").distinct()
    edges, state = kept_table(edges, "edges"), None
    while True:
        now = _state(edges)
        if now == state or now[0] == 0:
            break
        state = now
        # A round makes no more edges than it got; a file per so many of them is enough.
        edges = kept_table(small_star(large_star(edges)).coalesce(now[0] // EDGES_PER_FILE + 1), "edges")
    # Stars now: every vertex but the centre has one edge, to the centre.
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = stars.select(F.col("component").alias("node"), "component").distinct()
    return stars.unionByName(centres)
