"""Connected components by alternating large-star and small-star.

Edges point from the larger node to the smaller one. Large-star hands the larger end of each edge
to the smallest neighbour of the smaller end; small-star points a node and its smaller neighbours to
the smallest of them. When neither changes anything, every node points to its component's minimum.
Each step's edges are written, so a lost executor repeats one step and not the whole loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.session import written


def _pointed(edges: DataFrame, joined_on: str, minima: DataFrame) -> DataFrame:
    """Left join with the minima of the nodes at one end of the edges (``_node``, ``_min``)."""
    return edges.join(minima, edges[joined_on] == minima["_node"], "left").drop("_node")


def _stored(edges: DataFrame) -> DataFrame:
    return written(edges.where("u != v").distinct(), "component-edges")


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("u").alias("_node"), F.col("v").alias("_other")).union(
        edges.select(F.col("v").alias("_node"), F.col("u").alias("_other"))
    )
    # A node that is smaller than all its neighbours hands its edges to itself: nothing to join.
    minima = written(
        both.groupBy("_node").agg(F.min("_other").alias("_min")).where("_min < _node"),
        "component-minima",
    )
    moved = _pointed(edges, "v", minima)
    return _stored(moved.select("u", F.coalesce("_min", "v").alias("v")))


def small_star(edges: DataFrame) -> DataFrame:
    minima = written(
        edges.groupBy("u").agg(F.min("v").alias("_min"), F.count("*").alias("_n"))
        .where("_n > 1").select(F.col("u").alias("_node"), "_min"),
        "component-minima",
    )
    moved = _pointed(edges, "u", minima)
    lowest = F.coalesce("_min", "v")
    return _stored(
        moved.select(
            F.explode(F.array(F.struct("u", lowest.alias("v")),
                              F.struct(F.col("v").alias("u"), lowest.alias("v")))).alias("e")
        ).select("e.*")
    )


def _digest(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    )


def components(links: DataFrame) -> DataFrame:
    """The root of each node that has a link: ``_node`` and ``_root``, its component's minimum.

    ``links`` has the columns ``a`` and ``b`` of one orderable type. Links to oneself and repeated
    links do not matter. Without links the result is empty.
    """
    edges = _stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    state, before = _digest(edges), None
    while state != before:
        edges = small_star(large_star(edges))
        before, state = state, _digest(edges)
    ends = edges.select(F.col("u").alias("_node"), F.col("v").alias("_root"))
    return ends.union(edges.select(F.col("v").alias("_node"), F.col("v").alias("_root")).distinct())
