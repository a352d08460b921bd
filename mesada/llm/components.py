"""Connected components of a graph given by its edges, as a loop of joins.

Every round replaces each edge by edges to the smallest neighbour, first of the larger and then
of the smaller ends (the large-star and small-star steps of Kiveris and others, 2014), until
nothing changes. A hub's edges are spread by adaptive skew joins, minima are combined before
each shuffle, and each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mesada.llm.common import checkpointed


def _pointed(edges: DataFrame, both: bool) -> DataFrame:
    """Edges from each node's neighbours (the larger ones, or the smaller ones) to the least."""
    if both:
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges
    least = near.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    met = near.join(least, "u")
    if both:
        out = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = met.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return out.where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v") % F.lit(1 << 40))
        ).first()
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """(u, v) long pairs -> (node, label): label is the least node of the component.

    Nodes without an edge to another node do not appear. Null ends and loops are ignored.
    """
    edges = checkpointed(
        edges.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    state = _state(edges)
    while True:
        larger = _pointed(edges, both=True)
        edges = checkpointed(_pointed(larger, both=False))
        before, state = state, _state(edges)
        if state == before:
            break
    ends = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return ends.unionByName(ends.select(F.col("label").alias("node"), "label").distinct())
