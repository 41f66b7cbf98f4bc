"""Connected components of an edge table, in rounds of large-star and small-star.

Every round links each node to the least node that it or a neighbour knows, so a
component of any shape becomes a star around its least node in about log(diameter)
rounds. A node of any degree is spread over tasks (``copies_joined``), and each
round's edges are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import copies_joined, salted_max, stored


def _least(edges: DataFrame) -> DataFrame:
    """Each edge (u, v) with the least neighbour m of u."""
    least = salted_max(edges, ["u"], [F.min("v").alias("m")], [F.min("m").alias("m")], salts=16, spread="v")
    return copies_joined(edges, ["u"], least, salts=16, spread="v")


def _round(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _least(both).filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
    small = _least(large.distinct())
    return small.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v") \
        .unionByName(small.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label): for every node of an edge, the least node of its component.

    ``edges`` has columns u and v of one orderable type, without nulls; loops and
    repeated or reversed edges do no harm. No edges: no rows.
    """
    now = stored(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = None
    while True:
        # the edges are a set of stars once a round changes nothing
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if seen == mark:
            break
        mark = seen
        if seen.n:
            now = stored(_round(now), "edges")
    labels = now.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return labels.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
