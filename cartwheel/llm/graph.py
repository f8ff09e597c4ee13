"""Connected components by alternating large-star and small-star steps.

A link with a null end or with equal ends is ignored, repeated links count once,
no link gives an empty table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import staged
from cartwheel.session import drop_staged


def _star(edges: DataFrame, large: bool) -> tuple[DataFrame, DataFrame]:
    """``edges`` (u > v). Large star links every larger neighbour of a node to
    the smallest of its neighbourhood; small star links the smaller ones and
    the node itself. Minima are pre-aggregated and staged, so the join that
    hands them out can split a hub's edges; their table is returned as well."""
    if large:
        near = edges.select(F.col("u").alias("x"), F.col("v").alias("y")) \
            .unionByName(edges.select(F.col("v").alias("x"), F.col("u").alias("y")))
    else:
        near = edges.select(F.col("u").alias("x"), F.col("v").alias("y"))
    least = staged(near.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m")), "least")
    moved = near.join(least, "x").select(F.col("x"), F.col("y"), F.col("m"))
    out = moved.where(F.col("y") > F.col("x")) if large else moved
    out = out.select(F.col("y").alias("u"), F.col("m").alias("v"))
    if not large:
        out = out.unionByName(least.select(F.col("x").alias("u"), F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct(), least


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component`` for every node of a link, the component named by its
    smallest node."""
    edges = staged(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                   .where(F.col("u") != F.col("v")).distinct(), "edges")
    while True:
        large, least = _star(edges, True)
        half = staged(large, "large-star")
        small, least_half = _star(half, False)
        after = staged(small, "small-star")
        changed = after.join(edges, ["u", "v"], "left_anti").limit(1).count() + \
            edges.join(after, ["u", "v"], "left_anti").limit(1).count()
        drop_staged(least, half, least_half, edges)
        edges = after
        if not changed:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
