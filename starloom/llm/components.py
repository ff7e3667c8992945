"""Connected components of a table of links, as DataFrame rounds.

Links are contracted round by round: first every node links its larger neighbours to its
smallest one, then its smaller neighbours. The result is a star around the smallest node of each
component. A node with very many links is only ever reduced to a minimum and joined, never
gathered. Every round is stored in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.session import Scratch


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("low"))
    return both.where("b > a").join(low, "a").select(
        F.col("b").alias("x"), F.least("a", "low").alias("y"))


def _small_star(links: DataFrame) -> DataFrame:
    """Of a node's smaller neighbours, the smallest gets all others and the node."""
    low = links.groupBy("a").agg(F.min("b").alias("low"))
    joined = links.join(low, "a")
    return joined.select(F.explode(F.array(
        F.struct(F.col("b").alias("x"), F.col("low").alias("y")),
        F.struct(F.col("a").alias("x"), F.col("low").alias("y")))).alias("e")).select("e.*")


def _downwards(pairs: DataFrame) -> DataFrame:
    """Distinct links, each from the larger node a to the smaller b."""
    return pairs.where("x <> y").select(
        F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


def components(links: DataFrame, store: Scratch) -> DataFrame:
    """(node, component) for all nodes of ``links`` (x, y): the smallest node reachable."""
    held = store.keep(_downwards(links), "links")
    mark = None
    while True:
        held = store.keep(_downwards(_large_star(held)), "large_star")
        held = store.keep(_downwards(_small_star(held)), "small_star")
        row = held.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
                       ).first()
        if tuple(row) == mark:
            break
        mark = tuple(row)
    return _stars_of(held)


def with_links(found: DataFrame, links: DataFrame, store: Scratch) -> DataFrame:
    """(node, component) after more ``links`` (x, y) are added to the components ``found``. Only
    the new links are contracted, between the components that they join."""
    known = store.keep(links.select("x", "y"), "new_links")
    ends = known.select(F.explode(F.array("x", "y")).alias("node")).distinct()
    fresh = ends.join(found, "node", "left_anti").withColumn("component", F.col("node"))
    nodes = store.keep(found.unionByName(fresh), "nodes")
    of_x = nodes.select(F.col("node").alias("x"), F.col("component").alias("_x"))
    of_y = nodes.select(F.col("node").alias("y"), F.col("component").alias("_y"))
    between = known.join(of_x, "x").join(of_y, "y").select(
        F.col("_x").alias("x"), F.col("_y").alias("y"))
    joined = store.keep(components(between, store).select(
        F.col("node").alias("component"), F.col("component").alias("_of")), "joined")
    return nodes.join(joined, "component", "left").select(
        "node", F.coalesce("_of", "component").alias("component"))


def _stars_of(held: DataFrame) -> DataFrame:
    """The star of each component as (node, component) rows."""
    nodes = held.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = held.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.unionByName(roots)
