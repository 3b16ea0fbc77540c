"""Connected components by repeated contraction with joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockyard.llm.common import stored

# How often a round follows the way from a node to its replacement's replacement.
JUMPS = 2


def _ordered(links: DataFrame, a: str, b: str) -> DataFrame:
    return links.filter(F.col(a) != F.col(b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (a, b); the component is its smallest node.

    In each round every node is replaced by the neighbour, or itself, whose hash is smallest, and that
    one by its own replacement; links then join what is left, until none are. Hashes change each round,
    so long chains shrink as fast as others.
    """
    links = stored(_ordered(links, "a", "b"), "links")
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    found = nodes.withColumn("now", F.col("node"))
    turn = 0
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        near = F.min(F.struct(F.xxhash64(F.col("b"), F.lit(turn)).alias("h"), F.col("b").alias("v")))
        nearest = both.groupBy(F.col("a").alias("old")).agg(near.alias("m"))
        own = F.xxhash64(F.col("old"), F.lit(turn))
        moved = F.when((F.col("m.h") < own) | ((F.col("m.h") == own) & (F.col("m.v") < F.col("old"))), F.col("m.v"))
        step = stored(nearest.select("old", F.coalesce(moved, F.col("old")).alias("new")), "replaced")
        for _ in range(JUMPS):
            after = step.select(F.col("old").alias("new"), F.col("new").alias("next"))
            step = step.join(after, "new").select("old", F.col("next").alias("new"))
        step = stored(step, "replaced")
        ahead = step.withColumnsRenamed({"old": "now", "new": "next"})
        found = found.join(ahead, "now", "left").select("node", F.coalesce("next", "now").alias("now"))
        left = links.join(step.withColumnsRenamed({"old": "a", "new": "x"}), "a")
        left = left.join(step.withColumnsRenamed({"old": "b", "new": "y"}), "b")
        links = stored(_ordered(left, "x", "y"), "links")
        turn += 1
        if turn % 4 == 0:
            found = stored(found, "nodes")
    found = stored(found, "nodes")
    least = found.groupBy("now").agg(F.min("node").alias("component"))
    return stored(found.join(least, "now").select("node", "component"), "components")


def merged(found: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more `links` (a, b) between their nodes, or nodes that are in none."""
    of = found.select(F.col("node").alias("a"), F.col("component").alias("x"))
    to = found.select(F.col("node").alias("b"), F.col("component").alias("y"))
    between = links.join(of, "a", "left").join(to, "b", "left")
    whole = components(between.select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b")))
    again = whole.select(F.col("node").alias("component"), F.col("component").alias("last"))
    kept = found.join(again, "component", "left").select("node", F.coalesce("last", "component").alias("component"))
    # Nodes that had no component before.
    return stored(kept.unionByName(whole.join(found.select("node"), "node", "left_anti")), "components")
