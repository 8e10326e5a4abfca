"""Connected components of a table of links, by contraction.

Each round every node picks the neighbour, or itself, of least random priority as its parent, one
further step is taken along the parents, links are renamed to parents and those within a node go.
A round leaves a fraction of the nodes that have links, so few rounds suffice whatever the shape of
the graph. The first round goes by the nodes themselves, since most links here lead to the least node of a bucket or
unit; after that priorities hold for two rounds: in the first a star's hub goes to its least leaf, in the second all other
leaves follow. Hot nodes are harmless: parents come from a grouped minimum, which is combined before the
shuffle, and renaming is an equi-join whose skewed side Spark splits. Every round is written to the
shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlight.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """links: a, b (non-null, of one type). Returns node, component (its least node), for nodes that have links."""
    edges = cut(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    steps, level = [], 0
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select("b", "a"))
        priority = lambda c: F.xxhash64(F.lit((level + 1) // 2), c) if level else F.col(c)  # noqa: B023, E731
        rank = lambda c: F.struct(priority(c).alias("p"), F.col(c).alias("n"))  # noqa: B023, E731
        parents = both.groupBy("a").agg(F.min(rank("b")).alias("best"), F.first(rank("a")).alias("own"))
        parents = cut(parents.select(F.col("a").alias("node"), F.least("best", "own")["n"].alias("parent")), "parents")
        further = parents.select(F.col("node").alias("parent"), F.col("parent").alias("root"))
        parents = cut(parents.join(further, "parent", "left").select("node", F.coalesce("root", "parent").alias("parent")), "parents")
        steps.append(parents)
        renamed = edges.join(parents.select(F.col("node").alias("a"), F.col("parent").alias("pa")), "a").join(parents.select(F.col("node").alias("b"), F.col("parent").alias("pb")), "b")
        renamed = renamed.where("pa <> pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct()
        edges, level = cut(renamed, "links"), level + 1
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    # Back from the last round to the first: a parent's root, or the parent itself where it had no more links.
    roots = steps[-1]
    for earlier in reversed(steps[:-1]):
        later = roots.select(F.col("node").alias("parent"), F.col("parent").alias("root"))
        roots = earlier.join(later, "parent", "left").select("node", F.coalesce("root", "parent").alias("parent"))
    roots = cut(roots, "roots")
    least = roots.groupBy("parent").agg(F.min("node").alias("component"))
    return roots.join(least, "parent").select("node", "component")
