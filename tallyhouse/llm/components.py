"""Connected components of a table of links, by alternating star contractions."""

from pyspark.sql import functions as F

from tallyhouse.llm.base import stored


def _smallest(links):
    """Each node's smallest neighbour, itself included."""
    both = links.select("a", "b").union(links.select("b", "a"))
    return both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))


def _are_stars(links):
    """Whether every node hangs on one other that hangs on none; true without links."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).union(
        links.select("b", F.lit(0), F.lit(1))
    )
    nodes = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return not nodes.agg(F.max(F.expr("hangs > 1 or hangs = 1 and holds = 1"))).first()[0]


def connected(links):
    """(node, label) for every node of the links (a, b), label being the smallest node of its component.

    Each turn hangs every neighbour of a node on the smallest one around it, first from larger nodes, then from smaller
    ones; the number of turns grows with the logarithm of the longest chain. What a turn leaves is written to the shared
    folder. The smallest neighbours are written too: both sides of the joins then come straight from tables, so that
    adaptive execution can split a node with very many links. Links that are null or join a node to itself are left out;
    without links the result is empty.
    """
    links = links.where("a is not null and b is not null and a <> b")
    links = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while not _are_stars(links):
        # From each node u: its larger neighbours v hang on the smallest node around u.
        low = stored(_smallest(links), "low")
        both = links.select("a", "b").union(links.select("b", "a"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = stored(large.where("a <> b").distinct(), "links")
        # From each node u: u and its smaller neighbours hang on the smallest of these.
        low = stored(large.groupBy("a").agg(F.min("b").alias("low")), "low")
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b")
        links = stored(small.union(low.select("a", F.col("low").alias("b"))).distinct(), "links")
    return links.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    )
