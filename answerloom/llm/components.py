"""Connected components of a table of links, by alternating large and small stars.

In a large star every node hangs its larger neighbours onto its smallest one, in a small star its smaller neighbours and
itself; the links shrink to stars around the smallest node of each component in a number of rounds that grows with the
logarithm of its size. A node's smallest neighbour is a map-side combined minimum, so a node with a third of all links costs a
row per task there, and joins on it are left to adaptive execution to split. Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerloom.storage import discard, materialize


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) for each node of ``links`` (a long, b long): the smallest node that it reaches.

    Links may be repeated, point either way or lead from a node to itself; rows with a null are left out.
    """
    ends = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]  # a < b
    links = materialize(links.filter("a is not null and b is not null").select(*ends).distinct(), "links")
    nodes = materialize(links.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "nodes")
    before, state, last = None, _state(links.filter("a < b")), links
    links = links.filter("a < b")
    while state != before:
        both = links.union(links.select("b", "a"))  # node a and its neighbour b
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("m").alias("a"), "b").filter("a < b").distinct()
        large = materialize(large, "large-star")
        least = large.groupBy("b").agg(F.min("a").alias("m"))  # node b and its smaller neighbours a
        small = large.join(least, "b").select(F.explode(F.array(F.struct(F.col("m").alias("a"), F.col("b")), F.struct(F.col("m").alias("a"), F.col("a").alias("b")))).alias("x"))
        links = materialize(small.select("x.a", "x.b").filter("a < b").distinct(), "small-star")
        discard(last, large)
        last = links
        before, state = state, _state(links)
    return nodes.join(links.select(F.col("b").alias("node"), F.col("a").alias("component")), "node", "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )
