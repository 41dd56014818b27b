"""Duplicates by any of several keys, closed transitively.

Rows are alike when they share a key, and so are rows that a chain of such rows connects: (u1, h1), (u2, h1), (u2, h2) are one.
Keys are the nodes of a graph, a row links its own. Links whose keys occur nowhere else are settled at once; the others
are contracted to stars, every key hanging its larger neighbours onto its smallest one (large star) and its smaller ones with
itself (small star), in a number of rounds that grows with the logarithm of the longest chain.

A key that a third of all rows share costs a row per task where neighbours are compared, since minima are combined before the
shuffle. Where such keys are looked up they are few, and are broadcast; only the others are joined by a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerloom.operators.dedup import keep_first
from answerloom.storage import BROADCAST_ROWS, discard, materialize

KEYS = ("uid", "content_hash")
HEAVY_ROWS = 100_000  # rows of one key beyond which the key is broadcast


def lookup(rows: DataFrame, table: DataFrame, key: str, counts: DataFrame | None = None) -> DataFrame:
    """``rows`` left-joined with ``table``, which has one row per key; hot keys of ``rows`` do not move.

    ``counts`` (key, n: rows of that key) spares counting. All are read more than once, so pass written tables. Of the keys of
    more than ``HEAVY_ROWS`` rows there are fewer than rows / HEAVY_ROWS; should even these be many, only those above an
    equal share of the broadcast bound count as hot.
    """
    counts = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")) if counts is None else counts
    hot = counts.filter(F.col("n") > HEAVY_ROWS)
    size = hot.agg(F.count("*").alias("keys"), F.sum("n").alias("rows")).first()
    if not size["keys"]:
        return rows.join(table, key, "left")
    least = HEAVY_ROWS if size["keys"] <= BROADCAST_ROWS else size["rows"] // BROADCAST_ROWS
    hot = materialize(hot.filter(F.col("n") > least).select(key, F.lit(True).alias("_hot")), "hot-keys")
    marked = rows.join(F.broadcast(hot), key, "left")
    few = table.join(F.broadcast(hot.select(key)), key, "left_semi")
    near = marked.filter("_hot").join(F.broadcast(few), key, "left")
    return near.unionByName(marked.filter("_hot IS NULL").join(table, key, "left")).drop("_hot")


def _node(key: str) -> Column:
    return F.unhex(F.md5(F.concat(F.lit(f"{key}|").cast("binary"), F.col(key).cast("binary"))))


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``links`` (a, b): the smallest node that each is connected with.

    Links point either way and may repeat; rows with a null, and links of a node with itself, are left out.
    """
    ends = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    links = materialize(links.filter("a IS NOT NULL AND b IS NOT NULL AND a != b").select(*ends).distinct(), "links")
    done = []
    before, state = None, _state(links)
    while state != before and state[0]:
        both = links.union(links.select("b", "a"))
        around = materialize(both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")), "nearest")
        if before is None:
            # A pair of nodes that nothing else touches is a component.
            alone = around.filter("n = 1").select("a", "m")
            pairs = alone.join(alone.select(F.col("m").alias("a"), F.col("a").alias("m")), ["a", "m"], "left_semi")
            pairs = materialize(pairs, "lone-pairs")
            done.append(pairs.select(F.col("a").alias("node"), F.least("a", "m").alias("component")))
            both = both.join(pairs.select("a"), "a", "left_anti")
        least = around.select("a", F.least("a", "m").alias("m"))
        large = lookup(both, least, "a", around.select("a", "n")).filter("b > a").select(F.col("m").alias("a"), "b").filter("a < b").distinct()
        large = materialize(large, "large-star")
        below = materialize(large.groupBy("b").agg(F.min("a").alias("m"), F.count("*").alias("n")), "nearest")
        ends = [F.struct(F.col("m").alias("a"), F.col(end).alias("b")) for end in ("b", "a")]
        small = lookup(large, below.select("b", "m"), "b", below.select("b", "n")).select(F.inline(F.array(*ends)))
        new = materialize(small.filter("a < b").distinct(), "small-star")
        discard(links, around, large, below)
        links = new
        before, state = state, _state(links)
    stars = links.select(F.col("b").alias("node"), F.col("a").alias("component"))
    stars = stars.union(links.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
    for found in done:
        stars = stars.union(found)
    return stars


def with_component(df: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """``df`` with ``component``, a label that rows have in common when keys connect them; null for rows without any key.

    A null key connects nothing. Reads ``df`` more than once.
    """
    first = F.coalesce(*[_node(k) for k in keys])
    rows = df.withColumn("_first", first)
    links = rows.select("_first", F.explode(F.array(*[_node(k) for k in keys])).alias("b")).select(F.col("_first").alias("a"), "b").distinct()
    found = materialize(components(links).select(F.col("node").alias("_first"), "component"), "components")
    labelled = lookup(rows, found, "_first")
    return labelled.withColumn("component", F.coalesce("component", "_first")).drop("_first")


def dedup_linked(df: DataFrame, ties: tuple[str, ...] = ("row_id",), keys: tuple[str, ...] = KEYS) -> DataFrame:
    """One row of each set of rows that keys connect, the best by the order of ``dedup.keep_first``; rows without keys all stay."""
    rows = with_component(df, keys)
    return keep_first(rows.filter("component IS NOT NULL"), "component", ties).unionByName(rows.filter("component IS NULL")).drop("component")
