"""Sharding by best-fit-decreasing bin packing.

Indivisible groups enter, in order of falling size, the bin with the least remaining room that still holds them; a balanced
tree keeps the bins ordered by room. The packing itself is sequential, so it runs over a number of items that does not
grow with the data: a group above a fixed share of the total is an item of its own, smaller groups are gathered by hash
into as many parcels, and a group larger than a shard is cut into pieces (equal rows, so pieces of equal size) that each
count as an item. With ``grain`` items per shard the items number at most a few times ``grain * n_shards``.

Rows are sized, grouped, assigned and numbered by Spark; the driver sees one (item, bytes) row per item.
"""

from __future__ import annotations

import bisect

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from answerloom.llm.common import text_or_empty
from answerloom.storage import materialize

N_SHARDS = 40
GRAIN = 64
ROW_BYTES = 16


class RoomTree:
    """Bins ordered by (room, bin): a treap, balanced by priorities that are hashes of the bin."""

    def __init__(self):
        self.root = None  # [room, bin, priority, left, right]

    def add(self, room: int, number: int) -> None:
        node = [room, number, (number * 0x9E3779B97F4A7C15 + 0x7F4A7C15) & 0xFFFFFFFFFFFFFFFF, None, None]
        less, more = self._split(self.root, (room, number))
        self.root = self._merge(self._merge(less, node), more)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """Take out the bin with the least room of at least ``size``, the lowest number among equals."""
        less, more = self._split(self.root, (size, -1))
        if more is None:
            self.root = less
            return None
        first = more
        while first[3] is not None:
            first = first[3]
        _, rest = self._split(more, (first[0], first[1] + 1))
        self.root = self._merge(less, rest)
        return first[0], first[1]

    def _split(self, node, key):
        """Nodes below ``key``, and the others."""
        if node is None:
            return None, None
        node = list(node)
        if (node[0], node[1]) < key:
            less, more = self._split(node[4], key)
            node[4] = less
            return node, more
        less, more = self._split(node[3], key)
        node[3] = more
        return less, node

    def _merge(self, a, b):
        if a is None or b is None:
            return b if a is None else a
        if a[2] > b[2]:
            a = list(a)
            a[4] = self._merge(a[4], b)
            return a
        b = list(b)
        b[3] = self._merge(a, b[3])
        return b


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """The bin of each item; bins of ``capacity`` open when no open one holds the item, items above it get one alone."""
    tree, bins, opened = RoomTree(), [0] * len(sizes), 0
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = tree.tightest(sizes[i])
        if found is None:
            found, opened = (capacity, opened), opened + 1
        bins[i] = found[1]
        tree.add(max(0, found[0] - sizes[i]), found[1])
    return bins


def pack_into(sizes: list[int], n_bins: int) -> list[int]:
    """Best fit decreasing with the smallest capacity, found by bisection, that needs no more than ``n_bins`` bins.

    An item above the mean of what it leaves to the other bins has a bin to itself. At the others' mean plus their largest
    size nothing lacks room: otherwise every bin would be filled beyond the mean.
    """
    rest, left, bins = sorted(sizes), sum(sizes), n_bins
    while bins > 1 and rest and rest[-1] * bins > left:
        left, bins = left - rest.pop(), bins - 1
    if not rest:
        return best_fit_decreasing(sizes, 1)
    low = max(1, -(-left // bins))
    fits = lambda capacity: max(best_fit_decreasing(sizes, capacity)) < n_bins
    span = range(low, low + rest[-1] + 1)
    return best_fit_decreasing(sizes, span[bisect.bisect_left(span, True, key=fits)])


def shard(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_shards: int = N_SHARDS, grain: int = GRAIN) -> DataFrame:
    """(<id_col>, size, text_crc32, shard, slot): one row per input row, shards of near equal bytes.

    Size is the text's UTF-8 bytes plus 16. Rows of equal texts stay in one shard unless together they exceed a shard;
    null counts as an empty text. ``slot`` numbers a shard's rows without gaps from 0. Rows that repeat id and text get
    slots of their own. An empty table gives an empty result.
    """
    text = text_or_empty(text_col)
    rows = df.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.unhex(F.md5(text.cast("binary"))).alias("group"),
    )
    rows = materialize(rows, "sizes")
    total, n_rows = rows.agg(F.sum("size"), F.count("*")).first()
    limit = max(1, (total or 0) // (n_shards * grain))  # at most n_shards * grain groups are larger
    capacity = max(1, (total or 0) // n_shards)
    groups = rows.groupBy("group").agg(F.sum("size").alias("bytes"))
    pieces = F.when(F.col("bytes") > capacity, F.ceil(F.col("bytes") * 8 / capacity)).otherwise(1).cast("int")
    large = F.broadcast(groups.filter(F.col("bytes") > limit).select("group", pieces.alias("pieces"), F.hex("group").alias("name")))
    item = F.when(F.col("name").isNull(), F.pmod(F.xxhash64("group"), F.lit(n_shards * grain)).cast("string")).otherwise(
        F.concat_ws("/", "name", F.pmod(F.xxhash64("id", F.lit("piece")), F.col("pieces")))
    )
    rows = materialize(rows.join(large, "group", "left").select("id", "size", "text_crc32", item.alias("item")), "items")
    sizes = rows.groupBy("item").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).orderBy("item").collect()

    per_cell = max(1, n_rows // (n_shards * grain))  # rows numbered by one sort
    placed = [(x.item, b, -(-x.n // per_cell)) for x, b in zip(sizes, pack_into([x.bytes for x in sizes], n_shards), strict=True)]
    places = F.broadcast(df.sparkSession.createDataFrame(placed, "item string, shard int, cells long"))
    rows = rows.join(places, "item").withColumn("cell", F.pmod(F.xxhash64("id", F.lit("cell")), F.col("cells")))
    cells = rows.groupBy("shard", "item", "cell").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("shard").orderBy("item", "cell")) - F.col("n")
    cells = F.broadcast(cells.select("item", "cell", before.alias("before")))
    number = F.row_number().over(W.partitionBy("item", "cell").orderBy("id", "text_crc32", "size")) - 1
    rows = rows.withColumn("number", number).join(cells, ["item", "cell"])
    return rows.select(F.col("id").alias(id_col), "size", "text_crc32", "shard", (F.col("before") + F.col("number")).alias("slot"))
