"""Mixing sources to target weights, with DataFrame operations only.

Every row gets a hash-random key. Within a source, keys are cut into fixed ranges (by their leading hex digits), the sizes
of the ranges are summed, and a running sum over ranges and then within a range gives each row its exact place in the
source's random order. A source's budget takes whole epochs and then rows in that order, and cuts the row at the border.

The widest sort holds one range of one source: 1/4096 of it with the default ``key_digits``. Nothing is collected. The
tables with one row per source or per range are joined as Catalyst sees fit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from answerloom.llm.common import row_key
from answerloom.storage import BROADCAST_ROWS, materialize

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
KEY_DIGITS = 3
SEED = 17


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, place, target) from (source, size) rows.

    Sources in code-point order, null last, weigh ``weights`` in turn and share the sum of all sizes. A target above
    ``max_epochs`` times the source's size is cut to that and the excess shared by weight among the others: ordered by how
    soon they reach their limit, the sources up to some place are cut, and the rest share what is left at one rate.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (place % len(weights) + 1).cast("int"))
    listed = per_source.select("source", "source_size", place.alias("place"), weight.alias("weight"))
    everything = W.partitionBy(F.lit(0))
    soonest = everything.orderBy(F.col("limit") / F.col("weight"), "place")
    listed = listed.withColumn("limit", F.col("source_size") * max_epochs).select(
        "*",
        F.sum("source_size").over(everything).alias("total"),
        F.coalesce(F.sum("limit").over(soonest.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("cut"),
        F.sum("weight").over(soonest.rowsBetween(0, W.unboundedFollowing)).alias("sharing"),
    )
    rate = (F.col("total") - F.col("cut")) / F.col("sharing")
    rated = listed.withColumn("rate", F.when(F.col("limit") / F.col("weight") >= rate, rate))
    shared = F.col("weight") * F.coalesce(F.max("rate").over(everything), F.lit(0.0))
    return rated.select("source", "source_size", "place", F.least(F.col("limit").cast("double"), shared).alias("target"))


def _place(df: DataFrame, size: Column, id_col: str, seed: int) -> list[Column]:
    """What orders a source's rows: the random key first, then id, size and 64 bits of all columns."""
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(id_col).cast("string")))
    return [key.alias("key"), F.col(id_col).alias("id"), size.cast("long").alias("size"), row_key(*df.columns).alias("row_key")]


def mix(df: DataFrame, size: Column, id_col: str = "doc_id", source_col: str = "source", key_digits: int = KEY_DIGITS, seed: int = SEED) -> DataFrame:
    """(<id_col>, size, source_size, target, taken, copies, and the source, key and epochs it follows from): a row per row.

    ``taken`` is how much of the row's size the mix takes, epochs included; over a source it adds up to the rounded target.
    ``copies`` is the number of whole copies to write: the row at the border counts when at least half of it is taken, and
    a row of size 0, being free, goes along once. A null source is a source, null ids share one random key, and rows of
    one key are ordered by id, size and ``row_key`` (64 bits of all columns), so that reruns agree.
    """
    rows = df.select(F.col(source_col).alias("source"), *_place(df, size, id_col, seed))
    rows = materialize(rows, "sizes")  # read by each of the passes below
    targets = source_targets(rows.select("source", "size")).withColumnRenamed("source", "of")
    rows = rows.join(targets, F.col("source").eqNullSafe(F.col("of"))).withColumn("range", F.left("key", F.lit(key_digits)))
    sums = rows.groupBy("place", "range").agg(F.sum("size").alias("in_range"))
    before = F.sum("in_range").over(W.partitionBy("place").orderBy("range")) - F.col("in_range")
    sums = sums.select("place", "range", before.alias("before_range"))
    within = W.partitionBy("place", "range").orderBy("key", "id", "size", "row_key").rowsBetween(W.unboundedPreceding, W.currentRow)
    start = F.col("before_range") + F.sum("size").over(within) - F.col("size")
    rows = rows.join(sums, ["place", "range"]).withColumn("start", start)
    epochs = F.expr("if(source_size > 0, cast(round(target) as bigint) div source_size, 0)")
    rest = F.round("target").cast("long") - epochs * F.col("source_size")
    part = F.greatest(F.lit(0).cast("long"), F.least("size", rest - F.col("start")))
    whole = F.when(F.col("size") == 0, 1).otherwise(epochs + (part * 2 >= F.col("size")).cast("long"))
    taken = epochs * F.col("size") + part
    return rows.select(F.col("id").alias(id_col), "size", "source_size", "target", taken.alias("taken"), whole.alias("copies"), "source", "key", "row_key", epochs.alias("epochs"))


def take_mix(df: DataFrame, size: Column, id_col: str = "doc_id", source_col: str = "source", seed: int = SEED) -> DataFrame:
    """The rows of ``df``, each as often as the mix takes it, all columns unchanged.

    Within a source the rows up to some place in its random order are taken once more than the others, so a row is told
    by its place and its source's cut: one row per source is joined, and no text is shuffled. Rows that repeat all columns
    have one place and are taken equally often.
    """
    mixed = mix(df, size, id_col, source_col, seed=seed)
    place = F.struct("key", F.col(id_col).alias("id"), "size", "row_key")
    more = (F.col("size") > 0) & (F.col("copies") > F.col("epochs"))
    cuts = mixed.groupBy(F.col("source").alias("__source")).agg(F.max("epochs").alias("__epochs"), F.max(F.when(more, place)).alias("__cut"))
    cuts = materialize(cuts, "cuts")
    rows = df.withColumn("__place", F.struct(*_place(df, size, id_col, seed)))
    rows = rows.join(F.broadcast(cuts) if cuts.count() <= BROADCAST_ROWS else cuts, F.col(source_col).eqNullSafe(F.col("__source")))
    once_more = F.coalesce(F.col("__place") <= F.col("__cut"), F.lit(False)).cast("long")
    copies = F.when(F.col("__place.size") == 0, 1).otherwise(F.col("__epochs") + once_more)
    rows = rows.withColumn("__copies", copies).filter("__copies > 0")
    return rows.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "__copies"))).select(*df.columns)
