"""Quantiles and histograms that grow with the corpus: KLL sketches per batch, stored, merged and asked.

A sketch of an integer column takes a few kilobytes however many rows it saw. Each batch of rows leaves one sketch per series in
the store, in a folder of its own that a retry or a second run of the batch replaces, so no row counts twice; rows
seen before are never read again. Merged sketches answer with a normalised rank error that ``k`` sets, about 2.3 / k**0.9.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

K = 800  # a rank error below 0.6 %
BATCH = "batch"


def sketch(df: DataFrame, *series: str, k: int = K) -> DataFrame:
    """(series, sketch, n, low, high) of the named integer columns in one pass; nulls are left out, a series without values too.

    Sketched per task and merged, so what is shuffled is a sketch a task and series.
    """
    pairs = [F.struct(F.lit(s).alias("series"), F.col(s).cast("long").alias("value")) for s in series]
    rows = df.select(F.inline(F.array(*pairs))).filter("value IS NOT NULL")
    return rows.groupBy("series").agg(
        F.kll_sketch_agg_bigint("value", k).alias("sketch"), F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
    )


def add_batch(df: DataFrame, store: str, batch: str, *series: str, k: int = K) -> None:
    """Sketch a batch into the store; what the store held of that batch is replaced."""
    rows = sketch(df, *series, k=k).withColumn(BATCH, F.lit(batch)).coalesce(1)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(store)


def merged(spark: SparkSession, store: str, batches: list[str] | None = None, k: int = K) -> DataFrame:
    """(series, sketch, n, low, high) over the batches of a store (None: all)."""
    rows = spark.read.schema(f"series string, sketch binary, n long, low long, high long, {BATCH} string").parquet(store)
    rows = rows if batches is None else rows.filter(F.col(BATCH).isin(batches))
    return merge(rows, k)


def merge(rows: DataFrame, k: int = K) -> DataFrame:
    """Sketches of the same series put together."""
    return rows.groupBy("series").agg(
        F.kll_merge_agg_bigint("sketch", k).alias("sketch"), F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")
    )


def sketch_quantiles(found: DataFrame, *shares: float) -> DataFrame:
    """(series, share, quantile): values of the rows at these shares of the order."""
    asked = F.array(*[F.lit(float(q)) for q in shares])
    pairs = F.arrays_zip(asked.alias("share"), F.kll_sketch_get_quantile_bigint("sketch", asked).alias("quantile"))
    return found.select("series", F.inline(pairs)).toDF("series", "share", "quantile")


def sketch_histogram(found: DataFrame, edges: list[int]) -> DataFrame:
    """(series, bin, lo, hi, n): about how many rows lie in each bin (lo, hi], the first one holding ``lo`` too.

    Counts are whole numbers; those of all bins add up to the rows between the first and the last edge, about.
    """
    asked = [edges[0] - 1, *edges[1:]]
    ranks = F.kll_sketch_get_rank_bigint("sketch", F.array(*[F.lit(e).cast("long") for e in asked]))
    rows = found.select("*", ranks.alias("ranks"))

    def up_to(i: int) -> Column:
        """How many rows are up to the i-th edge, about."""
        edge = F.lit(asked[i])
        inside = F.round(F.element_at("ranks", i + 1) * F.col("n"))
        return F.when(edge < F.col("low"), 0).when(edge >= F.col("high"), F.col("n")).otherwise(inside).cast("long")

    bins = [
        F.struct(F.lit(i).alias("bin"), F.lit(lo).cast("long").alias("lo"), F.lit(hi).cast("long").alias("hi"), (up_to(i + 1) - up_to(i)).alias("n"))
        for i, (lo, hi) in enumerate(zip(edges, edges[1:]))
    ]
    return rows.select("series", F.inline(F.array(*bins)))
