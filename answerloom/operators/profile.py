"""Corpus profile.

Statistics of integer columns are taken from their value counts. Counting is one hash aggregation with map-side
partials, after which means, exact quantiles and histograms work on one row per distinct value. Text lengths and
scores have few distinct values however many rows there are; an exact quantile over the rows themselves would instead
send every task's values to a single final one. For columns without such a bound there is ``approx_quantiles``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from answerloom.functions.features import dollar_count, has_display_math
from answerloom.functions.numbers import percent
from answerloom.functions.text import combined

BINS = 39
TRUNCATION_CHARS = 4000

# Lower bound, upper bound (exclusive) and label of the score and math-density buckets.
SCORE_BUCKETS = ((0, 1, "0"), (1, 5, "1-4"), (5, 10, "5-9"), (10, 50, "10-49"), (50, 200, "50-199"), (200, None, "200+"))
BELOW_ZERO = "below 0"
DENSITY_BUCKETS = ((0, 1, "0"), (1, 3, "1-2"), (3, 7, "3-6"), (7, 15, "7-14"), (15, 31, "15-30"), (31, None, "31+"))


def features(clean: DataFrame, *carry: str) -> DataFrame:
    """Length, score and math-markup features of instruction rows."""
    text = combined(F.col("instruction"), F.col("output"))
    return clean.select(
        *carry,
        "q_len",
        "a_len",
        "q_score",
        "a_count",
        dollar_count(text).alias("latex_total"),
        has_display_math(text).alias("has_display"),
    )


def value_counts(df: DataFrame, *series: str) -> DataFrame:
    """(series, value, n) of the named integer columns, in one pass."""
    pairs = [F.struct(F.lit(s).alias("series"), F.col(s).cast("long").alias("value")) for s in series]
    return df.select(F.inline(F.array(*pairs))).groupBy("series", "value").agg(F.count("*").alias("n"))


def quantile(q: float) -> Column:
    """Exact quantile with linear interpolation, as an aggregate over value counts."""
    return F.percentile("value", q, F.col("n"))


def summary(counts: DataFrame) -> DataFrame:
    """Rows, zero rows, mean, median and maximum per series."""
    return counts.groupBy("series").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("value") == 0, F.col("n")).otherwise(0)).alias("n_zero"),
        (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"),
        quantile(0.5).alias("median"),
        F.max("value").alias("max"),
    )


def quantiles(counts: DataFrame, q: float = 0.99) -> DataFrame:
    return counts.groupBy("series").agg(quantile(q).alias("quantile"))


def approx_quantiles(df: DataFrame, *series: str, q: float = 0.99, accuracy: int = 10_000) -> DataFrame:
    """Approximate quantiles of columns with very many distinct values."""
    pairs = [F.struct(F.lit(s).alias("series"), F.col(s).alias("value")) for s in series]
    found = F.percentile_approx("value", q, accuracy).alias("quantile")
    return df.select(F.inline(F.array(*pairs))).groupBy("series").agg(found)


def length_histogram(counts: DataFrame) -> DataFrame:
    """(series, bin, lo, hi, n) over equal bins on [0, largest 99th percentile].

    Each series is clipped at its own 99th percentile. Bins are closed on the left, the last one on both sides; empty
    bins are listed. A value on a bin edge goes where comparing it with the edge puts it, not where rounding does.
    """
    overall = Window.partitionBy(F.lit(0))
    scale = quantiles(counts).withColumn("step", F.max("quantile").over(overall) / F.lit(float(BINS)))
    x, step = F.col("x"), F.col("step")
    guess = F.floor(x / F.nullif(step, F.lit(0.0))).cast("int")
    exact = F.when(x < guess * step, guess - 1).when(x >= (guess + 1) * step, guess + 1).otherwise(guess)
    last = F.lit(BINS - 1)
    filled = (
        counts.join(F.broadcast(scale), "series")
        .withColumn("x", F.least(F.col("value").cast("double"), "quantile"))
        .withColumn("bin", F.least(F.coalesce(exact, last), last))
        .groupBy("series", "bin")
        .agg(F.sum("n").alias("n"))
    )
    grid = scale.select("series", "step", F.explode(F.sequence(F.lit(0), last)).alias("bin"))
    return grid.join(filled, ["series", "bin"], "left").select(
        "series",
        "bin",
        (F.col("bin") * step).alias("lo"),
        ((F.col("bin") + 1) * step).alias("hi"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def _in_bucket(value: Column, lo: int, hi: int | None) -> Column:
    return value >= lo if hi is None else (value >= lo) & (value < hi)


def score_profile(df: DataFrame) -> DataFrame:
    """Rows and mean answer length per score bucket, up to the bucket of the highest score; empty buckets read 0.

    Rows with negative scores, where there are any, come in a bucket of their own, ``below 0`` with a null bound.
    """
    score, a_len = F.col("q_score"), F.col("a_len")
    buckets = [(None, 0, BELOW_ZERO), *SCORE_BUCKETS]
    inside = [score < 0, *[_in_bucket(score, lo, hi) for lo, hi, _ in SCORE_BUCKETS]]
    one = df.agg(
        F.max(score).alias("top"),
        *[F.count_if(b).alias(f"n{i}") for i, b in enumerate(inside)],
        *[F.avg(F.when(b, a_len)).alias(f"avg{i}") for i, b in enumerate(inside)],
    )
    rows = [
        F.struct(
            F.lit(lo).cast("int").alias("lo"),
            F.lit(label).alias("bucket"),
            F.col(f"n{i}").alias("n"),
            F.coalesce(F.col(f"avg{i}"), F.lit(0.0)).alias("avg_a_len"),
        )
        for i, (lo, _, label) in enumerate(buckets)
    ]
    shown = (F.col("lo") <= F.col("top")) | (F.col("lo").isNull() & (F.col("n") > 0))
    return one.select("top", F.inline(F.array(*rows))).filter(shown).drop("top")


def density_profile(df: DataFrame) -> DataFrame:
    """Rows, and their share in percent, per bucket of ``$`` counts."""
    inside = [_in_bucket(F.col("latex_total"), lo, hi) for lo, hi, _ in DENSITY_BUCKETS]
    one = df.agg(F.count("*").alias("total"), *[F.count_if(b).alias(f"n{i}") for i, b in enumerate(inside)])
    rows = [
        F.struct(
            F.lit(lo).alias("lo"),
            F.lit(label).alias("bucket"),
            F.col(f"n{i}").alias("n"),
            percent(F.col(f"n{i}"), F.col("total")).alias("pct"),
        )
        for i, (lo, _, label) in enumerate(DENSITY_BUCKETS)
    ]
    return one.select(F.inline(F.array(*rows)))


def display_share(df: DataFrame) -> DataFrame:
    """Rows without math, and the percentage of rows with display math."""
    return df.agg(
        F.count_if(F.col("latex_total") == 0).alias("no_math_rows"),
        percent(F.count_if("has_display"), F.count("*")).alias("pct_display"),
    )


def truncation_risk(df: DataFrame, length: str, limit: int = TRUNCATION_CHARS) -> DataFrame:
    """How many rows are longer than ``limit`` characters; meant for text before the length filter."""
    over = F.count_if(F.col(length) > limit)
    return df.agg(F.count("*").alias("n"), over.alias("n_over"), percent(over, F.count("*")).alias("pct_over"))
