"""Train / validation / test assignment, its checks, and seeded samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerloom.config import SplitConfig
from answerloom.functions.numbers import hash_bucket, percent
from answerloom.operators.quota import FEW_ROWS, sample_exact

BUCKETS = 10_000


def _by_share(position: Column, cfg: SplitConfig, scale: int) -> Column:
    return (
        F.when(position.isNull(), None)
        .when(position < round(cfg.train * BUCKETS) * scale / BUCKETS, "train")
        .when(position < round((cfg.train + cfg.validation) * BUCKETS) * scale / BUCKETS, "validation")
        .otherwise("test")
    )


def assign_split(df: DataFrame, key: str = "content_hash", cfg: SplitConfig = SplitConfig()) -> DataFrame:
    """Add ``split``, fixed by the key and the seed alone: same result for any layout, equal keys stay together.

    A row without a key gets no split, which ``check_conservation`` then reports.
    """
    bucket = hash_bucket(F.col(key), BUCKETS, f"{cfg.seed}|")
    return df.withColumn("split", _by_share(bucket, cfg, BUCKETS))


def assign_split_random(df: DataFrame, cfg: SplitConfig = SplitConfig()) -> DataFrame:
    """Add ``split`` from a seeded random draw per row.

    One draw decides a row, so the splits always add up. The draw depends on the row's partition and position: pass a
    written table, and prefer ``assign_split`` where the result must outlive a change of layout.
    """
    drawn = df.withColumn("_draw", F.rand(cfg.seed))
    return drawn.withColumn("split", _by_share(F.col("_draw"), cfg, 1)).drop("_draw")


def split_counts(df: DataFrame, cfg: SplitConfig = SplitConfig()) -> DataFrame:
    """(split, n, pct), a split without rows included. One aggregation of fixed width."""
    counted = df.agg(F.count("*").alias("total"), *[F.count_if(F.col("split") == s).alias(s) for s in cfg.shares])
    rows = [
        F.struct(F.lit(s).alias("split"), F.col(s).alias("n"), percent(F.col(s), F.col("total")).alias("pct"))
        for s in cfg.shares
    ]
    return counted.select(F.inline(F.array(*rows)))


def check_conservation(counts: DataFrame, expected: int) -> DataFrame:
    """``counts`` itself, or ValueError when the splits do not add up to ``expected`` rows exactly."""
    total = sum(r["n"] for r in counts.select("n").collect())
    if total != expected:
        raise ValueError(f"the splits hold {total} rows, expected {expected}")
    return counts


def leakage(df: DataFrame, keys: tuple[str, ...] = ("uid", "content_hash")) -> DataFrame:
    """Per key kind: distinct keys, and how many of them occur in more than one split.

    A key's splits are or-ed into a bit mask before the shuffle, so a hot key costs one small row per task.
    """
    code = F.when(F.col("split") == "train", 1).when(F.col("split") == "validation", 2).otherwise(4)
    kinds = F.array(*[F.struct(F.lit(k).alias("key_kind"), F.col(k).alias("key")) for k in keys])
    masks = (
        df.select(code.alias("code"), F.inline(kinds))
        .groupBy("key_kind", "key")
        .agg(F.bit_or("code").alias("mask"))
    )
    return masks.groupBy("key_kind").agg(
        F.count("*").alias("keys"), F.count_if(F.bit_count("mask") > 1).alias("leaking_keys")
    )


def check_leakage(found: DataFrame) -> DataFrame:
    """``leakage`` rows themselves, or ValueError when a key occurs in more than one split."""
    leaking = [(r["key_kind"], r["leaking_keys"]) for r in found.collect() if r["leaking_keys"]]
    if leaking:
        raise ValueError(f"keys occur in more than one split: {leaking}")
    return found


def sample_k(df: DataFrame, key: str, k: int = 50, seed: int = 42) -> DataFrame:
    """A seeded sample of ``k`` rows (all, when there are fewer), the same for any layout.

    Up to ``FEW_ROWS`` are taken in order, more by ``quota.sample_exact``: the same rows where keys are distinct.
    """
    if k > FEW_ROWS:
        return sample_exact(df, key, k, seed)
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))
    return df.orderBy(digest, key).limit(k)
