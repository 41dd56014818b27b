"""Exact shares and large samples by selection, without a sort of the rows.

Every row has a place that follows from the seed and its key: the digest of both, then a hash of the row, as hexadecimal text. The
k-th place is found like a digit at a time: rows are counted by the next three digits, which tasks pre-aggregate to 4,096
numbers, and only the bucket that holds the k-th place is refined, until it has few rows or rows that are all alike. What is up
to a place is then a filter. Nothing depends on how rows are dealt, and no task holds more than a bucket.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from answerloom.config import SplitConfig

DIGITS = 3
FEW_ROWS = 10_000  # a bucket that is sorted by the driver's side of a job


def place(key: str, columns: list[str], seed: int = 42) -> Column:
    """48 hexadecimal digits: md5 of seed and key, then 64 bits of all columns. A null key has a place too."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(key).cast("string"), F.lit("\0"))))
    return F.concat(digest, F.lower(F.lpad(F.hex(F.xxhash64(*columns)), 16, "0")))


@dataclass(frozen=True)
class Cut:
    """The place of the k-th row, and how many rows of exactly that place are among the first k (None: all of them)."""

    place: str
    equal: int | None


def nth_place(places: DataFrame, k: int, total: int) -> Cut | None:
    """The cut after the first ``k`` of the ``total`` rows of ``places`` (place); None when there are no more rows than that."""
    if k >= total:
        return None
    if k <= 0:
        return Cut("", None)  # before all
    prefix, left, size = "", k, total
    while size > FEW_ROWS and len(prefix) < 48:
        inside = places.filter(F.col("place").startswith(prefix)) if prefix else places
        counts = inside.groupBy(F.substring("place", len(prefix) + 1, DIGITS).alias("next")).count()
        for x in sorted(counts.collect(), key=lambda x: x["next"]):  # 4,096 rows at most
            if left <= x["count"]:
                prefix, size = prefix + x["next"], x["count"]
                break
            left -= x["count"]
    if len(prefix) == 48:
        return Cut(prefix, left if left < size else None)
    rest = [x.place for x in places.filter(F.col("place").startswith(prefix)).orderBy("place").collect()]  # FEW_ROWS at most
    found = rest[left - 1]
    before, equal = rest.index(found), rest.count(found)
    return Cut(found, left - before if left - before < equal else None)


def up_to(rows: DataFrame, cut: Cut | None) -> DataFrame:
    """``rows`` with ``first``, whether their ``place`` is among the rows of the cut."""
    if cut is None:
        return rows.withColumn("first", F.lit(True))
    if cut.equal is None:
        return rows.withColumn("first", F.col("place") <= cut.place)
    # Rows that are alike in all columns lie on both sides of the cut; which of them, does not matter.
    alike = rows.filter(F.col("place") == cut.place).withColumn("_nth", F.row_number().over(Window.partitionBy("place").orderBy("place")))
    alike = alike.withColumn("first", F.col("_nth") <= cut.equal).drop("_nth")
    return rows.filter(F.col("place") != cut.place).withColumn("first", F.col("place") < cut.place).unionByName(alike)


def sample_exact(df: DataFrame, key: str, k: int, seed: int = 42) -> DataFrame:
    """The ``k`` rows of the smallest places (all, when there are fewer), the same for any layout. Reads ``df`` a few times."""
    rows = df.withColumn("place", place(key, df.columns, seed))
    return up_to(rows, nth_place(rows.select("place"), k, df.count())).filter("first").select(*df.columns)


def assign_split_exact(df: DataFrame, key: str = "content_hash", cfg: SplitConfig = SplitConfig()) -> DataFrame:
    """Add ``split`` so that the splits hold their shares of the rows exactly, to the rounding of one row, on any layout.

    The rows of the smallest places are the training rows, the next validation. Rows that repeat a key lie next to one another,
    so at most two keys are in more than one split. Reads ``df`` a few times, so pass a written table.
    """
    total = df.count()
    rows = df.withColumn("place", place(key, df.columns, cfg.seed))
    places = rows.select("place")
    train = nth_place(places, round(cfg.train * total), total)
    both = nth_place(places, round((cfg.train + cfg.validation) * total), total)
    rows = up_to(rows, both).withColumnRenamed("first", "_seen")
    rows = up_to(rows, train).withColumn("split", F.when(F.col("first"), "train").when(F.col("_seen"), "validation").otherwise("test"))
    return rows.select(*df.columns, "split")
