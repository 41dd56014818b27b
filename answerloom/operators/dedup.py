"""Deterministic duplicate removal.

Copies are ranked by a total order, so the kept row does not depend on how the input is laid out. The rank filter
plans a group limit below the shuffle: a map task sends at most one row per key, so a key that holds a third of all
rows costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Columns the two passes need; see ``shape.with_keys``.
KEY_COLUMNS = ("uid", "content_hash", "q_score", "a_len", "text_md5")


def keep_first(df: DataFrame, key: str, ties: tuple[str, ...] = ("row_id",)) -> DataFrame:
    """One row per ``key``: highest score, then longest answer, then smallest text digest, then ``ties``."""
    order = [F.desc("q_score"), F.desc("a_len"), "text_md5", *ties]
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def dedup_uid(df: DataFrame, ties: tuple[str, ...] = ("row_id",)) -> DataFrame:
    return keep_first(df, "uid", ties)


def dedup_content(df: DataFrame, ties: tuple[str, ...] = ("row_id",)) -> DataFrame:
    return keep_first(df, "content_hash", ties)


def dedup_two_pass(df: DataFrame, ties: tuple[str, ...] = ("row_id",)) -> DataFrame:
    """First one row per uid, then one row per content hash among those."""
    return dedup_content(dedup_uid(df, ties), ties)
