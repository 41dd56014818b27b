"""Exact duplicates by progressive refinement, with DataFrame operations only.

Rows are grouped by the length of their normalised text, what shares a length by a hash of the text's head, and what
shares that by a hash of the whole text. The whole text is hashed for the rows that are left after two rounds only: while
these are few their keys are broadcast to the scan, beyond ``storage.BROADCAST_ROWS`` the scan hashes every text and
ships digests, so that no text is shuffled either way. The result is the same.

Every group is counted map-side, so a group of copies that holds a third of all rows costs a row per map task. A row is
named by 64 bits of its id and text, and rows that repeat both are counted as one with a multiplicity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerloom.llm.common import joined, keep_rows, matching, one_space, row_key
from answerloom.storage import BROADCAST_ROWS, materialize

HEAD_CHARS = 64


def digest(text: str):
    return F.unhex(F.sha2(one_space(text), 256))


def duplicate_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", head_chars: int = HEAD_CHARS) -> DataFrame:
    """(row_key, id, n_rows, keep_id, group_size): a row for each distinct id and text.

    ``n_rows`` is how often that id and text occur. Null texts count as empty. ``keep_id`` is the smallest id of the
    group; null ids come after all others, so it is null only where the whole group has none. An empty table gives none.
    """
    text = one_space(text_col)
    rows = df.select(row_key(id_col, text_col).alias("row_key"), F.col(id_col).alias("id"), text.alias("t"))
    rows = rows.select("row_key", "id", F.octet_length("t").alias("length"), F.xxhash64(F.substring("t", 1, head_chars)).alias("head"))
    rows = materialize(rows.groupBy("row_key", "id", "length", "head").agg(F.count("*").alias("n_rows")), "lengths")

    left = rows
    for keys in (["length"], ["length", "head"]):
        shared = left.groupBy(keys).agg(F.sum("n_rows").alias("n")).filter("n > 1").select(keys)
        left = joined(left, shared, keys, "left_semi", "shared")
    left = materialize(left, "same-head")

    texts = df.select(row_key(id_col, text_col).alias("row_key"), F.col(text_col).alias("t"))
    if (n := left.count()) <= BROADCAST_ROWS:
        texts = matching(texts, left.select("row_key"), n, ["row_key"])
    hashes = texts.select("row_key", digest("t").alias("sha")).groupBy("row_key").agg(F.min("sha").alias("sha"))
    hashed = materialize(left.join(hashes, "row_key"), "same-text")
    groups = hashed.groupBy("length", "sha").agg(F.min("id").alias("keep_id"), F.sum("n_rows").alias("group_size"))
    found = joined(hashed.select("row_key", "length", "sha"), groups, ["length", "sha"], "inner", "groups")
    return rows.join(found.select("row_key", "keep_id", "group_size"), "row_key", "left").select(
        "row_key", "id", "n_rows", F.coalesce("keep_id", "id").alias("keep_id"), F.coalesce("group_size", "n_rows").alias("group_size")
    )


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row_key, <id_col>, keep_id, group_size, kept): one row per input row; one row of each group is kept.

    Of rows that repeat the kept id and text, the first of the repeats is the kept one.
    """
    groups = duplicate_groups(df, id_col, text_col)
    copies = groups.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n_rows")))
    kept = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return copies.select("row_key", F.col("id").alias(id_col), "keep_id", "group_size", kept.alias("kept"))


def drop_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` with one row of each group of equal texts, all columns unchanged.

    The narrow keys of the rows to drop are broadcast while they are few. Rows that repeat a kept id and text are thinned
    by a window over those rows alone.
    """
    groups = materialize(duplicate_groups(df, id_col, text_col).filter("group_size > 1"), "duplicates")
    keeps = F.col("id").eqNullSafe(F.col("keep_id"))
    return keep_rows(df, id_col, text_col, groups.filter(~keeps), groups.filter(keeps & (F.col("n_rows") > 1)), groups.count())
