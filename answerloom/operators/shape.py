"""Keys and projections of question/answer rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerloom.functions.numbers import int_or_zero

# Fixed value: the characters of each side that the content key covers by default.
PREFIX_CHARS = 200


def record_uid(url: Column, answer_id: Column) -> Column:
    """``url|answer_id`` with nulls as empty text; rows without either share the uid ``|``."""
    return F.concat_ws("|", F.coalesce(url, F.lit("")), F.coalesce(answer_id.cast("string"), F.lit("")))


def content_hash(question: Column, answer: Column, prefix: int | None = PREFIX_CHARS) -> Column:
    """md5 of the first ``prefix`` characters of each side, joined without a separator; None takes the whole texts.

    With a prefix, texts that differ only after it count as copies.
    """
    sides = [question, answer] if prefix is None else [F.substring(side, 1, prefix) for side in (question, answer)]
    return F.md5(F.concat(*sides))


def key_columns(prefix: int | None = PREFIX_CHARS) -> dict[str, Column]:
    """The two duplicate keys, and the columns that order copies, from cleaned Q, A and meta."""
    q, a = F.col("Q"), F.col("A")
    return {
        "uid": record_uid(F.col("meta.url"), F.col("meta.answer_id")),
        "content_hash": content_hash(q, a, prefix),
        "q_score": int_or_zero(F.col("meta.question_score")),
        "a_count": int_or_zero(F.col("meta.answer_count")),
        "text_md5": F.md5(F.concat(q, a)),
    }


def with_keys(df: DataFrame) -> DataFrame:
    return df.withColumns(key_columns())


def to_instruction(df: DataFrame, *carry: str) -> DataFrame:
    """instruction / input / output with the lengths and metadata counts, plus the ``carry`` columns."""
    return df.select(
        *carry,
        F.col("Q").alias("instruction"),
        F.lit("").alias("input"),
        F.col("A").alias("output"),
        "q_len",
        "a_len",
        "q_score",
        "a_count",
    )
