"""Row filters of the preparation job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerloom.config import PrepConfig
from answerloom.functions.numbers import int_or_zero


def has_text(question: Column, answer: Column) -> Column:
    """Neither side is null or made of spaces only. Other whitespace passes here and falls to the length filter."""
    return F.coalesce((F.trim(question) != "") & (F.trim(answer) != ""), F.lit(False))


def length_in_band(q_len: Column, a_len: Column, cfg: PrepConfig = PrepConfig()) -> Column:
    return q_len.between(cfg.min_question_len, cfg.max_question_len) & a_len.between(
        cfg.min_answer_len, cfg.max_answer_len
    )


def scored_enough(question_score: Column, cfg: PrepConfig = PrepConfig()) -> Column:
    return int_or_zero(question_score) >= cfg.min_question_score


def drop_empty(df: DataFrame) -> DataFrame:
    return df.filter(has_text(F.col("Q"), F.col("A")))


def with_lengths(df: DataFrame) -> DataFrame:
    """Character counts of Q and A; clean the text first."""
    return df.withColumns({"q_len": F.length("Q"), "a_len": F.length("A")})


def filter_length(df: DataFrame, cfg: PrepConfig = PrepConfig()) -> DataFrame:
    return df.filter(length_in_band(F.col("q_len"), F.col("a_len"), cfg))


def filter_score(df: DataFrame, cfg: PrepConfig = PrepConfig()) -> DataFrame:
    return df.filter(scored_enough(F.col("meta.question_score"), cfg))
