"""Column expressions and joins that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerloom.storage import BROADCAST_ROWS, materialize

# Fixed value: the white space that separates words.
SPACES = r"[\x20\x09-\x0D]+"
# Fixed value: a word.
WORD = r"[^\x20\x09-\x0D]+"


def text_or_empty(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def one_space(text: str | Column) -> Column:
    """The text with each run of white space replaced by one space; null counts as empty."""
    return F.regexp_replace(text_or_empty(text), SPACES, " ")


def word_count(text: str | Column) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def row_key(*columns: str) -> Column:
    """64 bits that name a row by its content, the same in every scan."""
    return F.xxhash64(*columns)


def row_key128(*columns: str) -> Column:
    """128 bits that name a row by its content, nulls included, the same in every scan."""
    nulls = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in columns])
    return F.struct(F.xxhash64(*columns, nulls).alias("k1"), F.xxhash64(F.lit("second"), nulls, *columns).alias("k2"))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def id_remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string")).cast("long") % modulus


def matching(rows: DataFrame, keys: DataFrame, n_keys: int, on: list[str], how: str = "left_semi") -> DataFrame:
    """``rows`` joined with the ``n_keys`` narrow rows of ``keys``: broadcast up to a fixed number, shuffled beyond it."""
    return rows.join(F.broadcast(keys) if n_keys <= BROADCAST_ROWS else keys, on, how)


def joined(rows: DataFrame, keys: DataFrame, on: list[str], how: str, name: str) -> DataFrame:
    """``rows`` joined with narrow ``keys`` that are written and counted first, so that few of them are broadcast.

    Then rows of one key, however many, stay where they are.
    """
    keys = materialize(keys, name)
    return matching(rows, keys, keys.count(), on, how)


def keep_rows(df: DataFrame, id_col: str, text_col: str, gone: DataFrame, repeated: DataFrame, n_keys: int) -> DataFrame:
    """``df`` without the rows whose key is in ``gone``, and one of the rows of each key in ``repeated``.

    Both hold row keys (column ``row_key``) of id and text, ``n_keys`` at most; only rows of ``repeated`` are compared.
    """
    key = "__row_key"
    gone, repeated = (x.select(F.col("row_key").alias(key)) for x in (gone, repeated))
    rows = df.withColumn(key, row_key(id_col, text_col))
    once = matching(matching(rows, gone, n_keys, [key], "left_anti"), repeated, n_keys, [key], "left_anti")
    again = matching(rows, repeated, n_keys, [key]).dropDuplicates([key])
    return once.unionByName(again).drop(key)
