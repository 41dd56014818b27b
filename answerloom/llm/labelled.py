"""A bounded sample of labelled rows to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerloom.storage import materialize


def labelled_sample(df: DataFrame, labels: DataFrame, label: str, learn: Column, most: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, label): up to ``most`` rows with a label of 0 or 1 where ``learn`` holds, chosen by the hash of the id.

    Of an id with several labels the largest counts, and a null id matches nothing. Rows of ``df`` that repeat an id and text
    are one row. At most ``most`` ids are chosen; each has a row, and its further texts fill what is left by hash.
    """
    usable = labels.filter(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & learn)
    usable = usable.groupBy(F.col(id_col).alias("id")).agg(F.max(label).cast("int").alias("label"))
    chosen = usable.orderBy(F.xxhash64("id"), "id").limit(most)
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id").withColumn("digest", F.xxhash64("text"))
    kinds = materialize(rows.select("id", "digest").distinct(), "labelled-rows")
    first = kinds.groupBy("id").agg(F.min("digest").alias("first"))
    kinds = kinds.join(F.broadcast(first), "id").orderBy(F.col("digest") != F.col("first"), F.xxhash64("id", "digest"), "id", "digest")
    taken = kinds.limit(most).select("id", "digest")
    # Copies meet in each task before texts are shuffled.
    return rows.join(F.broadcast(taken), ["id", "digest"]).groupBy("id", "label", "digest").agg(F.first("text").alias("text")).select("id", "text", "label")
