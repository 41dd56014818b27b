"""The run summary: how many rows each preparation stage took in, dropped and left."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from answerloom.functions.numbers import percent

STAGES = ("raw", "empty", "length", "score", "uid", "content")


def funnel(spark: SparkSession, remaining: dict[str, int]) -> DataFrame:
    """(step, stage, rows_in, dropped, remaining, retention_pct) from the row count after each stage."""
    rows, before = [], None
    for step, stage in enumerate(STAGES):
        left = remaining[stage]
        rows_in = left if before is None else before
        rows.append((step, stage, rows_in, rows_in - left, left, remaining["raw"]))
        before = left
    frame = spark.createDataFrame(
        rows, "step int, stage string, rows_in long, dropped long, remaining long, raw long"
    )
    return frame.withColumn("retention_pct", percent(F.col("remaining"), F.col("raw"))).drop("raw")


def require_rows(remaining: dict[str, int]) -> None:
    """ValueError when nothing is left after the last stage."""
    if remaining[STAGES[-1]] == 0:
        raise ValueError("no rows remain after the preparation filters; relax the thresholds or check the input")
