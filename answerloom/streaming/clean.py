"""The preparation job's row filters and cleaning over a stream of files, with copies dropped within a watermark.

An extension: files of raw lines arrive in a folder, each is read once, its rows are filtered, cleaned and keyed as in the batch job,
and a row whose content hash was seen within the watermark is dropped. The state is one hash and time per distinct row of
that period; older state goes as the watermark passes. A restart goes on from the checkpoint and repeats nothing. Copies that
come later than the watermark allows, and the choice of the best copy, are the batch job's work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from answerloom.config import PrepConfig
from answerloom.operators.shape import to_instruction
from answerloom.plans.prepare import KEPT, stage_rows
from answerloom.sources.jsonl import CORRUPT, RAW_SCHEMA

ARRIVED = "arrived"
LATENESS = "1 day"


def read_raw_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Raw lines of the files that arrive in a folder, with the time of each file as ``arrived``."""
    reader = spark.readStream.schema(RAW_SCHEMA).option("columnNameOfCorruptRecord", CORRUPT).option("allowSingleQuotes", "false")
    lines = reader.option("maxFilesPerTrigger", str(files_per_batch)).json(path)
    return lines.select("*", F.col("_metadata.file_modification_time").alias(ARRIVED))


def clean_stream(raw: DataFrame, cfg: PrepConfig = PrepConfig(), arrived: str = ARRIVED, lateness: str = LATENESS) -> DataFrame:
    """Instruction rows with keys and ``arrived``, the first of each content hash within ``lateness``.

    Works on a batch frame too, where all copies are dropped.
    """
    kept = stage_rows(raw, cfg, (arrived,)).filter(F.col("reached") == KEPT)
    rows = to_instruction(kept, arrived, "uid", "content_hash").withWatermark(arrived, lateness)
    return rows.dropDuplicatesWithinWatermark(["content_hash"]) if raw.isStreaming else rows.dropDuplicates(["content_hash"])


def write_clean_stream(clean: DataFrame, output: str, checkpoint: str, fmt: str = "json", once: bool = True, every: str = "1 minute") -> StreamingQuery:
    """Start writing a cleaned stream: what has arrived and then stop (``once``), or on and on.

    The sink lists the files of finished batches, so readers see no half batch, and a batch that is run again replaces itself.
    """
    trigger = {"availableNow": True} if once else {"processingTime": every}
    return clean.writeStream.format(fmt).option("checkpointLocation", checkpoint).outputMode("append").trigger(**trigger).start(output)
