"""Rows of JSON-lines files by their position.

Files that Python tasks can open are read by byte ranges (``ranges``): counted as far as needed, then only the ranges that
hold the lines asked for are opened again. Others, compressed ones and those of stores that only Spark can open, are scanned:

The lines are read and parsed in one scan and written to the shared folder with their split and their place in the scan.
Everything later reads that table: where Spark cuts the files depends on the session and on the cores that are alive, so
a second scan could cut them elsewhere. A line's number is its split's offset plus its place within the split. Only
per-split counts are ever put in order, and a range is a filter on line numbers, so no text is sorted or shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from answerloom.sources.jsonl import INSTRUCTION_SCHEMA, records
from answerloom.sources.ranges import RangedLines, list_files, readable
from answerloom.storage import materialize

# Splits whose offsets (three numbers each) are broadcast; 48 MB, enough for some 250 TB of splits of 128 MB.
BROADCAST_SPLITS = 2_000_000
# Bytes per core that the first attempt at a range reads.
FIRST_BYTES = 128 << 20


@dataclass(frozen=True)
class Lines:
    """``rows`` (split, seq, record, null where the line holds none) and ``offsets`` (one row per split)."""

    rows: DataFrame
    offsets: DataFrame

    def numbered(self, first: int = 0, last: int | None = None) -> DataFrame:
        """The lines from ``first`` to ``last`` that hold a record, with ``line_no``, counted from 0 over all files."""
        chosen = self.offsets.select("split", "first_seq", "lines_before")
        few = chosen.limit(BROADCAST_SPLITS + 1).count() <= BROADCAST_SPLITS
        rows = self.rows.filter("record IS NOT NULL").join(F.broadcast(chosen) if few else chosen, "split", "left")
        line_no = F.col("lines_before") + F.col("seq") - F.col("first_seq")
        unknown = F.raise_error(F.lit("a line of a split that was not counted")).cast("long")
        rows = rows.select(F.coalesce(line_no, unknown).alias("line_no"), "record.*")
        rows = rows.filter(F.col("line_no") >= first) if first > 0 else rows
        return rows if last is None else rows.filter(F.col("line_no") <= last)

    def n_valid(self) -> int:
        return self.offsets.agg(F.sum("n_valid")).first()[0] or 0

    def nth_valid(self, n: int) -> int | None:
        """The line number of the ``n``-th valid line, counted from 1; None when there are fewer. Reads one split's places."""
        split = self.offsets.filter((F.col("valid_before") < n) & (F.col("valid_before") + F.col("n_valid") >= n)).first()
        if n < 1 or split is None:
            return None
        places = self.rows.filter((F.col("split") == split.split) & F.col("record").isNotNull()).select("seq")
        place = places.orderBy("seq").offset(n - split.valid_before - 1).first().seq
        return split.lines_before + place - split.first_seq

    def valid_before(self, line_no: int) -> int:
        """How many valid lines precede line ``line_no``."""
        split = self.offsets.filter((F.col("lines_before") <= line_no) & (F.col("lines_before") + F.col("n_lines") > line_no)).first()
        if split is None:
            return self.n_valid() if line_no > 0 else 0
        inside = (F.col("split") == split.split) & (F.col("seq") < split.first_seq + line_no - split.lines_before)
        return split.valid_before + self.rows.filter(inside & F.col("record").isNotNull()).count()


def read_lines(spark: SparkSession, path: str | list[str], schema: T.StructType = INSTRUCTION_SCHEMA, parts: int | None = None) -> Lines:
    """Read, parse and write the lines once, and count them per split.

    The running sums are taken within range partitions and then over one total per partition, so no task sees more
    than its share of the splits.
    """
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("seq"),
        F.get(records(F.col("value"), schema), F.lit(0)).alias("record"),
    )
    lines = materialize(lines.withColumn("split", F.xxhash64("file", "start")), "lines")
    counts = lines.groupBy("split", "file", "start").agg(
        F.min("seq").alias("first_seq"), F.count("*").alias("n_lines"), F.count_if(F.col("record").isNotNull()).alias("n_valid")
    )
    order = ["file", "start"]
    ranged = materialize(counts.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "splits")
    before = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        ranged.groupBy("part")
        .agg(F.sum("n_lines").alias("n_lines"), F.sum("n_valid").alias("n_valid"))
        .select(
            "part",
            F.coalesce(F.sum("n_lines").over(earlier), F.lit(0)).alias("lines_base"),
            F.coalesce(F.sum("n_valid").over(earlier), F.lit(0)).alias("valid_base"),
        )
    )
    offsets = ranged.join(F.broadcast(totals), "part").select(
        "split",
        "first_seq",
        "n_lines",
        "n_valid",
        (F.col("lines_base") + F.coalesce(F.sum("n_lines").over(before), F.lit(0))).alias("lines_before"),
        (F.col("valid_base") + F.coalesce(F.sum("n_valid").over(before), F.lit(0))).alias("valid_before"),
    )
    return Lines(lines.drop("file", "start"), materialize(offsets, "split-offsets"))


def _files(spark: SparkSession, path: str | list[str]) -> list[tuple[str, int]]:
    """(file, bytes) in path order; reads no content."""
    listed = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("file"), "length")
    return sorted((x.file, x.length) for x in listed.collect())


def _lines(spark: SparkSession, path: str | list[str], schema: T.StructType, skip: int, n: int | None, index: str | None) -> Lines | RangedLines:
    """The lines of the input as far as ``n`` valid ones follow its first ``skip`` lines; None: all."""
    files = list_files(spark, path)
    if files and readable(files):
        return RangedLines(spark, files, schema, index).reach(skip, n)
    return read_lines(spark, path, schema) if n is None else _leading(spark, path, schema, skip, n)


def _leading(spark: SparkSession, path: str | list[str], schema: T.StructType, skip: int, n: int) -> Lines:
    """The lines of so many files, in path order, that ``n`` valid ones follow their first ``skip`` lines.

    Starts with as many bytes as the cores can read at once and doubles, so a short range of many files reads few.
    """
    files = _files(spark, path)
    most = FIRST_BYTES * spark.sparkContext.defaultParallelism
    while True:
        chosen, size = [], 0
        for file, length in files:
            if chosen and size + length > most:
                break
            chosen.append(unquote(file))
            size += length
        everything = len(chosen) == len(files) or any(c in f for f in chosen for c in "*?[]{}\\")
        lines = read_lines(spark, path if everything else chosen, schema)
        if everything or lines.n_valid() - lines.valid_before(skip) >= n:
            return lines
        most *= 2


def read_numbered(spark: SparkSession, path: str | list[str], schema: T.StructType = INSTRUCTION_SCHEMA, index: str | None = None) -> DataFrame:
    """Every valid line with its physical line number ``line_no``.

    ``index`` names a table of counts per byte range, which is used where it fits the files as they are, and extended.
    """
    return _lines(spark, path, schema, 0, None, index).numbered()


def head_rows(
    spark: SparkSession, path: str | list[str], n: int | None = 50_000, schema: T.StructType = INSTRUCTION_SCHEMA, index: str | None = None
) -> DataFrame:
    """The first ``n`` valid lines in file order (None: all), with ``line_no``; the rows come in no given order."""
    if n is None:
        return read_numbered(spark, path, schema, index)
    lines = _lines(spark, path, schema, 0, n, index)
    last = lines.nth_valid(n)
    return lines.numbered(0, None if last is None and n > 0 else -1 if last is None else last)


def holdout_rows(
    spark: SparkSession,
    path: str | list[str],
    skip: int = 50_000,
    take: int = 1_000,
    schema: T.StructType = INSTRUCTION_SCHEMA,
    index: str | None = None,
) -> DataFrame:
    """Leave out the first ``skip`` physical lines, then the first ``take`` valid lines, in no given order."""
    lines = _lines(spark, path, schema, skip, take, index)
    return lines.numbered(skip, lines.nth_valid(lines.valid_before(skip) + take))


def head_and_holdout(
    spark: SparkSession,
    path: str | list[str],
    n: int = 50_000,
    take: int = 1_000,
    schema: T.StructType = INSTRUCTION_SCHEMA,
    index: str | None = None,
) -> DataFrame:
    """The first ``n`` valid lines as part ``head`` and the next ``take`` as part ``holdout``, never overlapping.

    Counting valid lines for both parts is what keeps them apart: a skip in physical lines starts inside the head as
    soon as one line of it is malformed.
    """
    lines = _lines(spark, path, schema, 0, n + take, index)
    border, last = lines.nth_valid(n), lines.nth_valid(n + take)
    rows = lines.numbered(0, last)
    head = F.lit(True) if border is None and n > 0 else F.col("line_no") <= (-1 if border is None else border)
    return rows.withColumn("part", F.when(head, "head").otherwise("holdout"))


def overlap(left: DataFrame, right: DataFrame, key: str = "line_no") -> DataFrame:
    """Rows of ``right`` whose key also occurs in ``left``; empty when the two parts are disjoint."""
    return right.join(left.select(key), key, "left_semi")
