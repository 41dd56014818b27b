"""Lines of text files by byte ranges: a data source whose partitions are ranges, and an index of how many lines each holds.

A line belongs to the range that holds its first byte, so what a range's lines are depends on the bytes alone, not on where
a scan would cut the files or on the cores alive. Ranges are counted only as far into the input as a caller asks
(``RangedLines.reach``), in rounds that double, and no range twice. A later read opens only ranges that hold lines asked for, gives
each line its number while reading, and stops after the last one. Nothing but counts is written: a head of one huge file costs
its first ranges, read twice.

The driver holds one entry per range, as Spark does per split of a scan; ranges grow with the input so that they stay
below ``MOST_RANGES`` and some per file. Counts can be kept in an index table, which later calls extend.

Files are opened in Python tasks through ``pyarrow.fs``. Compressed files have no byte ranges, and some stores only Spark can open:
``readable`` tells, and ``lines`` scans such files instead.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache
from itertools import accumulate
from urllib.parse import unquote, urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from answerloom.sources.jsonl import records

SOURCE = "line_ranges"
RANGE_BYTES = 128 << 20
MOST_RANGES = 100_000
BLOCK_BYTES = 4 << 20
BATCH_LINES = 10_000

# Endings of names that Spark's text reader takes for compressed files.
COMPRESSED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate")


@dataclass(frozen=True)
class File:
    path: str  # as Spark lists it, an escaped URI
    length: int
    modified: int  # microseconds


@dataclass(frozen=True)
class Range:
    file: int
    start: int
    end: int


def list_files(spark: SparkSession, path: str | list[str]) -> list[File]:
    """The files of a text scan in path order; reads no content."""
    listed = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("file"), "length", F.unix_micros("modificationTime").alias("modified"))
    return sorted((File(*x) for x in listed.collect()), key=lambda f: f.path)


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of an escaped URI, and the path in it."""
    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        return pafs.LocalFileSystem(), unquote(parts.path)
    return pafs.FileSystem.from_uri(path)


def readable(files: list[File]) -> bool:
    """Whether the files can be read by ranges: not compressed, and of a kind that Python can open."""
    if any(f.path.lower().endswith(COMPRESSED) for f in files):
        return False
    try:
        for path in {urlsplit(f.path)[:2]: f.path for f in files}.values():
            store, inside = opened(path)
            store.open_input_file(inside).close()
    except (OSError, ValueError, NotImplementedError, pa.ArrowException):
        return False
    return True


@cache
def line_source() -> type[DataSource]:
    """The data source's class. Defined in here it travels to Python workers by value."""

    open_file, block_bytes, batch_lines, source_name = _opener(), BLOCK_BYTES, BATCH_LINES, SOURCE

    class Part(InputPartition):
        def __init__(self, ranges: list):
            self.ranges = ranges  # [path, length of the file, start, end, number of the range, its first line's number]

    class Reader(DataSourceReader):
        def __init__(self, options: dict):
            self.parts = json.loads(options["parts"])
            self.last = int(options.get("last", 1 << 62))

        def partitions(self) -> list[InputPartition]:
            return [Part(p) for p in self.parts] or [Part([])]

        def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
            for path, length, start, end, number, line in partition.ranges:
                for values in self.lines(path, length, start, end):
                    for k in range(0, len(values), batch_lines):
                        some = values[k : k + batch_lines][: max(0, self.last + 1 - line)]
                        if not some:
                            break
                        columns = [pa.array([number] * len(some), pa.int32()), pa.array(range(line, line + len(some)), pa.int64()), pa.array(some, pa.binary())]
                        yield pa.RecordBatch.from_arrays(columns, names=["range", "line_no", "value"])
                        line += len(some)
                    if line > self.last:
                        break

        def lines(self, path: str, length: int, start: int, end: int) -> Iterator[list[bytes]]:
            """The lines that start in the range, without their ends (LF, CR or both), some at a time."""
            with open_file(path) as file:
                if file.size() != length:
                    raise ValueError(f"{path} had {length} bytes when it was listed and has {file.size()} now")
                at = max(0, start - 1)  # the byte before the range tells whether a line starts with it
                file.seek(at)
                held, looked, skipping, mark = bytearray(), 0, start > 0, start == 0
                final = False
                while not final and (skipping or at < end) and not (skipping and at + len(held) > end):
                    new = file.read(block_bytes)
                    final = not new
                    held += new or (b"\n" if held else b"")  # the last line may have no end
                    found, begin = [], 0
                    with memoryview(held) as view:
                        for stop, after in line_ends(held, looked, final):
                            if not skipping and at + begin < end:
                                found.append(bytes(view[begin:stop]))
                            begin, skipping = after, False
                    if skipping:
                        begin = max(0, len(held) - 1)  # no line of this range yet, but its last byte may end one
                    del held[:begin]
                    at += begin
                    looked = max(0, len(held) - 1)
                    if found and mark:
                        found[0], mark = found[0].removeprefix(b"\xef\xbb\xbf"), False
                    if found:
                        yield found

    def line_ends(data: bytearray, at: int, final: bool) -> Iterator[tuple[int, int]]:
        """(where a line stops, where the next one starts) from ``at`` on; a CR at the very end may go on, unless it is final."""
        size = len(data)
        feed, back = data.find(b"\n", at), data.find(b"\r", at)
        while feed >= 0 or back >= 0:
            if back < 0 or 0 <= feed < back:
                stop, after = feed, feed + 1
            elif back + 1 < size:
                stop, after = back, back + 2 if data[back + 1] == 10 else back + 1
            elif final:
                stop, after = back, size
            else:
                return
            yield stop, after
            if 0 <= feed < after:
                feed = data.find(b"\n", after)
            if 0 <= back < after:
                back = data.find(b"\r", after)

    class Lines(DataSource):
        @classmethod
        def name(cls) -> str:
            return source_name

        def schema(self) -> str:
            return "range int, line_no bigint, value binary"

        def reader(self, schema) -> DataSourceReader:
            return Reader(self.options)

    return Lines


def _opener():
    """A function that opens an escaped URI for reading; without references to this module."""
    local, other, split, plain = pafs.LocalFileSystem, pafs.FileSystem.from_uri, urlsplit, unquote

    def open_file(path: str):
        parts = split(path)
        store, inside = (local(), plain(parts.path)) if parts.scheme in ("", "file") else other(path)
        return store.open_input_file(inside)

    return open_file


@dataclass
class RangedLines:
    """The lines of some files, counted as far as ``reach`` was asked to go."""

    spark: SparkSession
    files: list[File]
    schema: T.StructType
    index: str | None = None
    ranges: list[Range] = field(default_factory=list)
    counts: list[tuple[int, int]] = field(default_factory=list)  # lines and valid lines of the leading ranges
    scanned: int = 0  # ranges that were read to count them

    def __post_init__(self):
        step = max(RANGE_BYTES, -(-sum(f.length for f in self.files) // MOST_RANGES))
        self.step = step
        self.ranges = [Range(k, a, min(a + step, f.length)) for k, f in enumerate(self.files) for a in range(0, f.length, step)]
        self.known = self._stored()

    @property
    def everything(self) -> bool:
        return len(self.counts) == len(self.ranges)

    def n_valid(self) -> int:
        return sum(valid for _, valid in self.counts)

    def reach(self, skip: int = 0, n: int | None = None) -> RangedLines:
        """Count ranges until ``n`` valid lines follow the first ``skip`` lines; None: to the end."""
        more = self.spark.sparkContext.defaultParallelism
        while not self.everything and (n is None or self._after(skip) < n):
            left = len(self.ranges) - len(self.counts)
            self._count(left if n is None else min(left, more))
            more *= 2
        return self

    def rows(self, first: int = 0, last: int | None = None) -> DataFrame:
        """(line_no, record) of the counted lines from ``first`` to ``last``, record null where a line holds none."""
        chosen = []
        before = list(accumulate((n for n, _ in self.counts), initial=0))
        for k, (n, _) in enumerate(self.counts):
            if n and before[k] + n > first and (last is None or before[k] <= last):
                chosen.append((k, before[k]))
        rows = self._scan(chosen, last)
        return rows.filter(F.col("line_no") >= first).drop("range") if first > 0 else rows.drop("range")

    def numbered(self, first: int = 0, last: int | None = None) -> DataFrame:
        return self.rows(first, last).filter("record IS NOT NULL").select("line_no", "record.*")

    def nth_valid(self, n: int) -> int | None:
        """The line number of the ``n``-th valid line, counted from 1; None when there are fewer. Reads one range."""
        before = list(accumulate((valid for _, valid in self.counts), initial=0))
        if n < 1 or n > before[-1]:
            return None
        k = next(k for k in range(len(self.counts)) if before[k + 1] >= n)
        first = sum(lines for lines, _ in self.counts[:k])
        places = self._scan([(k, first)], None).filter("record IS NOT NULL").select("line_no")
        return places.orderBy("line_no").offset(n - before[k] - 1).first().line_no

    def valid_before(self, line_no: int) -> int:
        """How many valid lines precede line ``line_no``. Reads one range at most."""
        lines = valid = 0
        for k, (n, good) in enumerate(self.counts):
            if lines + n > line_no:
                if line_no == lines:
                    return valid
                inside = self._scan([(k, lines)], line_no - 1).filter("record IS NOT NULL")
                return valid + inside.count()
            lines, valid = lines + n, valid + good
        return valid

    def _after(self, skip: int) -> int:
        """Valid lines known to follow the first ``skip`` lines: those of ranges that lie beyond them wholly."""
        lines = found = 0
        for n, good in self.counts:
            found += good if lines >= skip else 0
            lines += n
        return found

    def _scan(self, chosen: list[tuple[int, int]], last: int | None) -> DataFrame:
        """(range, line_no, record) of ranges given with their first line's number."""
        parts: list[list] = []
        held = 0
        for k, first in chosen:
            r = self.ranges[k]
            file = self.files[r.file]
            size = r.end - r.start
            if not parts or held + size > self.step:
                parts.append([])
                held = 0
            parts[-1].append([file.path, file.length, r.start, r.end, k, first])
            held += size
        self.spark.dataSource.register(line_source())
        reader = self.spark.read.format(SOURCE).option("parts", json.dumps(parts))
        lines = (reader if last is None else reader.option("last", str(last))).load()
        record = F.get(records(F.col("value").cast("string"), self.schema), F.lit(0))
        return lines.select("range", "line_no", record.alias("record"))

    def _count(self, n: int) -> None:
        """Count the next ``n`` ranges, those of the index without reading them."""
        todo = range(len(self.counts), len(self.counts) + n)
        new = [k for k in todo if self.ranges[k] not in self.known]
        if new:
            found = self._scan([(k, 0) for k in new], None).groupBy("range").agg(F.count("*").alias("n"), F.count_if(F.col("record").isNotNull()).alias("valid"))
            by = {x.range: (x.n, x.valid) for x in found.collect()}  # a row per range
            self.known |= {self.ranges[k]: by.get(k, (0, 0)) for k in new}
            self.scanned += len(new)
            self._store(new)
        self.counts += [self.known[self.ranges[k]] for k in todo]

    def _shape(self) -> str:
        return self.schema.json()

    def _stored(self) -> dict[Range, tuple[int, int]]:
        if not self.index:
            return {}
        where = self.spark._jvm.org.apache.hadoop.fs.Path(self.index)
        if not where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where):
            return {}
        number = {f: k for k, f in enumerate(self.files)}
        wanted = set(self.ranges)
        stored = self.spark.read.schema(INDEX_SCHEMA).parquet(self.index).filter(F.col("shape") == self._shape())
        out = {}
        for x in stored.drop("shape").collect():  # a row per range counted before
            file = number.get(File(x.path, x.length, x.modified))
            if file is not None and (r := Range(file, x.start, x.end)) in wanted:
                out[r] = (x.n_lines, x.n_valid)
        return out

    def _store(self, new: list[int]) -> None:
        if self.index:
            rows = [(f.path, f.length, f.modified, r.start, r.end, *self.known[r], self._shape()) for r in (self.ranges[k] for k in new) for f in [self.files[r.file]]]
            self.spark.createDataFrame(rows, INDEX_SCHEMA).coalesce(1).write.mode("append").parquet(self.index)


INDEX_SCHEMA = "path string, length long, modified long, start long, end long, n_lines long, n_valid long, shape string"
