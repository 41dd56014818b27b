import gzip
import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from answerloom.sources import jsonl, lines, ranges, sinks

RAW = [
    '{"Q":"q1","A":"a","meta":{"question_score":"x"}}',
    "",
    "not json",
    '{"Q":"q2","A":"b","meta":{"question_score":7}}',
    '{"Q":"\\n\\t","A":"b"}',
]


def write(folder, name, rows):
    path = Path(folder) / name
    path.write_text("\n".join(rows) + "\n", encoding="utf-8")
    return str(path)


def test_raw_scan_keeps_corrupt_lines_as_null_rows(spark, folder):
    frame = jsonl.read_raw(spark, write(folder, "raw.jsonl", RAW))
    rows = frame.select("Q", "A", "meta.question_score").collect()
    assert [r.Q for r in rows] == ["q1", None, "q2", "\n\t"]
    assert [r.question_score for r in rows] == ["x", None, "7", None]


def test_required_columns(spark):
    with pytest.raises(ValueError, match=r"\['A', 'Q'\]"):
        jsonl.require_columns(spark.range(1), "Q", "A")


@pytest.mark.parametrize(
    "columns,score",
    [
        (["'q' AS Q"], None),
        (["'text' AS meta"], None),
        (["CAST(NULL AS string) AS meta"], None),
        (["named_struct('question_score', 3, 'other', 1) AS meta"], "3"),
    ],
)
def test_meta_is_completed(spark, columns, score):
    frame = jsonl.with_full_meta(spark.range(1).selectExpr(*columns))
    assert frame.select("meta.*").dtypes == [(f, "string") for f in jsonl.META_FIELDS]
    assert frame.first().meta.question_score == score


def parses(line):
    try:
        return isinstance(json.loads(line), dict)
    except ValueError:
        return False


ODD = [
    '{"instruction":"trail"} x',
    '{"instruction":"a"}{"instruction":"b"}',
    '[{"instruction":"a"}]',
    "5",
    "null",
    "",
    "   ",
    "{'instruction':'a'}",
    '{"instruction":"cut"',
    "{}",
    '  {"instruction":"spaced"}  ',
]


def test_tolerant_scan_agrees_with_a_strict_parser(spark, folder):
    frame = jsonl.read_tolerant(spark, write(folder, "odd.jsonl", ODD))
    expected = [json.loads(line).get("instruction") for line in ODD if parses(line)]
    assert [r.instruction for r in frame.collect()] == expected and frame.count() == len(expected)


def instruction_files(folder, rng):
    """Twelve files whose lines are numbered through, some of them blank or malformed."""
    everything = []
    for part in range(10, 22):
        rows = []
        for i in range(rng.randrange(0, 250)):
            record = json.dumps({"instruction": f"{part}-{i} " + "x" * rng.randrange(80), "input": "", "output": "o"})
            rows.append(rng.choice(["", record[:-1], *ODD]) if rng.random() < 0.3 else record)
        write(folder, f"part {part}%.jsonl", rows or [""])
        everything += rows or [""]
    return [(i, json.loads(row).get("instruction")) for i, row in enumerate(everything) if parses(row)], everything


def pairs(frame):
    return sorted((r.line_no, r.instruction) for r in frame.collect())


@pytest.fixture
def small_splits(spark):
    default = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", default)


@pytest.fixture(params=["ranges", "scan"])
def way(request, monkeypatch):
    """Files read by byte ranges, some hundred bytes each, or scanned."""
    if request.param == "scan":
        monkeypatch.setattr(lines, "readable", lambda files: False)
    monkeypatch.setattr(ranges, "RANGE_BYTES", 700)
    return request.param


def test_lines_are_numbered_across_splits(spark, folder, small_splits, way):
    valid, everything = instruction_files(folder, random.Random(3))
    assert spark.read.text(folder).rdd.getNumPartitions() > 10
    assert pairs(lines.read_numbered(spark, folder)) == valid
    for n in (0, 1, 100, 700, 10_000):
        assert pairs(lines.head_rows(spark, folder, n)) == valid[:n]
        later = [v for v in valid if v[0] >= n][:50]
        assert pairs(lines.holdout_rows(spark, folder, n, 50)) == later
    assert pairs(lines.head_rows(spark, folder, None)) == valid
    both = lines.head_and_holdout(spark, folder, 200, 40)
    head, rest = both.filter("part = 'head'"), both.filter("part = 'holdout'")
    assert pairs(head) == valid[:200] and pairs(rest) == valid[200:240]
    assert lines.overlap(head, rest).count() == 0
    # A skip in physical lines starts inside a head that holds malformed lines.
    assert lines.overlap(head, lines.holdout_rows(spark, folder, 200, 40)).count() > 0


@pytest.mark.parametrize("many", [True, False])
def test_numbers_do_not_depend_on_where_files_are_cut(spark, folder, many, way, monkeypatch):
    """The number of cores may change between a call and the action on its result; Spark then cuts files elsewhere."""
    rows = [json.dumps({"instruction": f"i{i}", "input": "", "output": "o" * (i % 50)}) for i in range(20_000)]
    step = 2000 if many else len(rows)
    monkeypatch.setattr(ranges, "RANGE_BYTES", 100_000)
    for k in range(0, len(rows), step):
        write(folder, f"f{k:05d}.jsonl", rows[k : k + step])
    calls = {
        "all": lambda: lines.read_numbered(spark, folder),
        "head": lambda: lines.head_rows(spark, folder, 15_000),
        "holdout": lambda: lines.holdout_rows(spark, folder, 17_000, 1_000),
        "both": lambda: lines.head_and_holdout(spark, folder, 12_000, 500),
    }
    sizes = {"all": range(20_000), "head": range(15_000), "holdout": range(17_000, 18_000), "both": range(12_500)}
    setting = "spark.sql.files.minPartitionNum"
    for name, call in calls.items():
        spark.conf.set(setting, "3")
        frame = call()
        spark.conf.set(setting, "64")
        found = pairs(frame)
        spark.conf.unset(setting)
        assert found == [(i, f"i{i}") for i in sizes[name]]


def test_a_line_of_an_uncounted_split_is_an_error(spark, folder):
    instruction_files(folder, random.Random(6))
    read = lines.read_lines(spark, folder)
    broken = lines.Lines(read.rows, read.offsets.filter("lines_before > 0"))
    with pytest.raises(Exception, match="not counted"):
        broken.numbered().collect()


def test_ranges_sort_and_shuffle_no_text(spark, folder, small_splits, way):
    instruction_files(folder, random.Random(5))
    for frame in (lines.head_rows(spark, folder, 300), lines.holdout_rows(spark, folder, 300, 50), lines.head_and_holdout(spark, folder, 100, 50)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("TakeOrdered", "Window", "Sort", "Exchange hash", "Exchange range"))


def test_a_short_range_reads_few_files(spark, folder, monkeypatch):
    instruction_files(folder, random.Random(5))
    monkeypatch.setattr(lines, "FIRST_BYTES", 2000)
    near = lines._leading(spark, folder, jsonl.INSTRUCTION_SCHEMA, 0, 10)
    far = lines._leading(spark, folder, jsonl.INSTRUCTION_SCHEMA, 0, 10_000)
    assert near.offsets.count() < 4 and far.offsets.count() == 12


def test_lines_join_by_shuffle_beyond_the_broadcast_limit(spark, folder, monkeypatch):
    valid, _ = instruction_files(folder, random.Random(4))
    monkeypatch.setattr(lines, "BROADCAST_SPLITS", 0)
    assert pairs(lines.read_numbered(spark, folder)) == valid


def ranged(spark, path, **kept):
    return ranges.RangedLines(spark, ranges.list_files(spark, path), jsonl.INSTRUCTION_SCHEMA, **kept)


def test_a_head_of_one_huge_file_opens_its_first_ranges(spark, folder, monkeypatch):
    rows = [json.dumps({"instruction": f"i{i}", "input": "", "output": "o" * (i % 90)}) for i in range(20_000)]
    path = write(folder, "one.jsonl", rows)
    monkeypatch.setattr(ranges, "RANGE_BYTES", 20_000)
    whole = ranged(spark, path)
    assert len(whole.ranges) > 60
    near = ranged(spark, path).reach(0, 300)
    assert near.scanned == spark.sparkContext.defaultParallelism < 10
    frame = near.numbered(0, near.nth_valid(300))
    assert frame.rdd.getNumPartitions() <= 3 and pairs(frame) == [(i, f"i{i}") for i in range(300)]
    # Ranges beyond are not opened: what they hold does not matter as long as the file keeps its length.
    data = Path(path).read_bytes()
    Path(path).write_bytes(data[:200_000] + b"\xff" * (len(data) - 200_000))
    assert pairs(lines.head_rows(spark, path, 300)) == [(i, f"i{i}") for i in range(300)]
    far = ranged(spark, path).reach(0, 10_000)
    assert far.everything and far.scanned == len(far.ranges)


def test_no_copy_of_the_text_is_written(spark, folder, monkeypatch):
    path = write(folder, "one.jsonl", [json.dumps({"instruction": f"i{i}"}) for i in range(2_000)])
    monkeypatch.setattr(lines, "materialize", None)
    monkeypatch.setattr(ranges, "RANGE_BYTES", 1_000)
    assert lines.head_rows(spark, path, 700).count() == 700
    assert lines.holdout_rows(spark, path, 700, 20).count() == 20


def test_counts_are_kept_and_extended(spark, folder, monkeypatch):
    path = write(folder, "one.jsonl", [json.dumps({"instruction": f"i{i}"}) for i in range(4_000)])
    monkeypatch.setattr(ranges, "RANGE_BYTES", 2_000)
    index = f"{folder}/index"
    first = ranged(spark, path, index=index).reach(0, 100)
    again = ranged(spark, path, index=index).reach(0, 100)
    assert first.scanned > 0 == again.scanned and first.counts == again.counts
    further = ranged(spark, path, index=index).reach()
    assert first.scanned + further.scanned == len(further.ranges) and sum(n for n, _ in further.counts) == 4_000
    assert pairs(lines.holdout_rows(spark, path, 3_000, 5, index=index)) == [(i, f"i{i}") for i in range(3_000, 3_005)]
    # A file that changed is counted anew.
    write(folder, "one.jsonl", [json.dumps({"instruction": f"j{i}"}) for i in range(4_001)])
    assert ranged(spark, path, index=index).reach().scanned > 0
    assert lines.read_numbered(spark, path, index=index).count() == 4_001


@pytest.mark.parametrize("size", [1, 2, 3, 5, 11, 1_000])
def test_line_ends_are_those_of_the_text_reader(spark, folder, monkeypatch, size):
    """LF, CR and CR LF end lines, wherever a range or a block ends; a mark at the start of a file is none of its text."""
    rng = random.Random(size)
    monkeypatch.setattr(ranges, "RANGE_BYTES", size)
    monkeypatch.setattr(ranges, "BLOCK_BYTES", max(1, size // 2))
    ranges.line_source.cache_clear()
    texts = [b"", b"\n", b"\r", b"\r\n", b"a", b"a\r\nb\rc\n\nd", b"\xef\xbb\xbfa\nb", b"a\r", b"\n\r\n\r", b"long line that spans ranges\nx"]
    texts += [bytes(rng.choice(b"ab\r\n\n\r") for _ in range(rng.randrange(40))) for _ in range(4)]
    for k, text in enumerate(texts):
        (Path(folder) / f"f{k:02d}").write_bytes(text)
    found = ranged(spark, folder).reach()
    want = [r.value for k in range(len(texts)) for r in spark.read.text(f"{folder}/f{k:02d}").collect()]
    monkeypatch.setattr(ranges, "records", lambda value, schema: F.array(value))
    scan = found._scan([(k, sum(n for n, _ in found.counts[:k])) for k in range(len(found.ranges))], None)
    got = sorted((r.line_no, r.record) for r in scan.collect())
    ranges.line_source.cache_clear()
    assert got == list(enumerate(want))


def test_files_without_ranges_are_scanned(spark, folder):
    rows = [json.dumps({"instruction": f"i{i}"}) for i in range(50)]
    (Path(folder) / "a.jsonl.gz").write_bytes(gzip.compress("\n".join(rows).encode()))
    assert not ranges.readable(ranges.list_files(spark, folder))
    assert not ranges.readable([ranges.File("nosuch://place/a.jsonl", 10, 0)])
    assert pairs(lines.head_rows(spark, folder, 10)) == [(i, f"i{i}") for i in range(10)]


def test_a_file_that_changes_between_is_an_error(spark, folder):
    path = write(folder, "one.jsonl", ['{"instruction":"a"}'] * 5)
    frame = lines.head_rows(spark, path, 3)
    write(folder, "one.jsonl", ['{"instruction":"a"}'] * 6)
    with pytest.raises(Exception, match="bytes when it was listed"):
        frame.collect()


def test_training_log(spark, folder):
    rows = ['{"step":20,"loss":1.5,"lr":0.1}', '{"step":10,"loss":1.8}', '{"step":30,"train_runtime":9.0}']
    log = jsonl.read_training_log(spark, write(folder, "log.jsonl", rows))
    assert [tuple(r) for r in log.collect()] == [(10, 1.8), (20, 1.5)]


def test_sinks(spark, folder):
    rows = [(str(i), "", "o", ["train", "train", "validation", "test"][i % 4], 1) for i in range(40)]
    frame = spark.createDataFrame(rows, "instruction string, input string, output string, split string, q_len int")
    sinks.write_clean(frame, f"{folder}/clean")
    assert jsonl.read_tolerant(spark, f"{folder}/clean").count() == 40
    assert set(json.loads(next(Path(folder, "clean").glob("*.json")).read_text().splitlines()[0])) == {
        "instruction",
        "input",
        "output",
    }
    sinks.write_splits(frame, f"{folder}/splits")
    assert jsonl.read_tolerant(spark, f"{folder}/splits/split=train").count() == 20
    sinks.write_split_folders(frame, {s: f"{folder}/{s}" for s in ("train", "validation", "test")})
    assert jsonl.read_tolerant(spark, f"{folder}/test").count() == 10
    sinks.write_clean(frame.limit(3), f"{folder}/clean", "parquet")
    assert spark.read.parquet(f"{folder}/clean").count() == 3
    with pytest.raises(ValueError, match="unknown"):
        sinks.write_split_folders(frame, {"dev": folder})
