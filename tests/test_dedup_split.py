import hashlib
import random

import pytest
from pyspark.sql import functions as F

from answerloom.config import SplitConfig
from answerloom.operators import dedup, split

SCHEMA = "row_id long, uid string, content_hash string, q_score int, a_len int, text_md5 string"


def order(row):
    return (-row[3], -row[4], row[5], row[0])


def keep(rows, key):
    best = {}
    for row in sorted(rows, key=order):
        best.setdefault(row[key], row)
    return list(best.values())


def copies(n, seed=1):
    """Rows of which a third share one uid and another third one content hash."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        uid = "|" if i % 3 == 0 else f"u{rng.randrange(n)}"
        content = "hot" if i % 3 == 1 else f"h{rng.randrange(n)}"
        rows.append((i, uid, content, rng.randrange(5, 8), rng.randrange(3), f"m{rng.randrange(4)}"))
    return rows


def test_two_passes_against_brute_force(spark):
    rows = copies(4000)
    frame = spark.createDataFrame(rows, SCHEMA)
    for layout in (frame.repartition(2), frame.repartition(8), frame.orderBy(F.desc("row_id"))):
        assert {r.row_id for r in dedup.dedup_uid(layout).collect()} == {r[0] for r in keep(rows, 1)}
        assert {r.row_id for r in dedup.dedup_content(layout).collect()} == {r[0] for r in keep(rows, 2)}
        both = {r.row_id for r in dedup.dedup_two_pass(layout).collect()}
        assert both == {r[0] for r in keep(keep(rows, 1), 2)}


def test_first_pass_survivor_decides_the_second(spark):
    rows = [(1, "u1", "h1", 5, 1, "m"), (2, "u1", "h2", 9, 1, "m"), (3, "u2", "h2", 7, 1, "m")]
    assert [r.row_id for r in dedup.dedup_two_pass(spark.createDataFrame(rows, SCHEMA)).collect()] == [2]
    rows[0] = (1, "u1", "h1", 10, 1, "m")
    assert len(dedup.dedup_two_pass(spark.createDataFrame(rows, SCHEMA)).collect()) == 2


def test_copies_are_thinned_below_the_shuffle(spark):
    frame = spark.createDataFrame(copies(10), SCHEMA)
    plan = dedup.dedup_two_pass(frame)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("row_number(), 1, Partial") == 2 and plan.count("Exchange hashpartitioning") == 2


def test_split_does_not_depend_on_layout(spark):
    keys = spark.range(10_000).select(F.md5(F.col("id").cast("string")).alias("content_hash"))
    expected = {}
    for (key,) in keys.collect():
        b = int(hashlib.md5(f"42|{key}".encode()).hexdigest()[:8], 16) % 10_000
        expected[key] = "train" if b < 8000 else "validation" if b < 9000 else "test"
    for n in (2, 8):
        assert dict(map(tuple, split.assign_split(keys.repartition(n)).collect())) == expected
    other = split.assign_split(keys, cfg=SplitConfig(0.5, 0.25, 0.25, seed=1))
    shares = {r.split: r.pct for r in split.split_counts(other).collect()}
    assert shares == pytest.approx({"train": 50, "validation": 25, "test": 25}, abs=2)


def test_random_split_adds_up(spark):
    drawn = split.assign_split_random(spark.range(10_000))
    counts = {r.split: r.n for r in split.split_counts(drawn).collect()}
    assert sum(counts.values()) == 10_000 and counts["train"] == pytest.approx(8000, abs=200)
    assert drawn.collect() == drawn.collect()


def test_conservation(spark):
    counts = split.split_counts(split.assign_split(spark.createDataFrame([("a",), ("b",)], "content_hash string")))
    assert sorted(r.split for r in split.check_conservation(counts, 2).collect()) == ["test", "train", "validation"]
    with pytest.raises(ValueError, match="expected 3"):
        split.check_conservation(counts, 3)


def test_leakage_finds_keys_in_two_splits(spark):
    rows = [("u1", "h1", "train"), ("u1", "h2", "test"), ("u2", "h3", "train"), ("u2", "h3", "train")]
    found = split.leakage(spark.createDataFrame(rows, "uid string, content_hash string, split string")).collect()
    assert {r.key_kind: (r["keys"], r.leaking_keys) for r in found} == {"uid": (2, 1), "content_hash": (3, 0)}


def test_sample(spark):
    ids = spark.range(1000)
    chosen = [r.id for r in split.sample_k(ids.repartition(7), "id", 50).collect()]
    assert chosen == [r.id for r in split.sample_k(ids, "id", 50).collect()] and len(set(chosen)) == 50
    assert chosen != [r.id for r in split.sample_k(ids, "id", 50, seed=43).collect()]
    assert split.sample_k(spark.range(3), "id").count() == 3


def test_shares_are_checked():
    with pytest.raises(ValueError):
        SplitConfig(0.8, 0.1, 0.2)


def test_rows_without_a_key_get_no_split(spark):
    rows = split.assign_split(spark.createDataFrame([("a",), (None,)], "content_hash string"))
    assert [r.split for r in rows.filter("content_hash IS NULL").collect()] == [None]
    with pytest.raises(ValueError, match="hold 1 rows"):
        split.check_conservation(split.split_counts(rows), 2)


def test_leaking_keys_are_an_error(spark):
    rows = spark.createDataFrame([("u", "c", "train"), ("u", "d", "test")], "uid string, content_hash string, split string")
    with pytest.raises(ValueError, match="uid"):
        split.check_leakage(split.leakage(rows))
    assert split.check_leakage(split.leakage(rows.limit(1))).count() == 2


def test_whole_texts_as_content_key(spark):
    from answerloom.operators.shape import content_hash

    rows = spark.createDataFrame([("q", "x" * 200 + "a"), ("q", "x" * 200 + "b")], "q string, a string")
    for prefix, n in ((200, 1), (None, 2)):
        assert rows.select(content_hash(rows.q, rows.a, prefix).alias("h")).distinct().count() == n
