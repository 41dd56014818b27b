import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from answerloom.config import PrepConfig
from answerloom.operators import linked
from answerloom.plans.prepare import prepare
from tests.test_dedup_split import SCHEMA, copies, order


def best_of_each(rows):
    """The best row of each set of rows that share a uid or a content hash, directly or by others."""
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for row in rows:
        nodes = [(k, v) for k, v in (("u", row[1]), ("h", row[2])) if v is not None]
        for a, b in zip(nodes, nodes[1:]):
            parent[find(a)] = find(b)
    groups = defaultdict(list)
    for row in rows:
        nodes = [(k, v) for k, v in (("u", row[1]), ("h", row[2])) if v is not None]
        groups[find(nodes[0]) if nodes else ("row", row[0])].append(row)
    return {min(group, key=order)[0] for group in groups.values()}


def kept(frame):
    return sorted(r.row_id for r in linked.dedup_linked(frame).collect())


def test_a_chain_is_one_row(spark):
    rows = [(1, "u1", "h1", 5, 1, "m"), (2, "u2", "h1", 6, 1, "m"), (3, "u2", "h2", 7, 1, "m"), (4, "u3", "h3", 5, 1, "m")]
    assert kept(spark.createDataFrame(rows, SCHEMA)) == [3, 4]


@pytest.mark.parametrize("heavy", [linked.HEAVY_ROWS, 20])
def test_against_union_find(spark, heavy, monkeypatch):
    """Two hot keys, long chains, rows without one or both keys, lone rows; whatever the layout."""
    monkeypatch.setattr(linked, "HEAVY_ROWS", heavy)
    rng = random.Random(9)
    rows = copies(600) + [(1000 + i, f"c{i // 2}", f"d{(i + 1) // 2}", 5, 1, "m") for i in range(100)]
    rows += [(2000 + i, rng.choice([None, f"e{rng.randrange(40)}"]), rng.choice([None, f"f{rng.randrange(40)}"]), rng.randrange(3), 1, "m") for i in range(60)]
    rows += [(3000 + i, f"g{i}", f"g{i}", 5, 1, "m") for i in range(30)]
    frame = spark.createDataFrame(rows, SCHEMA)
    want = sorted(best_of_each(rows))
    for layout in (frame.repartition(2), frame.orderBy(F.desc("row_id")).repartition(7)):
        assert kept(layout) == want


def test_hot_keys_do_not_move(spark, folder, monkeypatch):
    """A key that a third of all rows share is broadcast, not joined by a shuffle of its rows."""
    monkeypatch.setattr(linked, "HEAVY_ROWS", 50)
    spark.range(600).selectExpr("if(id % 3 = 0, 0, id) AS k", "id").write.parquet(f"{folder}/rows")
    spark.range(600).selectExpr("id AS k", "id * 2 AS v").write.parquet(f"{folder}/table")
    rows, table = spark.read.parquet(f"{folder}/rows"), spark.read.parquet(f"{folder}/table")
    found = linked.lookup(rows, table, "k")
    assert {(r.id, r.v) for r in found.collect()} == {(i, 0 if i % 3 == 0 else 2 * i) for i in range(600)}
    assert "BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()
    # More hot keys than may be broadcast: only the hottest stay.
    monkeypatch.setattr(linked, "HEAVY_ROWS", 0)
    monkeypatch.setattr(linked, "BROADCAST_ROWS", 3)
    found = linked.lookup(rows, table, "k")
    assert {(r.id, r.v) for r in found.collect()} == {(i, 0 if i % 3 == 0 else 2 * i) for i in range(600)}


def test_empty_frames(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert linked.dedup_linked(frame).collect() == [] and linked.dedup_linked(frame).columns == frame.columns
    assert linked.components(spark.createDataFrame([], "a binary, b binary")).collect() == []


def test_the_job_can_close_duplicates(spark):
    long = " ".join(["word"] * 60)
    rows = [(1, f"one {long}", f"a {long}", "u1"), (2, f"one {long}", f"a {long}", "u2"), (3, f"two {long}", f"b {long}", "u2"), (4, f"three {long}", f"c {long}", "u3")]
    raw = spark.createDataFrame(rows, "row_id long, Q string, A string, url string").selectExpr("row_id", "Q", "A", "struct(url, '1' AS answer_id, string(row_id + 5) AS question_score) AS meta")
    run = prepare(raw, PrepConfig(linked_duplicates=True), row_id="row_id")
    assert sorted(r.row_id for r in run.clean.collect()) == [3, 4]
    assert run.remaining["content"] == 2 and sum(r.n for r in run.split_counts().collect()) == 2
    assert sum(r.leaking_keys for r in run.leakage().collect()) == 0
