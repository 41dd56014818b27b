import json
import os
from pathlib import Path

from answerloom.config import PrepConfig
from answerloom.sources.jsonl import read_raw
from answerloom.streaming import clean
from checks import queries
from checks.views import qa_scored

TEXT = "word " * 40


def arrive(folder, name, ids, when):
    rows = [json.dumps({"Q": f"q{i} {TEXT}", "A": f"a{i} {TEXT}", "meta": {"url": name, "question_score": 9}}) for i in ids]
    path = Path(folder) / name
    path.write_text("\n".join([*rows, "not json", json.dumps({"Q": "short", "A": "x"})]) + "\n")
    os.utime(path, (when, when))


def run(spark, folder, **how):
    found = clean.clean_stream(clean.read_raw_stream(spark, f"{folder}/in", files_per_batch=1), **how)
    query = clean.write_clean_stream(found, f"{folder}/out", f"{folder}/state")
    query.awaitTermination()
    assert query.exception() is None
    return spark.read.schema("instruction string, content_hash string").json(f"{folder}/out").collect()


def test_a_stream_gives_the_batch_rows_and_a_restart_repeats_nothing(spark, folder):
    os.mkdir(f"{folder}/in")
    day = 86_400
    arrive(f"{folder}/in", "a.json", [1, 2, 3], day)
    assert sorted(r.instruction[:2] for r in run(spark, folder)) == ["q1", "q2", "q3"]
    assert len(run(spark, folder)) == 3  # nothing new
    arrive(f"{folder}/in", "b.json", [3, 4, 4], day + 60)  # a copy of an earlier batch, and one within
    found = run(spark, folder)
    assert sorted(r.instruction[:2] for r in found) == ["q1", "q2", "q3", "q4"]
    batch = clean.clean_stream(read_raw(spark, f"{folder}/in").selectExpr("*", "timestamp '1970-01-02' AS arrived"))
    assert {r.content_hash for r in batch.collect()} == {r.content_hash for r in found}
    assert batch.count() == 4


def test_copies_beyond_the_watermark_come_again(spark, folder):
    os.mkdir(f"{folder}/in")
    day = 86_400
    for k, (name, ids) in enumerate((("a.json", [1]), ("b.json", [2]), ("c.json", [3]), ("d.json", [1]))):
        arrive(f"{folder}/in", name, ids, day * (1 + 5 * k))
    found = run(spark, folder, lateness="1 hour", cfg=PrepConfig())
    assert sorted(r.instruction[:2] for r in found) == ["q1", "q1", "q2", "q3"]


def test_the_query_writes_each_part_by_many_tasks_and_cleans_it_in_one_batch(spark, folder, monkeypatch):
    turns = [(c, t, "user" if t % 2 == c % 2 else "assistant", f"{c} {t} {TEXT}") for c in range(40) for t in range(6)]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    monkeypatch.setattr(queries, "new_path", lambda spark, name: f"{folder}/{name}")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = [r.content_hash for r in queries.clean_stream(spark, folder).collect()]
        expected = {r.content_hash for r in qa_scored(spark, folder).select("content_hash").collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(found) > 50 and len(found) == len(set(found)) and set(found) == expected
    batches = [
        [json.loads(line)["path"] for line in Path(f"{folder}/stream-state/sources/0/{k}").read_text().splitlines()[1:]]
        for k in range(3)
    ]
    assert not Path(f"{folder}/stream-state/sources/0/3").exists()
    assert [len(b) for b in batches] == [4, 4, 4]  # as many files as the session has shuffle partitions
    first, second, third = ({(r.Q, r.A, r.meta) for r in read_raw(spark, b).collect()} for b in batches)
    assert first == third and first.isdisjoint(second)
