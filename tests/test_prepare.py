import random

import pytest
from pyspark.sql import functions as F

from answerloom.config import PrepConfig
from answerloom.plans import prepare as job
from answerloom.sources import jsonl
from checks.views import qa_raw
from tests import spec

DATA = "/root/testdata/sf0.01"
GOLDEN = {"raw": 355, "empty": 331, "length": 322, "score": 257, "uid": 199, "content": 160}


@pytest.fixture(scope="module")
def run(spark):
    return job.prepare(qa_raw(spark, DATA), row_id="row_id")


def test_golden_funnel(run):
    assert run.remaining == GOLDEN
    rows = run.funnel.orderBy("step").collect()
    assert [r.remaining for r in rows] == list(GOLDEN.values())
    assert sum(r.dropped for r in rows) == 355 - 160 and rows[-1].retention_pct == pytest.approx(100 * 160 / 355)


def test_result_does_not_depend_on_layout(spark, run):
    expected = sorted(map(tuple, run.clean.collect()))
    again = job.prepare(qa_raw(spark, DATA).repartition(7), row_id="row_id")
    assert sorted(map(tuple, again.clean.collect())) == expected


def test_without_ids_the_rows_are_the_same_for_any_layout(spark):
    raw = qa_raw(spark, DATA).drop("row_id")
    columns = [*job.CLEAN_COLUMNS, "uid", "content_hash", "split"]
    results = [
        sorted(map(tuple, job.prepare(layout).clean.select(columns).collect()))
        for layout in (raw.repartition(2), raw.repartition(9), raw.orderBy("A"))
    ]
    assert results[0] == results[1] == results[2] and len(results[0]) == 160


def test_survivors_join_by_shuffle_beyond_the_broadcast_limit(spark, run, monkeypatch):
    monkeypatch.setattr(job, "BROADCAST_ROWS", 0)
    again = job.prepare(qa_raw(spark, DATA), row_id="row_id")
    assert sorted(map(tuple, again.clean.collect())) == sorted(map(tuple, run.clean.collect()))


def test_wide_rows_are_not_sorted_for_the_join(spark):
    wide, ids = spark.range(10).withColumnRenamed("id", "stage_id"), spark.range(5).withColumnRenamed("id", "stage_id")
    joined = wide.join(ids.hint("shuffle_hash"), "stage_id", "left_semi")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "BuildRight" in plan and "Sort " not in plan


def test_splits_and_leakage(run):
    counts = {r.split: r.n for r in run.split_counts().collect()}
    assert sum(counts.values()) == 160 and run.split("train").count() == counts["train"]
    assert all(r.leaking_keys == 0 for r in run.leakage().collect())


def test_profile(run):
    parts = run.profile()
    scores = {r.bucket: r.n for r in parts["score_profile"].collect()}
    assert scores == {"0": 0, "1-4": 0, "5-9": 12, "10-49": 123, "50-199": 25}
    summary = {r.series: r for r in parts["summary"].collect()}
    assert 160 - summary["latex_total"].n_zero == 110
    assert parts["display_share"].first().pct_display == pytest.approx(100 * 82 / 160)
    assert sum(r.n for r in parts["length_histogram"].collect()) == 320
    assert {r.series for r in parts["quantiles"].collect()} == {"q_len", "a_len"}
    assert sum(r.n for r in parts["density_profile"].collect()) == 160


def test_nothing_left(spark):
    with pytest.raises(ValueError, match="no rows remain"):
        job.prepare(qa_raw(spark, DATA), PrepConfig(min_question_score=10**6), row_id="row_id")


def test_row_ids_need_not_be_unique(spark, run):
    raw = qa_raw(spark, DATA).withColumn("row_id", F.lit(1))
    again = job.prepare(raw, row_id="row_id")
    assert again.remaining == GOLDEN and again.clean.count() == 160


def test_configuration_is_checked():
    with pytest.raises(ValueError):
        PrepConfig(min_answer_len=5, max_answer_len=4)


def test_from_files(spark, run, folder):
    qa_raw(spark, DATA).drop("row_id").write.mode("overwrite").json(folder)
    again = job.prepare(jsonl.read_raw(spark, folder))
    assert again.remaining["score"] == GOLDEN["score"] and again.remaining["uid"] == GOLDEN["uid"]


def test_stage_is_one_scan_without_shuffle_or_python(spark, folder):
    qa_raw(spark, DATA).drop("row_id").write.mode("overwrite").json(folder)
    plan = job.stage_rows(jsonl.read_raw(spark, folder))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan json") == 1 and "Exchange" not in plan and "Python" not in plan
    assert plan.count("Normalizer") == 2


def test_hot_keys_against_brute_force(spark):
    rng = random.Random(9)
    rows = []
    for i in range(3000):
        text = f"question {rng.randrange(900)} " + "x" * 300 if i % 3 else f"same question {'y' * 300}"
        url = None if i % 3 == 1 else f"u{rng.randrange(2000)}"
        rows.append((i, text, "<b>answer</b> " + "z" * 200, url, None, str(rng.randrange(3, 9)), None))
    names = ["url", "answer_id", "question_score", "answer_count"]
    frame = spark.createDataFrame(rows, f"row_id long, Q string, A string, {', '.join(n + ' string' for n in names)}")
    got = job.prepare(frame.select("row_id", "Q", "A", F.struct(*names).alias("meta")).repartition(6), row_id="row_id")

    left = [(i, spec.clean(q), f"{u or ''}|", int(s)) for i, q, _, u, _, s, _ in rows if int(s) >= 5]
    assert got.remaining["score"] == len(left)
    answer = spec.clean(rows[0][2])
    ranked = sorted(left, key=lambda r: (-r[3], spec_md5(r[1] + answer), r[0]))
    for key in (lambda r: r[2], lambda r: r[1][:200]):
        seen = {}
        for row in ranked:
            seen.setdefault(key(row), row)
        ranked = list(seen.values())
    assert sorted(r.row_id for r in got.clean.collect()) == sorted(r[0] for r in ranked)


def spec_md5(text):
    import hashlib

    return hashlib.md5(text.encode()).hexdigest()
