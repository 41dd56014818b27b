import json
from pathlib import Path

import pytest

from answerloom.config import PrepConfig
from answerloom.plans import corpus
from answerloom.plans.prepare import prepare
from answerloom.sources import publish
from checks.views import qa_raw

DATA = "/root/testdata/sf0.001"


def rows(spark, root):
    return sorted(r.id for r in publish.read_published(spark, root, "rows", schema="id long").collect())


def put(spark, root, ids, fail=False, **how):
    with publish.publication(spark, root, **how) as folder:
        spark.createDataFrame([(i,) for i in ids], "id long").write.json(f"{folder}/rows")
        if fail:
            raise InterruptedError


def versions(root):
    return sorted(p.name for p in Path(root, "versions").iterdir()) if Path(root, "versions").exists() else []


def test_readers_see_a_version_whole_or_not_at_all(spark, folder):
    root = f"{folder}/out"
    with pytest.raises(ValueError, match="nothing is published"):
        publish.current(spark, root)
    put(spark, root, [1, 2])
    assert rows(spark, root) == [1, 2]
    with pytest.raises(InterruptedError):
        put(spark, root, [3], fail=True)
    assert rows(spark, root) == [1, 2] and len(versions(root)) == 1
    before = publish.read_published(spark, root, "rows", schema="id long")
    put(spark, root, [4])
    assert rows(spark, root) == [4] and before.count() == 2  # a frame keeps its version


def test_old_versions_go_after_the_switch(spark, folder):
    root = f"{folder}/out"
    for i in range(5):
        put(spark, root, [i], keep=2)
    found = publish.published(spark, root)
    assert [m["number"] for m in found] == [4, 5] and rows(spark, root) == [4]
    assert versions(root) == sorted(m["version"] for m in found)
    with pytest.raises(ValueError):
        put(spark, root, [9], keep=0)


def test_of_two_runs_at_once_one_is_told(spark, folder, monkeypatch):
    root = f"{folder}/out"
    put(spark, root, [1])
    monkeypatch.setattr(publish, "published", lambda spark, root: [])  # as if it had looked before the other published
    with pytest.raises(RuntimeError, match="another run"):
        put(spark, root, [2])
    monkeypatch.undo()
    assert rows(spark, root) == [1]
    assert [p.name for p in Path(root, "manifests").iterdir() if not p.name.startswith(".")] == ["000000001.json"]


def test_a_job_that_fails_in_the_middle_leaves_the_corpus_as_it_was(spark, folder, monkeypatch):
    qa_raw(spark, DATA).drop("row_id").write.json(f"{folder}/raw")
    root = f"{folder}/out"
    corpus.main(["--input", f"{folder}/raw", "--output", root, "--keep-versions", "2"])

    def held():
        return {str(p.relative_to(publish.current(spark, root))): p.read_text() for p in Path(publish.current(spark, root)).rglob("*.json")}

    before = held()
    assert {name.split("/")[0] for name in before} == {"clean", "splits", "profile", "leakage", "funnel"}
    monkeypatch.setattr(corpus, "write_splits", lambda *_: (_ for _ in ()).throw(OSError("disk")))
    with pytest.raises(OSError, match="disk"):
        corpus.publish_corpus(spark, f"{folder}/raw", root, PrepConfig(min_question_score=20))
    assert held() == before and len(versions(root)) == 1


def test_counts_come_with_the_write(spark, folder, monkeypatch):
    """The funnel's row counts are observed while the stage is written, and agree with a count afterwards."""
    run = prepare(qa_raw(spark, DATA), row_id="row_id")
    by = {r["reached"]: r["count"] for r in run.stage.groupBy("reached").count().collect()}
    total = sum(by.values())
    assert run.remaining["raw"] == total and run.remaining["empty"] == total - by.get(0, 0)
    assert run.remaining["length"] == total - by.get(0, 0) - by.get(1, 0) and run.remaining["score"] == by.get(3, 0)
    assert json.loads(run.funnel.toJSON().first())["rows_in"] == total
    with pytest.raises(ValueError, match="no rows remain"):
        prepare(qa_raw(spark, DATA).filter("false"), row_id="row_id")
