import json
from pathlib import Path

import pytest

from answerloom.operators.chat import CHAT_TEMPLATE
from answerloom.plans import chat_corpus, corpus
from answerloom.plans.evaluation import evaluate_predictions
from answerloom.sources import jsonl, lines
from answerloom.storage import materialize, run_tables
from checks.views import predictions, prepared, qa_raw

DATA = "/root/testdata/sf0.01"


def read_parts(path):
    return [json.loads(row) for file in sorted(Path(path).glob("*.json")) for row in file.read_text().splitlines()]


def test_corpus_job(spark, folder, capsys):
    qa_raw(spark, DATA).drop("row_id").write.json(f"{folder}/raw")
    corpus.main(["--input", f"{folder}/raw", "--output", f"{folder}/out", "--min-question-score", "10"])
    printed = capsys.readouterr().out
    assert "content" in printed and "train" in printed

    clean = read_parts(f"{folder}/out/clean")
    assert set(clean[0]) == {"instruction", "input", "output"}
    sizes = [len(read_parts(f"{folder}/out/splits/split={s}")) for s in ("train", "validation", "test")]
    assert sum(sizes) == len(clean) == max(r["remaining"] for r in read_parts(f"{folder}/out/funnel") if r["step"] == 5)
    assert {r["bucket"] for r in read_parts(f"{folder}/out/profile/score_profile")} >= {"10-49"}
    (cut,) = read_parts(f"{folder}/out/profile/truncation_risk")
    assert cut["n"] > len(clean) and cut["n_over"] >= 0
    assert [r["leaking_keys"] for r in read_parts(f"{folder}/out/leakage")] == [0, 0]


def test_a_job_fails_on_a_leaking_key(spark, folder, monkeypatch):
    qa_raw(spark, DATA).drop("row_id").write.json(f"{folder}/raw")
    leak = spark.createDataFrame([("uid", 9, 1)], "key_kind string, keys long, leaking_keys long")
    monkeypatch.setattr(corpus.Prepared, "leakage", lambda run: leak)
    with pytest.raises(ValueError, match="more than one split"):
        corpus.build_corpus(spark, f"{folder}/raw", f"{folder}/out")
    assert not Path(f"{folder}/out/clean").exists()


def test_run_tables_are_removed(spark):
    with run_tables(spark) as path:
        rows = materialize(spark.range(5).toDF("id"), "numbers")
        assert rows.inputFiles()[0].removeprefix("file://").startswith(path.removeprefix("file:")) and rows.count() == 5
    assert not Path(path.removeprefix("file:")).exists()


def test_train_and_test_rows_stay_apart(spark):
    run = prepared(spark, DATA)
    train = {r.content_hash for r in chat_corpus.split_chat(run).collect()}
    prompts = {r.sample_id for r in chat_corpus.split_prompts(run, k=None).collect()}
    assert len(train) == run.split("train").count() and len(prompts) == run.split("test").count() and not train & prompts
    assert chat_corpus.split_prompts(run, k=3).count() == 3


def test_chat_corpus_and_prompts(spark, folder):
    rows = [json.dumps({"instruction": f"q{i}", "input": "", "output": f"a{i}"}) for i in range(400)]
    path = Path(folder) / "clean.jsonl"
    path.write_text("\n".join(rows) + "\n")
    train = chat_corpus.training_chat(spark, str(path), 300, end="<end>")
    texts = {r.line_no: r.text for r in train.collect()}
    assert sorted(texts) == list(range(300))
    assert texts[7] == CHAT_TEMPLATE.replace("{INPUT}", "q7").replace("{OUTPUT}", "a7") + "<end>"

    prompts = chat_corpus.evaluation_prompts(spark, str(path), skip=300, pool=60, k=20).collect()
    assert len(prompts) == 20 and all(300 <= p.sample_id < 360 for p in prompts)
    assert all(p.reference == f"a{p.sample_id}" and p.prompt.endswith("### Response:\n") for p in prompts)
    held_out = lines.holdout_rows(spark, str(path), 300, 60)
    assert lines.overlap(train, held_out).count() == 0


def test_evaluation(spark):
    results = evaluate_predictions(predictions(spark, DATA))
    top = results.top.collect()
    assert [r["rank"] for r in top] == [1, 2, 3, 4, 5]
    deltas = results.deltas.collect()
    assert [r.delta for r in top] == sorted((r.delta for r in deltas if r.paired), reverse=True)[:5]
    assert {r.paired for r in deltas} == {True, False}
    compared = {r.metric: r for r in results.comparison.collect()}
    for side in ("base", "tuned"):
        f1 = [r[f"{side}_f1"] for r in deltas if r.paired]
        assert compared["f1"][side] == pytest.approx(sum(f1) / len(f1))
    assert compared["em"].n_paired == sum(r.paired for r in deltas) and compared["em"].n_unpaired == sum(not r.paired for r in deltas)
    assert {r.model: r.n for r in results.summary.collect()}["tuned"] == results.scored.filter("model = 'tuned'").count()


def test_missing_predictions_and_unpaired_samples(spark):
    rows = [(1, "base", "q", "yes", "yes"), (1, "tuned", "q", "yes", None), (2, "base", "q", "no", "no"), (3, "tuned", "q", "no", "no")]
    frame = spark.createDataFrame(rows, "sample_id long, model string, instruction string, reference string, prediction string")
    results = evaluate_predictions(frame)
    assert {r.model: (r.n, r.em, r.f1) for r in results.summary.collect()} == {"base": (2, 1.0, 1.0), "tuned": (2, 0.5, 0.5)}
    found = {r.sample_id: (r.paired, r.delta, r.reference) for r in results.deltas.collect()}
    assert found == {1: (True, -1.0, "yes"), 2: (False, None, "no"), 3: (False, None, "no")}
    em = {r.metric: r for r in results.comparison.collect()}["em"]
    assert (em.base, em.tuned, em.n_paired, em.n_unpaired) == (1.0, 0.0, 1, 2)
    assert [r.sample_id for r in results.top.collect()] == [1]


def test_schema_and_row_preview(spark, folder, capsys):
    qa_raw(spark, DATA).drop("row_id").write.json(f"{folder}/raw")
    raw = jsonl.read_raw(spark, f"{folder}/raw")
    raw.printSchema()
    assert "question_score: string" in capsys.readouterr().out
    assert raw.columns == ["Q", "A", "meta", "_corrupt"] and len(raw.limit(3).collect()) == 3
