import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from answerloom.llm import grammar, quality, toxicity
from answerloom.llm.arrowtext import flat
from answerloom.llm.common import id_remainder
from answerloom.llm.grammar import INSULT, NEGATED, NEGATION, OTHER, REPORT, REPORTED, TARGET, TARGETED, THREAT

DATA = "/root/testdata/sf0.1"


def held_out(spark, query, modulus, held, label, cut):
    from answerloom.llm.queries import QUERIES

    found = QUERIES[query](spark, DATA)
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    rows = found.join(labels, "doc_id").filter("held_out").select(F.col(label).alias("y"), "score", "predicted").collect()
    assert all(0 <= x.score <= 1 and x.predicted == (x.score >= cut) for x in rows)
    return rows


def test_quality_on_held_out_labels(spark):
    rows = held_out(spark, "op4_quality", 4, 2, "quality", 0.7)
    assert sum(x.predicted == x.y for x in rows) >= 0.98 * len(rows)


def test_toxicity_on_held_out_labels(spark):
    rows = held_out(spark, "op10_toxicity", 5, 0, "toxic", 0.5)
    toxic = [x for x in rows if x.y == 1]
    assert sum(x.predicted for x in toxic) >= 0.88 * len(toxic)
    assert sum(x.predicted for x in rows if x.y == 0) <= 0.005 * len(rows)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, int(i % 5 == 0)) for i in range(30)] + [(None, 1, 1), (3, 0, 0), (4, None, None)], "doc_id long, quality int, toxic int")


def test_odd_rows(documents, nothing, rows, labels):
    for scored in (
        quality.score_quality(documents, labels, F.lit(True)),
        toxicity.with_toxicity(documents, labels, F.lit(True)).select("doc_id", "score"),
        quality.score_quality(documents, labels, F.lit(False)),
        toxicity.with_toxicity(documents, labels.filter("false"), F.lit(True)).select("doc_id", "score"),
    ):
        found = scored.collect()
        assert sorted(str(x.doc_id) for x in found) == sorted(str(i) for i, _, _ in rows)
        assert all(0 <= x.score <= 1 for x in found)
    assert quality.score_quality(nothing, labels, F.lit(True)).collect() == []
    assert toxicity.with_toxicity(nothing, labels, F.lit(True)).collect() == []


def test_columns_stay(documents, labels):
    scored = toxicity.with_toxicity(documents, labels, F.lit(True))
    assert sorted(scored.columns) == sorted(documents.columns)
    assert dict(scored.dtypes)["score"] == "double"


def test_contexts_of_matches():
    assert grammar.matches([OTHER, INSULT]) == [OTHER, INSULT]
    assert grammar.matches([NEGATION, OTHER, INSULT])[2] == INSULT | NEGATED
    assert grammar.matches([NEGATION, *[OTHER] * 5, INSULT])[6] == INSULT
    assert grammar.matches([REPORT, *[OTHER] * 9, INSULT, TARGET])[10] == INSULT | REPORTED | TARGETED
    assert grammar.matches([THREAT, OTHER, TARGET])[0] == THREAT | TARGETED


def test_composition_is_one_after_the_other():
    rng = random.Random(1)
    first = grammar.nearby(NEGATION, NEGATED, grammar.CLASSES)
    second = grammar.reporting(grammar.outputs(first))
    both = grammar.compose(first, second)
    for _ in range(100):
        clause = [rng.choice(grammar.CLASSES) for _ in range(rng.randint(0, 12))]
        assert both.run(clause) == second.run(first.run(clause))


def test_matched_clauses_count_not_isolated_words(spark, labels):
    texts = ["You are an idiot.", "I will kill you.", "They kill time.", "He said: not an idiot.", "A fine day."]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    score = {x.doc_id: x.score for x in toxicity.with_toxicity(df, labels.filter("false"), F.lit(True)).collect()}
    assert score[0] > 0.5 and score[1] > 0.4
    assert score[2] < score[1] and score[3] < score[0] and score[4] < 0.1
    assert id_remainder("doc_id", 5) is not None


def test_rows_of_one_id_do_not_fill_the_sample(spark):
    from answerloom.llm.labelled import labelled_sample

    rows = [(1, "same")] * 50 + [(1, f"text {i}") for i in range(50)] + [(i, f"of {i}") for i in range(2, 8)] + [(8, None), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 9)], "doc_id long, toxic int")
    found = [tuple(x) for x in labelled_sample(docs, labels, "toxic", F.lit(True), 10).collect()]
    assert len(found) == 10 == len(set(found))
    assert set(found) <= {(i, t, i % 2) for i, t in rows if i}
    assert {i for i, _, _ in found} == set(range(1, 9))


def plain_evidence(text, lexicon):
    """Every clause read, whether it has a candidate or not."""
    out = [0.0] * (len(grammar.PATTERNS) + 1)
    for clause in re.split(r"[.!?;:\n]", text):
        words = toxicity.words_of(clause)
        strengths = [lexicon.strength(w) for w in words]
        classes = [INSULT if s else toxicity._KINDS.get(w, OTHER) for w, s in zip(words, strengths)]
        for symbol, s in zip(grammar.matches(classes), strengths):
            if symbol in grammar.PATTERNS:
                out[grammar.PATTERNS.index(symbol)] += s or 1.0
    return out[:-1]


def test_evidence_is_that_of_a_plain_scan():
    rng = random.Random(8)
    lexicon = toxicity.Lexicon(dict.fromkeys(toxicity.INSULTS, 0.8), {"dreck": 0.6, "schwach": 0.5})
    words = [*toxicity.INSULTS, *toxicity.THREATS, *toxicity.TARGETS, *toxicity.NEGATIONS, *toxicity.REPORTS, "Dreckskerl", "schwachkopf", "день", "日本", "naïve", "ok", "x"]
    marks = list(" .,!?;:\n'\"-_") + ["\u201c", "\u201e", "\u00ab", "\u00a1", "\u00bf", "\u2014", "\u2013", "\u2026", "\u2019", "\u2018", "\u00a0", "\u3000", "\U0001f600", "7", "\u00b7", "\u200b", "\ufeff", "\u300c"]
    texts = ["".join(rng.choice([str, str.upper, str.capitalize])(rng.choice(words)) + rng.choice(["", " "]) + rng.choice(marks) for _ in range(rng.randrange(30))) for _ in range(400)]
    data, offsets = flat(pa.array(texts))
    found = toxicity.evidence(data, offsets, lexicon, lexicon.heads())[:, :-1]
    for text, row in zip(texts, found):
        assert row.tolist() == pytest.approx(plain_evidence(text, lexicon)), text
    assert found.sum() > 100


def test_marks_and_elisions_do_not_hide_insults(spark, labels):
    marked = ["you idiot", "\u201cidiot\u201d you", "you \u2014idiot", "you \u00abidiot\u00bb", "you \u00a1Idiot!", "you \u201eidiot\u201c", "you l'idiot", "you l\u2019idiot", "you \U0001f600idiot"]
    texts = [f"{m} and then some" for m in marked]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    score = {x.doc_id: x.score for x in toxicity.with_toxicity(df, labels.filter("false"), F.lit(True)).collect()}
    assert all(s > 0.5 and abs(s - score[0]) < 0.05 for s in score.values()), score
    assert toxicity.words_of("it isn't, it isn\u2019t l'idiot n'est") == ["it", "isn't", "it", "isn't", "l", "idiot", "n", "est"]
