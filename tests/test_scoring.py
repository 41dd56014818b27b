import random
import tracemalloc

import pytest
from pyspark.sql import functions as F

from answerloom.functions import scoring
from answerloom.operators import evaluate
from tests import spec

PIECES = [
    *["a", "an", "the", "The", "cat", "CAT", "\xe9a", "x1", "it's", "a-b", "$a$", "$$b$$", "\\frac", "\\sum", "Step 1"],
    *["first,", "Finally.", "\n1. ", "\n - ", "\n* ", "\n2) ", "\n", "  ", "\xa0", "\u2003", "_a_", ".", "", "_"],
]


def scored(spark, pairs):
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "sample_id int, prediction string, reference string")
    return evaluate.score_pairs(frame).orderBy("sample_id").collect()


def test_pinned_pairs(spark):
    pairs = [("the cat sat", "Cat sat down."), ("x x", "x x"), ("", "x"), ("The", "a")]
    assert [(r.em, round(r.f1, 9)) for r in scored(spark, pairs)] == [(0, 0.8), (1, 0.5), (0, 0.0), (1, 0.0)]


def test_pinned_normalisation(spark):
    values = ["a-b", "it's the end", "$a$ + $b$"]
    frame = spark.createDataFrame([(v,) for v in values], "t string")
    assert [r[0] for r in frame.select(scoring.normalize_answer(F.col("t"))).collect()] == ["b", "its end", "b"]


def test_fuzz_against_the_plain_statement(spark):
    rng = random.Random(11)
    pairs = [tuple(" ".join(rng.choices(PIECES, k=rng.randrange(25))) for _ in range(2)) for _ in range(2000)]
    for (p, r), row in zip(pairs, scored(spark, pairs)):
        assert row.em == int(spec.words(p) == spec.words(r))
        assert row.f1 == pytest.approx(spec.f1(p, r))
        assert row.rougeL == pytest.approx(spec.rouge(p, r))
        assert row.has_steps == spec.steps(p), repr(p)


def test_items_of_a_list(spark):
    values = ["1. a\n2. b\n3. c", "- - - a", "-\n-\n-\n", "\n\n - a\n\n\n2) b\n\t* c", "x 1. a\n1.a\n2.b", "1.\n2.\n3."]
    pairs = [(v, "r") for v in values] + [("x" + "\n" * 500_000 + "y", "r")]
    assert [r.has_steps for r in scored(spark, pairs)] == [*map(spec.steps, values), 0]


def test_null_texts(spark):
    row = scored(spark, [(None, "x")])[0]
    assert (row.f1, row.rougeL, row.has_steps) == (0.0, 0.0, 0)


def test_one_python_evaluation(spark):
    frame = spark.createDataFrame([(1, "p", "r")], "sample_id int, prediction string, reference string")
    plan = evaluate.score_pairs(frame)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "BatchEvalPython" not in plan


def test_models_are_compared_by_sample(spark):
    rows = [(i, m, f"q{i}", "x y", p) for i in range(8) for m, p in (("base", "x"), ("tuned", "x y" if i % 2 else "z"))]
    frame = spark.createDataFrame(rows, "sample_id int, model string, instruction string, reference string, prediction string")
    results = evaluate.score_pairs(evaluate.require_unique(frame, "model", "sample_id"))
    top = evaluate.top_improved(evaluate.score_delta(results)).collect()
    assert [(r["rank"], r.sample_id) for r in top] == [(1, 1), (2, 3), (3, 5), (4, 7), (5, 0)]
    compared = {r.metric: r for r in evaluate.score_compare(evaluate.score_delta(results)).collect()}
    assert compared["em"].base == 0 and compared["em"].tuned == 0.5
    assert {r.model: r.n for r in evaluate.score_summary(results).collect()} == {"base": 8, "tuned": 8}
    with pytest.raises(ValueError, match="not unique"):
        evaluate.require_unique(frame.union(frame.limit(1)), "model", "sample_id")


def test_sql_functions(spark):
    scoring.register(spark)
    assert tuple(spark.sql("SELECT lcs_length('a b c d', 'b x d'), nfc('e\u0301')").first()) == (2, "\xe9")


def test_final_loss(spark):
    log = spark.createDataFrame([(1, 2.0), (3, 1.5), (5, None)], "step long, loss double")
    assert tuple(evaluate.final_loss(log).first()) == (3, 1.5)


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            before, row[j + 1] = row[j + 1], before + 1 if x == y else max(row[j], row[j + 1])
    return row[-1]


def test_lcs_by_matches_and_by_bits():
    lcs = scoring._lcs_tokens()
    rng = random.Random(6)
    for _ in range(400):
        kinds = rng.choice([1, 2, 5, 40, 1000])
        a, b = ([f"w{rng.randrange(kinds)}" for _ in range(rng.randrange(60))] for _ in range(2))
        a, b = ["p"] * rng.randrange(3) + a + ["s"], ["p"] * rng.randrange(3) + b + ["s"]
        assert lcs(" ".join(a), " ".join(b)) == plain_lcs(a, b)


def test_lcs_of_long_texts_takes_linear_memory():
    """Two texts of 200,000 words: rare matches, and frequent words among rare ones."""
    lcs, rng, n = scoring._lcs_tokens(), random.Random(4), 200_000
    a, b = ([f"{side}{i}" for i in range(n)] for side in "ab")
    for i in range(0, n, 100):
        a[i] = f"c{i}"
        b[n - 100 - i if i < n // 2 else i] = f"c{i}"
    tracemalloc.start()
    found = lcs(" ".join(a), " ".join(b))
    peak = tracemalloc.get_traced_memory()[1]
    assert n // 200 <= found <= n // 100 and peak < 150e6
    zipf = [" ".join(f"w{int(rng.paretovariate(0.6))}" for _ in range(20_000)) for _ in range(2)]
    tracemalloc.reset_peak()
    assert 0 < lcs(*zipf) < 20_000 and tracemalloc.get_traced_memory()[1] < 150e6
    tracemalloc.stop()
