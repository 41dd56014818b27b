import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from answerloom.llm import ppm
from tests.llm.plain import Ppm, low_words


def trained(doc_id):
    return doc_id is None or doc_id % 3 != 0


@pytest.mark.parametrize("chunk", [ppm.CHUNK_BYTES, 20_000])
def test_scores_against_a_plain_model(documents, rows, chunk, monkeypatch):
    monkeypatch.setattr(ppm, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(ppm, "PART_BYTES", 50_000)
    model = Ppm(ppm.ORDER, [t for i, t, _ in rows if trained(i)])
    counts = Counter(x for i, t, _ in rows if trained(i) for x in [*low_words(t), None])
    total = sum(counts.values())
    expected = []
    for i, t, _ in rows:
        x = model.stream(t)
        score = sum(math.log10(model.probability(x[p - ppm.ORDER : p], x[p])) for p in range(ppm.ORDER, len(x)))
        tokens = [*low_words(t), None]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (len(counts) + 1))) for w in tokens)
        expected.append((-1 if i is None else i, len(tokens), sum(counts[w] > 0 for w in tokens), total, base, score))
    found = ppm.score_texts(documents, F.col("doc_id") % 3 != 0).collect()
    got = [(-1 if x.doc_id is None else x.doc_id, *x[1:]) for x in found]
    for a, b in zip(sorted(got), sorted(expected), strict=True):
        assert a[:4] == b[:4]
        assert a[4:] == pytest.approx(b[4:], rel=1e-5)


def test_probabilities_of_a_context_add_up_to_one():
    model = Ppm(ppm.ORDER, ["the cat sat on the mat", "that hat"])
    for context in (b"\n" * 6, b" the c", b"zzzzzz"):
        assert sum(model.probability(context, b) for b in range(256)) == pytest.approx(1)


def test_without_training_all_bytes_are_equally_likely(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None)], "doc_id long, text string")
    found = {x.doc_id: x for x in ppm.score_texts(df, F.lit(False)).collect()}
    assert found[1].score == pytest.approx(-3 * math.log10(256), rel=1e-6)
    assert (found[2].n_tokens, found[2].n_known, found[2].train_tokens) == (1, 0, 0)


def test_empty_table(nothing):
    assert ppm.score_texts(nothing, F.lit(True)).collect() == []


def test_stream_of_words():
    data = np.frombuffer(b" The  CatA", np.uint8)
    stream = ppm.Stream(data, np.array([0, 9, 9, 10]))
    assert bytes(stream.bytes[stream.places]) == b"the cat\n\na\n"
