import hashlib
import re
from collections import Counter, defaultdict

import pytest

from answerloom.llm import exact_dedup
from tests.llm.plain import least


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.fixture(scope="module")
def expected(rows):
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[normal(t)].append(i)
    return groups


@pytest.mark.parametrize("broadcast", [True, False])
def test_each_row_gets_its_group(spark, documents, rows, expected, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(exact_dedup, "BROADCAST_ROWS", -1)
    found = exact_dedup.exact_duplicates(documents).collect()
    keys = Counter((x.doc_id, x.keep_id, x.group_size) for x in found)
    assert keys == Counter((i, least(expected[normal(t)]), len(expected[normal(t)])) for i, t, _ in rows)
    assert sum(x.kept for x in found) == len(expected)
    assert all(x.doc_id == x.keep_id for x in found if x.kept)


def test_kept_rows_have_all_columns_and_distinct_texts(documents, expected):
    kept = exact_dedup.drop_duplicates(documents)
    assert kept.columns == documents.columns
    texts = Counter(normal(x.text) for x in kept.collect())
    assert texts == Counter(dict.fromkeys(expected, 1))


def test_empty_table(nothing):
    assert exact_dedup.exact_duplicates(nothing).collect() == []
    assert exact_dedup.drop_duplicates(nothing).collect() == []


def test_equal_heads_and_lengths_are_told_apart(spark):
    a, b = "x" * 100 + "a", "x" * 100 + "b"
    df = spark.createDataFrame([(1, a), (2, b), (3, a)], "doc_id long, text string")
    found = {x.doc_id: (x.keep_id, x.group_size) for x in exact_dedup.exact_duplicates(df).collect()}
    assert found == {1: (1, 2), 2: (2, 1), 3: (1, 2)}


def test_digest(spark):
    df = spark.createDataFrame([("a \n b",), (None,)], "text string").select(exact_dedup.digest("text").alias("d"))
    assert [bytes(x.d) for x in df.collect()] == [hashlib.sha256(t).digest() for t in (b"a b", b"")]


def test_native(documents):
    plan = exact_dedup.exact_duplicates(documents)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
