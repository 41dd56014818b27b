import random

import pytest

WORDS = "the of and to in a is that for it was on are as with his they at be this from or had by".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "x", "yz", "é"]) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """(doc_id, text, source) with null and repeated ids, null, empty and long texts, copies and near copies."""
    rng = random.Random(7)
    long = sentence(rng, 6000)
    base = sentence(rng, 60)
    texts = [None, "", "  \n\t ", "one", "one two three", base, base, base.upper(), base + " extra", base.replace(" ", "\n  "), long, long[:20000]]
    texts += [sentence(rng, rng.randint(1, 200)) for _ in range(20)]
    texts += [" ".join(["again"] * 90), "x" * 5000, "  café\u0000end"]
    out = [(i, t, f"s{i % 3}" if i % 7 else None) for i, t in enumerate(texts)]
    return [*out, (5, base, "s1"), (5, base, "s1"), (None, base, None), (None, "no id", "s2"), (6, "same id, other text", "s0")]


@pytest.fixture(scope="session")
def documents(spark, rows):
    """The rows as documents with further columns, named as operators name theirs."""
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    extra = {"lang": "lang", "n_chars": "n", "row_key": "k", "size": "s", "n_tokens": "t", "score": "0.5", "bucket": "b", "group": "g", "id": "i", "label": "l", "chunk": "c"}
    for name, value in extra.items():
        df = df.selectExpr("*", f"'{value}' AS `{name}`")
    return df.repartition(5)


@pytest.fixture(scope="session")
def nothing(documents):
    return documents.filter("false")
