import re
from collections import Counter

import pytest

from answerloom.llm import substring
from tests.llm.plain import repeated_words


def expected(rows, window):
    found = repeated_words([t for _, t, _ in rows], window)
    return Counter((i, len(w), sum(g), " ".join(x for x, y in zip(w, g) if not y)) for (i, _, _), (w, g) in zip(rows, found, strict=True))


@pytest.mark.parametrize("window, group", [(35, 2000), (35, 0), (12, 3)])
def test_words_under_repeated_windows_go(documents, rows, window, group, monkeypatch):
    monkeypatch.setattr(substring, "GROUP_SUFFIXES", group)
    found = substring.remove_repeats(documents, window=window).collect()
    assert Counter((x.doc_id, x.n_words, x.n_removed, bytes(x.kept).decode()) for x in found) == expected(rows, window)


def test_passages_in_other_contexts(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"head{i} " * (i % 9) + passage + f" tail{i}" * (i % 5), "") for i in range(12)]
    rows += [(20, " ".join(passage.split()[:34]), ""), (21, re.sub("p30", "q", passage), "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = substring.remove_repeats(df).collect()
    assert Counter((x.doc_id, x.n_words, x.n_removed, bytes(x.kept).decode()) for x in found) == expected(rows, 35)


def test_empty_table(nothing):
    assert substring.remove_repeats(nothing).collect() == []
