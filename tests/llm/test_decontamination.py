import random
import re
from collections import Counter

import pytest

from answerloom.llm import decontamination
from tests.llm.plain import LOWER

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def places(text):
    return [m.span() for m in WORD.finditer((text or "").encode().translate(LOWER))]


def words(text):
    raw = (text or "").encode().translate(LOWER)
    return [raw[a:b] for a, b in places(text)]


def brute(text, benchmark, width):
    """(words, places of hit words, items)."""
    w, hit, items = words(text), set(), set()
    for item, other in benchmark:
        v = words(other)
        size = min(len(v), width)
        windows = {tuple(v[i : i + size]) for i in range(len(v) - size + 1)} if v else set()
        for i in range(len(w) - size + 1):
            if tuple(w[i : i + size]) in windows:
                hit |= set(range(i, i + size))
                items.add("" if item is None else str(item))
    return len(w), hit, sorted(items)


@pytest.fixture(scope="module")
def case(spark):
    """Few words, so that windows occur often; rows repeated, without id or text, of one word, in other scripts, long."""
    rng = random.Random(3)

    def text(n):
        return "".join(rng.choice(["ab", "AB", "c", "é", "12", "ñandú", "z"]) + rng.choice([" ", "-", "\n", ", ", "@[", "\x00"]) for _ in range(n))

    items = [(i % 25, text(rng.randint(1, 12))) for i in range(30)] + [(None, "c c c c"), (99, ""), (98, None), (97, "?!"), (96, text(300)), (3, "word unlike others"), (3, "word unlike others")]
    docs = [(i, text(rng.randint(0, 60))) for i in range(60)] + [(None, "x c c c c y"), (5, None), (6, ""), (7, "...")]
    docs += [(70, text(4000) + items[-3][1]), (71, "Word-Unlike/others"), (71, "Word-Unlike/others"), (72, "word unlike words")]
    schema = "{} long, text string, row_key string, cuts int, spans int"
    return (
        docs, items,
        spark.createDataFrame([(*d, "k", 1, 2) for d in docs], schema.format("doc_id")).repartition(4),
        spark.createDataFrame([(*i, "k", 1, 2) for i in items], schema.format("item_id")).repartition(3),
    )


@pytest.mark.parametrize(("width", "settings"), [(4, {}), (10, {}), (4, {"hash_bits": 3}), (4, {"block_words": 400, "piece_words": 40})], ids=["4", "10", "one hash for many", "blocks"])
def test_hits_and_items_are_those_of_brute_force(case, width, settings):
    docs, items, df, benchmark = case
    found = decontamination.find_contamination(df, benchmark, width=width, **settings).collect()
    want = []
    for doc_id, text in docs:
        n, hit, names = brute(text, items, width)
        at, spans = places(text), []
        for k in sorted(hit):
            if spans and spans[-1][0] + spans[-1][1] == k:
                spans[-1] = (spans[-1][0], spans[-1][1] + 1, spans[-1][2], at[k][1] - spans[-1][2])
            else:
                spans.append((k, 1, at[k][0], at[k][1] - at[k][0]))
        want.append((doc_id, n, len(hit), tuple(spans), tuple(names)))
    assert Counter((x.doc_id, x.n_words, x.n_hit, tuple(map(tuple, x.spans)), tuple(x["items"])) for x in found) == Counter(want)


@pytest.mark.parametrize("settings", [{}, {"block_words": 400, "piece_words": 40}], ids=["one block", "blocks"])
def test_spans_or_documents_go(case, settings):
    docs, items, df, benchmark = case
    rest = decontamination.remove_spans(df, benchmark, width=4, **settings)
    assert rest.columns == df.columns
    want, clean, half = [], [], []
    for doc_id, text in docs:
        n, hit, _ = brute(text, items, 4)
        raw, at = (text or "").encode(), places(text)
        gone = bytearray(len(raw))
        for k in hit:
            gone[at[k][0] : at[k][1]] = b"\1" * (at[k][1] - at[k][0])
            if k + 1 in hit:
                gone[at[k][1] : at[k + 1][0]] = b"\1" * (at[k + 1][0] - at[k][1])
        want.append((doc_id, text if text is None else bytes(b for b, g in zip(raw, gone, strict=True) if not g).decode(), "k", 1, 2))
        clean += [] if hit else [(doc_id, text)]
        half += [] if len(hit) > n / 2 else [(doc_id, text)]
    assert Counter(map(tuple, rest.collect())) == Counter(want)
    kept = decontamination.drop_contaminated(df, benchmark, width=4, **settings)
    assert kept.columns == df.columns and Counter((x.doc_id, x.text) for x in kept.collect()) == Counter(clean)
    kept = decontamination.drop_contaminated(df, benchmark, width=4, share=0.5, **settings)
    assert Counter((x.doc_id, x.text) for x in kept.collect()) == Counter(half)


def test_empty_tables(case):
    _, _, df, benchmark = case
    assert decontamination.find_contamination(df.filter("false"), benchmark).count() == 0
    found = decontamination.find_contamination(df, benchmark.filter("false")).agg({"n_hit": "max", "*": "count"}).first()
    assert tuple(found) == (0, df.count()) or tuple(found) == (df.count(), 0)
    assert decontamination.remove_spans(df, benchmark.filter("false")).exceptAll(df).count() == 0


def test_blocks_are_bounded(case):
    _, _, _, benchmark = case
    dealt, n = decontamination.benchmark_blocks(benchmark, "item_id", "text", 4, 60, 9)
    assert n > 1 and all(x.n <= 60 for x in dealt.groupBy("block").agg({"n": "sum"}).toDF("block", "n").collect())
    with pytest.raises(ValueError, match="piece"):
        decontamination.benchmark_blocks(benchmark, "item_id", "text", 10, 60, 9)
