import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from answerloom.llm import jaccard
from answerloom.llm.components import components as spark_components
from tests.llm.plain import components, least, shingles

shingles_of = shingles


def expected(rows, percent=85):
    sets = [shingles(t) for _, t, _ in rows]
    links = [
        (a, b) for a, b in itertools.combinations(range(len(rows)), 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    parts = defaultdict(list)
    label = components(len(rows), links)
    for i, c in enumerate(label):
        parts[c].append(rows[i][0])
    return [(rows[i][0], len(sets[i]), least(parts[label[i]])) for i in range(len(rows))], len(parts)


def family(rng, n_docs, n_words, edits):
    base = [f"w{rng.randint(0, 10**9)}" for _ in range(n_words)]
    out = []
    for _ in range(n_docs):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"e{rng.randint(0, 10**9)}"
        out.append(" ".join(w[: len(w) - rng.randint(0, 3)]))
    return out


@pytest.fixture(scope="module")
def families():
    rng = random.Random(11)
    texts = [t for size in (5, 6, 7, 9, 13, 25, 60, 150, 400) for t in family(rng, 25, size, max(1, size // 20))]
    texts += family(rng, 60, 80, 5)
    return [(i, t, None) for i, t in enumerate(texts)]


@pytest.mark.parametrize("slice_bytes, region", [(jaccard.SLICE_BYTES, jaccard.REGION_SHINGLES), (4000, 700)])
def test_families_of_near_copies(spark, families, slice_bytes, region, monkeypatch):
    monkeypatch.setattr(jaccard, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(jaccard, "BUCKET_BYTES", 20_000)
    monkeypatch.setattr(jaccard, "REGION_SHINGLES", region)
    monkeypatch.setattr(jaccard, "SKETCHED_SHINGLES", region)
    df = spark.createDataFrame(families, "doc_id long, text string, source string").repartition(3)
    found = jaccard.jaccard_components(df).collect()
    assert Counter((x.doc_id, x.n_shingles, x.component_id) for x in found) == Counter(expected(families)[0])


def test_odd_rows(documents, rows):
    found = jaccard.jaccard_components(documents).collect()
    assert Counter((x.doc_id, x.n_shingles, x.component_id) for x in found) == Counter(expected(rows)[0])


def test_one_row_of_each_component_stays(documents, rows):
    kept = jaccard.drop_near_duplicates(documents)
    assert kept.columns == documents.columns
    assert kept.count() == expected(rows)[1]


def test_empty_table(nothing):
    assert jaccard.jaccard_components(nothing).collect() == []
    assert jaccard.drop_near_duplicates(nothing).collect() == []


def test_components_of_paths_and_stars(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7000 - i, 7001 - i) for i in range(40)]
    links += [(rng.randint(20_000, 20_060), rng.randint(20_000, 20_060)) for _ in range(50)] + [(5, 5), (90_000, 90_000), (None, 3)]
    known = [x for x in links if None not in x]
    nodes = sorted({x for link in known for x in link})
    label = components(len(nodes), [(nodes.index(a), nodes.index(b)) for a, b in known])
    best = {c: min(n for n, k in zip(nodes, label) if k == c) for c in set(label)}
    found = {x.node: x.component for x in spark_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {n: best[c] for n, c in zip(nodes, label, strict=True)}


def test_shingles_of_five_words(spark, families, monkeypatch):
    monkeypatch.setitem(globals(), "shingles", lambda text: shingles_of(text, 5))
    df = spark.createDataFrame(families, "doc_id long, text string, source string").repartition(3)
    found = jaccard.jaccard_components(df, percent=80, width=5).collect()
    assert Counter((x.doc_id, x.n_shingles, x.component_id) for x in found) == Counter(expected(families, 80)[0])


@pytest.fixture(scope="module")
def passages():
    """Families whose members open with 0 to 90 % of one passage, and strangers that have the whole passage."""
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(300)]
    texts = []
    for size in (12, 40, 90):
        for share in (0, 0.15, 0.4, 0.7, 0.9):
            texts += [" ".join([*passage[: int(share * size / (1 - share))], t]) for t in family(rng, 6, size, max(1, size // 12))]
    texts += [" ".join([f"s{rng.randint(0, 10**9)}" for _ in range(rng.randint(20, 260))] + passage[100:130]) for _ in range(450)]
    return [(i, t, None) for i, t in enumerate(texts)]


@pytest.mark.parametrize("most, broadcast", [(1_000_000, 200_000), (40, 0), (0, 0)])
def test_strangers_do_not_meet_over_a_common_passage(spark, passages, most, broadcast, monkeypatch):
    counted = {}

    def counting(df, name, write=jaccard.materialize):
        table = write(df, name)
        counted.setdefault(name, table.count())
        return table

    monkeypatch.setattr(jaccard, "materialize", counting)
    monkeypatch.setattr(jaccard, "MOST_COMMON", most)
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", broadcast)
    monkeypatch.setattr(jaccard, "SLICE_BYTES", 60_000)
    df = spark.createDataFrame(passages, "doc_id long, text string, source string").repartition(3)
    found = jaccard.jaccard_components(df, percent=80, rare=True).collect()
    assert Counter((x.doc_id, x.n_shingles, x.component_id) for x in found) == Counter(expected(passages, 80)[0])
    if most > 1000:
        assert counted["candidates"] < 200, counted


def test_sketches_bound_what_sets_share():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 31, 32, 33, 500, 3000):
        for share in (0.0, 0.3, 0.8, 0.95, 1.0):
            m = max(1, int(n * rng.uniform(0.8, 1.2)))
            common = rng.integers(0, 1 << 64, int(share * min(n, m)), np.uint64)
            a, b = (np.unique(np.concatenate([common, rng.integers(0, 1 << 64, k - len(common), np.uint64)])) for k in (n, m))
            sent = [jaccard.sketches(x, np.array([len(x)]))[0] for x in (a, b)]
            size = min(map(len, sent))
            most = jaccard.most_shared(jaccard.folded(sent[0], size), jaccard.folded(sent[1], size)[None], len(a), np.array([len(b)]))[0]
            shared = len(np.intersect1d(a, b))
            assert shared <= most <= min(len(a), len(b))
            if n >= 500 and share <= 0.3:
                assert 100 * most < 80 * (len(a) + len(b) - most)  # strangers that share a passage are told apart
