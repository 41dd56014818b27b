import random
from collections import Counter, defaultdict

import duckdb
import pytest

import corpus_pipeline
from answerloom.llm.queries import ORACLES, QUERIES
from checks.compare import _rows, _types, connect
from tests.llm.test_exact_dedup import normal
from tests.llm.test_jaccard import expected as near
from tests.llm.test_mixing import expected_targets
from tests.llm.plain import shingles

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, DATA), name.replace(" ", "-"))
        out.append(docs.collect())
    return out


def test_toxic_documents_go_and_others_stay(stages):
    labels = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{DATA}/labels.parquet'").fetchall())
    before, after = ({x.doc_id for x in s} for s in stages[:2])
    assert after < before
    assert not [i for i in before - after if labels.get(i) == 0]


def test_one_copy_stays(stages):
    before, after = stages[1:3]
    groups = defaultdict(list)
    for x in before:
        groups[normal(x.text)].append(x)
    assert Counter(after) == Counter(min(g, key=lambda x: x.doc_id) for g in groups.values())


def test_one_near_copy_stays(stages):
    before, after = stages[2:4]
    found, _ = near([(x.doc_id, x.text, None) for x in before])
    assert {x.doc_id for x in after} == {i for i, _, c in found if i == c}


def test_sources_come_near_their_targets(stages):
    before, after = stages[3:5]
    targets, sizes = expected_targets([(x.doc_id, x.text, x.source) for x in before])
    taken, longest = Counter(), Counter()
    for x in before:
        longest[x.source] = max(longest[x.source], len(x.text.split()))
    for x in after:
        taken[x.source] += len(x.text.split())
    assert all(abs(taken[s] - targets[s]) <= longest[s] for s in sizes)
    assert set(after) <= set(before)


def test_ids_decode_to_the_texts(stages):
    import hashlib

    before, after = stages[4:6]
    assert Counter((x.doc_id, hashlib.sha256(x.text.encode()).hexdigest()) for x in before) == Counter((x.doc_id, x.text_sha256) for x in after)
    assert all(len(x.ids) == 4 * x.n_tokens for x in after)


def test_run_is_the_stages_in_turn(spark, stages):
    assert Counter(corpus_pipeline.run(spark, DATA).collect()) == Counter(stages[-1])


@pytest.mark.parametrize("name", ORACLES)
def test_query_agrees_with_sql(spark, name):
    found, expected = QUERIES[name](spark, DATA).toArrow(), connect(DATA).sql(ORACLES[name]).to_arrow_table()
    assert _types(found.schema) == _types(expected.schema)
    assert _rows(found) == _rows(expected)


def test_near_copies_of_five_words_and_four_fifths_go(spark):
    rng, rows = random.Random(3), []
    for i in range(0, 40, 2):
        base = [f"w{rng.randint(0, 10**9)}" for _ in range(230)]
        at, n = rng.randint(30, 180), (20, 20, 19, 21, 24)[i // 2 % 5]
        other = base[:at] + [f"e{rng.randint(0, 10**9)}" for _ in range(n)] + base[at + n :]
        rows += [(i, " ".join(base)), (i + 1, " ".join(other))]
    sets = {i: shingles(t, 5) for i, t in rows}
    near_copies = {i + 1 for i in range(0, 40, 2) if 5 * len(sets[i] & sets[i + 1]) >= 4 * len(sets[i] | sets[i + 1])}
    assert 0 < len(near_copies) < 20
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {x.doc_id for x in corpus_pipeline.drop_near_copies(spark, docs, DATA).collect()} == set(sets) - near_copies
