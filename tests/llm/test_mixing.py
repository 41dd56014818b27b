from collections import defaultdict

import pytest

from answerloom.llm import mixing
from answerloom.llm.common import word_count
from tests.llm.plain import words


def shared_out(sizes, weights, limit):
    """Targets by sharing again until none is above its limit."""
    total, targets, free = sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while free:
        rate = (total - sum(targets[i] for i in range(len(sizes)) if i not in free)) / sum(weights[i] for i in free)
        over = [i for i in free if weights[i] * rate > limit * sizes[i]]
        for i in over:
            targets[i] = limit * sizes[i]
        free -= set(over)
        if not over:
            for i in free:
                targets[i] = weights[i] * rate
            break
    return targets


def expected_targets(rows):
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(words(t))
    names = sorted((s for s in sizes if s is not None), key=str.encode) + [s for s in sizes if s is None]
    return dict(zip(names, shared_out([sizes[s] for s in names], [i % 3 + 1 for i in range(len(names))], 3))), sizes


def test_targets_and_budgets(documents, rows):
    found = mixing.mix(documents, word_count("text")).collect()
    assert len(found) == len(rows)
    targets, sizes = expected_targets(rows)
    by_size = {sizes[s]: targets[s] for s in sizes}
    taken = defaultdict(int)
    for x in found:
        assert by_size[x.source_size] == pytest.approx(x.target)
        assert 0 <= x.taken <= 3 * x.size
        taken[x.source_size] += x.taken
    assert all(abs(taken[sizes[s]] - targets[s]) <= 0.5 for s in sizes)


def test_small_sources_stop_at_three_epochs(spark):
    rows = [(1, "a", "big")] + [(i, "w " * 50, "big") for i in range(2, 40)] + [(100, "w w", "tiny"), (101, "", "void")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {x.doc_id: x for x in mixing.mix(df, word_count("text")).collect()}
    assert (found[100].target, found[100].taken, found[100].copies) == (6.0, 6, 3)
    assert (found[101].target, found[101].taken, found[101].copies) == (0.0, 0, 1)
    assert sum(x.taken for x in found.values()) == sum(x.size for x in found.values())


def test_reruns_and_layouts_agree(documents):
    pick = lambda df: sorted((x.key, x.size, x.row_key, x.taken) for x in mixing.mix(df, word_count("text")).collect())
    assert pick(documents) == pick(documents.repartition(1))


def test_rows_come_as_often_as_they_are_taken(documents):
    copies = sum(x.copies for x in mixing.mix(documents, word_count("text")).collect())
    mixed = mixing.take_mix(documents, word_count("text"))
    assert mixed.columns == documents.columns
    assert mixed.count() == copies


def test_empty_table(nothing):
    assert mixing.mix(nothing, word_count("text")).collect() == []
    assert mixing.take_mix(nothing, word_count("text")).collect() == []
