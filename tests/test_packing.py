import random

import pytest

from answerloom.operators import packing


def one_pass(rows, budget):
    packs = []
    for key, n in sorted(rows):
        if not packs or packs[-1][1] + n > budget:
            packs.append(([], 0))
        packs[-1] = (packs[-1][0] + [key], packs[-1][1] + n)
    return [(k, ids, n) for k, (ids, n) in enumerate(packs)]


def packed(frame, budget, **how):
    return sorted((p.pack_id, p.ids, p.n_tokens) for p in packing.pack_in_order(frame, "id", "n", budget, **how).collect())


CASES = {
    "short": lambda rng: rng.randrange(1, 40),
    "some too long": lambda rng: rng.choice([1, 5, 99, 100, 101, 500]),
    "many empty": lambda rng: rng.choice([0, 0, 0, 0, 0, 0, 1, 60, 100, 101]),
    "all empty": lambda rng: 0,
    "full": lambda rng: 100,
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("run_rows", [packing.RUN_ROWS, 7])
def test_packs_are_those_of_one_pass(spark, case, run_rows, monkeypatch):
    monkeypatch.setattr(packing, "RUN_ROWS", run_rows)
    rng = random.Random(3)
    rows = [(i // 2 if i % 50 == 0 else i, CASES[case](rng)) for i in range(700)]
    want = one_pass(rows, 100)
    shuffled = random.Random(1).sample(rows, len(rows))
    frame = spark.createDataFrame(shuffled, "id long, n int").repartition(5)
    for parts in (1, 6) if run_rows == 7 else (3,):
        assert packed(frame, 100, parts=parts) == want


def test_other_keys_and_bad_rows(spark):
    frame = spark.createDataFrame([("b", 60), ("a", 50), ("c", 10)], "id string, n int")
    assert packed(frame, 100) == [(0, ["a"], 50), (1, ["b", "c"], 70)]
    assert packed(frame.limit(0), 100) == []
    for row in ((None, 1), ("d", None), ("d", -1)):
        with pytest.raises(Exception, match="a row to pack"):
            packed(frame.union(spark.createDataFrame([row], frame.schema)), 100)
