import math
import random
from collections import defaultdict

import numpy as np
import pytest

from answerloom.llm import whitening


def usable(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


@pytest.fixture(scope="module")
def vectors():
    """Correlated, constant and copied columns, three lengths, unusable vectors, repeated rows, a null id, huge entries."""
    rng = random.Random(4)
    rows = []
    for i in range(300):
        a, b = rng.gauss(0, 1), rng.gauss(0.4, 0.1)
        rows.append((i, [a, b, a + 0.01 * b, rng.gauss(0, 0.02), 0.5, a, rng.gauss(7, 3), -2 * b]))
    rows += [(i, [rng.gauss(0, 1), rng.gauss(0, 1)]) for i in range(1000, 1040)]
    rows += [(2000, [1.0, 2.0, 3.0]), (2001, [1.0, 2.0, 3.0]), (2002, []), (2003, [4.0])]
    rows += [(3000, None), (3001, [1.0, None] * 4), (3002, [math.nan] * 8), (3003, [math.inf] + [0.0] * 7), (3004, [-math.inf, 0.0])]
    rows += [rows[5], rows[5], (None, rows[6][1]), (4000, [1e300, 0.0, 1.0, 2.0]), (4001, [-1e300, 1.0, 1.0, 2.5]), (4002, [3.0, 1.5, 1.0, 2.0])]
    return rows


@pytest.fixture(scope="module")
def frame(spark, vectors):
    schema = "vec_id long, embedding array<double>, id string, vector int, n int, component string"
    return spark.createDataFrame([(*v, "x", 1, 2, "y") for v in vectors], schema).repartition(5)


def whole(c):
    return max(-whitening.LARGEST, min(whitening.LARGEST, math.floor(64 * c) if abs(c) < 1e200 else math.copysign(whitening.LARGEST, c))) + 1_000_000


@pytest.mark.parametrize("numbers", [whitening.MODEL_NUMBERS, 20], ids=["one block", "blocks"])
def test_whitened_is_what_numpy_finds(frame, vectors, numbers, monkeypatch):
    monkeypatch.setattr(whitening, "MODEL_NUMBERS", numbers)
    found = defaultdict(list)
    for x in whitening.whiten(frame, components=6).collect():
        found[x.vec_id].append(x)
    by_length = defaultdict(list)
    for i, v in vectors:
        if usable(v):
            by_length[len(v)].append((i, [whole(c) for c in v]))
    want = set()
    for length, rows in by_length.items():
        n = len(rows)
        sums = [sum(int(x[k]) for _, x in rows) for k in range(length)]
        exact = [[n * int(x[k]) - sums[k] for k in range(length)] for _, x in rows]
        y = np.array(exact, dtype=object).astype(float) / n
        cov = y.T @ y / n if length else np.zeros((0, 0))
        values, basis = np.linalg.eigh(cov) if length else (np.zeros(0), cov)
        rank = int((values > 1e-9 * max(values, default=0)).sum())
        for k in range(min(rank, 6)):
            value, axis = values[-1 - k], basis[:, -1 - k]
            want |= {(i, k + 1) for i, _ in rows}
            for at, (i, _) in enumerate(rows):
                for x in (r for r in found[i] if r.component == k + 1):
                    deviation = sum(d * d for d in exact[at])
                    assert x.n == n and x.deviation == (deviation if deviation < 2**63 else None)
                    assert x.explained == pytest.approx(value / np.trace(cov), rel=1e-9)
                    assert abs(x.whitened) == pytest.approx(abs(y[at] @ axis / np.sqrt(value)), abs=1e-6)
                    assert x.identity_error < 1e-6
    assert want == {(i, x.component) for i, xs in found.items() for x in xs}
    assert len(found[5]) == 3 * len(found[7])


def test_signs_and_covariance(frame, vectors):
    """Components have one sign for all rows: the whitened covariance is the identity."""
    rows = [x for x in whitening.whiten(frame).collect() if (x.vec_id or 0) < 1000 or x.vec_id is None]
    w = defaultdict(dict)
    for k, x in enumerate(sorted(rows, key=lambda x: x.component)):
        w[x.component].setdefault(x.vec_id, []).append(x.whitened)
    table = np.array([[v for i in sorted(w[c], key=str) for v in w[c][i]] for c in sorted(w)])
    assert np.abs(np.cov(table, bias=True) - np.eye(len(table))).max() < 1e-9
    assert rows[0].identity_error < 1e-9


def test_factors_agree_with_the_scatter():
    rng = np.random.default_rng(0)
    for n, rank in ((1, 1), (5, 5), (12, 4), (33, 33), (64, 64), (6, 0)):
        a = rng.normal(size=(n, rank)) * 10.0 ** rng.integers(-3, 4, rank)
        scatter = a @ a.T
        factor, order = whitening.pivoted_cholesky(scatter)
        assert factor.shape[1] == rank and np.allclose(factor @ factor.T, scatter[order][:, order], atol=1e-9 * (scatter.max(initial=1)))
        values, vectors = whitening.principal_components(scatter)
        assert np.allclose(vectors.T @ vectors, np.eye(rank), atol=1e-12)
        assert np.allclose(vectors * values @ vectors.T, scatter, rtol=1e-10, atol=1e-10 * scatter.max(initial=1))
        assert np.allclose(values, np.linalg.eigvalsh(scatter)[::-1][:rank], rtol=1e-8)


def test_rounds_hold_every_pair_once():
    for n in range(1, 12):
        pairs = [(min(p), max(p)) for a, b in whitening.rounds(n) for p in zip(a.tolist(), b.tolist())]
        assert sorted(pairs) == [(i, j) for i in range(n) for j in range(i + 1, n)]
        assert all(len({*a.tolist(), *b.tolist()}) == 2 * len(a) for a, b in whitening.rounds(n))


def test_empty_table(frame):
    assert whitening.whiten(frame.filter("false")).count() == 0
    assert whitening.whiten(frame.filter("embedding is null")).columns[0] == "vec_id"
