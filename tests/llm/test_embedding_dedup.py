import numpy as np
import pytest

from answerloom.llm import embedding_dedup
from tests.llm.plain import components


def brute(rows, threshold, dimension):
    def unit(v):
        if v is None or len(v) != dimension or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, float)
        return v / np.linalg.norm(v)

    units = [unit(v) for _, v in rows]
    links = [
        (a, b) for a in range(len(rows)) for b in range(a) if units[a] is not None and units[b] is not None and units[a] @ units[b] >= threshold
    ]
    degree = np.bincount(np.array(links, int).reshape(-1), minlength=len(rows))
    label = components(len(rows), links)
    least = {}
    for (i, _), c in zip(rows, label):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    return sorted((str(i), int(d), str(least.get(c))) for (i, _), d, c in zip(rows, degree, label))


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + rng.normal(size=16) * (0.05 if i % 3 else 0.4)).astype(np.float32).tolist()) for i in range(300)]
    same = rows[0][1]
    odd = [same, same, [2 * x for x in same], [-x for x in same], None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0], [1e-30] * 16]
    return rows + [(1000 + i, v) for i, v in enumerate(odd)] + [(None, same), (3, same), (3, rows[3][1])]


@pytest.mark.parametrize("block", [embedding_dedup.BLOCK_BYTES, 4096])
def test_links_against_brute_force(spark, vectors, block, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK_BYTES", block)
    monkeypatch.setattr(embedding_dedup, "TILE_ROWS", 32)
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").selectExpr("*", "'x' AS key", "1 AS label").repartition(3)
    found = embedding_dedup.linked_vectors(df).collect()
    assert sorted((str(x.vec_id), x.n_links, str(x.component_id)) for x in found) == brute(vectors, 0.95, 16)
    assert all(x.kept == (x.vec_id == x.component_id) for x in found)


def test_tables_without_usable_vectors(spark):
    df = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<double>")
    assert sorted(tuple(x) for x in embedding_dedup.linked_vectors(df).collect()) == [(1, 0, 1, True), (2, 0, 2, True)]
    assert embedding_dedup.linked_vectors(df.filter("false")).collect() == []


def test_tiles_give_up_no_pair():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 24)) * np.linspace(3, 0.1, 24)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    i, j = embedding_dedup.tile_links(x, x, 0.9)
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*(k.tolist() for k in np.nonzero(x @ x.T >= 0.9 - 1e-9))))


def brute_of_equal_length(rows, threshold):
    """Links of any two usable vectors of equal length."""
    units = [np.array(v, float) if v and all(x is not None and np.isfinite(x) for x in v) and any(v) else None for _, v in rows]
    units = [None if u is None else u / np.linalg.norm(u) for u in units]
    some = [i for i, u in enumerate(units) if u is not None]
    links = [(a, b) for a in some for b in some if b < a and len(units[a]) == len(units[b]) and units[a] @ units[b] >= threshold]
    degree = np.bincount(np.array(links, int).reshape(-1), minlength=len(rows))
    label, least = components(len(rows), links), {}
    for (i, _), c in zip(rows, label):
        least[c] = min(least.get(c, i), i)
    return sorted((i, int(d), least[c]) for (i, _), d, c in zip(rows, degree, label))


@pytest.fixture(scope="module")
def lengths():
    """Two common lengths and some of one or two rows, beside more empty arrays than vectors of any length."""
    rng = np.random.default_rng(5)
    near = lambda d, n: [(c + rng.normal(size=d) * 0.07).astype(np.float32).tolist() for c in rng.normal(size=(n // 6, d)) for _ in range(6)]
    vectors = near(16, 120) + near(24, 90) + near(40, 6) + [[3.0], [5.0], [-1.0], [1.0, 0.0, 2.0]] + [[]] * 150
    return [(i, vectors[j]) for i, j in enumerate(rng.permutation(len(vectors)))]


@pytest.mark.parametrize("block, axes", [(embedding_dedup.BLOCK_BYTES, embedding_dedup.AXES_BYTES), (4096, 3000), (4096, 0)])
def test_every_length_is_compared(spark, lengths, block, axes, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK_BYTES", block)
    monkeypatch.setattr(embedding_dedup, "AXES_BYTES", axes)
    df = spark.createDataFrame(lengths, "vec_id long, embedding array<float>").repartition(3)
    found = sorted((x.vec_id, x.n_links, x.component_id) for x in embedding_dedup.linked_vectors(df).collect())
    assert found == brute_of_equal_length(lengths, 0.95)


@pytest.fixture(scope="module")
def one_place():
    """A third of the rows scaled copies of one vector, exact and rounded ones, and a third of one place on the first axis."""
    rng = np.random.default_rng(6)
    one = rng.normal(size=16).astype(np.float32)
    scaled = [one * np.float32(2.0 ** (i % 20 - 10) if i % 2 else rng.uniform(0.1, 9)) for i in range(120)]
    flat = [np.concatenate([[0], c + rng.normal(size=15) * 0.1]) for c in rng.normal(size=(12, 15)) for _ in range(10)]
    others = [c + rng.normal(size=16) * 0.1 for c in rng.normal(size=(12, 16)) for _ in range(10)]
    vectors = [np.asarray(v, np.float32).tolist() for v in scaled + flat + others]
    return [(i, vectors[j]) for i, j in enumerate(rng.permutation(len(vectors)))]


@pytest.mark.parametrize("plain", [False, True])
def test_links_are_counted_once_where_many_share_a_place(spark, one_place, plain, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK_BYTES", 4096)
    if plain:
        monkeypatch.setattr(embedding_dedup, "AXES_BYTES", 0)
    df = spark.createDataFrame(one_place, "vec_id long, embedding array<float>").repartition(3)
    found = sorted((x.vec_id, x.n_links, x.component_id) for x in embedding_dedup.linked_vectors(df).collect())
    assert found == brute_of_equal_length(one_place, 0.95)
