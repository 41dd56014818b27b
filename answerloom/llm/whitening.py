"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor.

An entry c becomes the whole number x = floor(64 * c) + 1000000. One pass sums the columns exactly. The next subtracts from
each x the whole number nearest to its column's mean and multiplies what is left, which is small: sums of its products are
whole numbers that double precision holds exactly up to 2^53, so they do not depend on how rows are dealt. The rest of
the mean, less than one half, is taken off the sums. The scatter A is factored as L L' with the largest remaining diagonal
entry as pivot, up to its rank, and the columns of L are rotated in pairs until they are orthogonal: their squared norms
are the eigenvalues of A, the columns over their norms its eigenvectors. Disjoint pairs are rotated at once. A third pass
whitens all vectors to measure how far their covariance is from the identity, a fourth returns them.

Vectors of different lengths are told apart: each length has its own fit, its n and its components. Tasks pre-aggregate,
and what is shuffled are sums, d * d / 2 numbers a task for vectors of d entries. A length is factored in a task of its
own, which holds a few d * d matrices. Fits are broadcast for up to ``MODEL_NUMBERS`` numbers, counted first; more lengths than
that are taken in blocks, each with passes of its own.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerloom.llm.arrowtext import gather
from answerloom.storage import materialize

SCALE, OFFSET = 64, 1_000_000
LARGEST = 1 << 41  # of floor(64 * c)
COMPONENTS = 32
MODEL_NUMBERS = 4 << 20
ENTRIES_AT_ONCE = 1 << 20
HELD_ENTRIES = 8 << 20  # of the sums a task holds before it sends them on
SWEEPS = 60


def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(batch, rows, floor(64 * c) of their vectors) for vectors of one length, a bounded number of entries at a time."""
    for batch in batches:
        column = batch.column("vector")
        lengths = column.value_lengths().to_numpy()
        begin = np.cumsum(lengths) - lengths
        values = column.flatten().to_numpy()
        for length in np.unique(lengths[lengths > 0]).tolist():
            rows = np.flatnonzero(lengths == length)
            step = max(1, ENTRIES_AT_ONCE // length)
            for k in range(0, len(rows), step):
                own = rows[k : k + step]
                c = values[gather(begin[own], lengths[own])].reshape(len(own), length)
                with np.errstate(over="ignore"):
                    c = np.floor(SCALE * c)
                yield batch, own, np.clip(c, -LARGEST, LARGEST).astype(np.int64)


def column_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(length, dim, total): sums of x by column, and the number of vectors as dim -1."""
    for _, rows, x in matrices(batches):
        total = [len(rows), *(x.sum(0) + len(rows) * OFFSET).tolist()]
        columns = [pa.array(np.full(len(total), x.shape[1]), pa.int32()), pa.array(np.arange(-1, len(total) - 1), pa.int32()), pa.array(total, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["length", "dim", "total"])


def centred_products(fits):
    """(length, i, j, total): sums of products of centred columns i <= j."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}

        def sent() -> Iterator[pa.RecordBatch]:
            for length, sums in held.items():
                i, j = np.triu_indices(length)
                columns = [pa.array(np.full(len(i), length), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(sums[i, j])]
                yield pa.RecordBatch.from_arrays(columns, names=["length", "i", "j", "total"])

        for _, _, x in matrices(batches):
            length = x.shape[1]
            if length not in fits.value:
                continue
            if length not in held and sum(s.size for s in held.values()) + length * length > HELD_ENTRIES:
                yield from sent()
                held.clear()
            y = (x - (fits.value[length]["centre"] - OFFSET)).astype(np.float64)
            held[length] = held.get(length, 0.0) + y.T @ y
        yield from sent()

    return run


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(L, order) with a[order][:, order] = L L'; as many columns as the rank."""
    d = len(a)
    order, left = np.arange(d), a.diagonal().copy()
    least = d * np.finfo(float).eps * left.max(initial=0.0)
    factor = np.zeros((d, d))
    for k in range(d):
        p = k + int(left[k:].argmax())
        if left[p] <= least:
            return factor[:, :k], order
        for held in (order, left, factor):
            held[[k, p]] = held[[p, k]]
        factor[k, k] = np.sqrt(left[k])
        rest = order[k + 1 :]
        factor[k + 1 :, k] = (a[rest, order[k]] - factor[k + 1 :, :k] @ factor[k, :k]) / factor[k, k]
        left[k + 1 :] -= factor[k + 1 :, k] ** 2
    return factor, order


def rounds(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Every pair of n columns once, in rounds of disjoint pairs."""
    ring = [*range(n), *([-1] if n % 2 else [])]
    out = []
    for _ in range(len(ring) - 1):
        pairs = [(a, b) for a, b in zip(ring[: len(ring) // 2], ring[::-1], strict=False) if a >= 0 and b >= 0]
        out.append((np.array([a for a, _ in pairs], np.int64), np.array([b for _, b in pairs], np.int64)))
        ring = [ring[0], ring[-1], *ring[1:-1]]
    return out


def orthogonal_columns(factor: np.ndarray) -> np.ndarray:
    """The columns rotated in pairs until all are orthogonal; the product with its transpose stays."""
    g = factor.copy()
    pairs = rounds(g.shape[1])
    for _ in range(SWEEPS):
        worst = 0.0
        for p, q in pairs:
            a, b = g[:, p], g[:, q]
            aa, bb, ab = (np.einsum("ij,ij->j", u, v) for u, v in ((a, a), (b, b), (a, b)))
            cosine = np.abs(ab) / np.sqrt(aa * bb)
            worst = max(worst, cosine.max(initial=0.0))
            turn = cosine > np.finfo(float).eps
            zeta = (bb - aa) / np.where(turn, 2 * ab, 1.0)
            t = np.where(turn, np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta)), 0.0)
            c = 1 / np.hypot(1.0, t)
            g[:, p], g[:, q] = c * a - c * t * b, c * t * a + c * b
        if worst < 4 * np.finfo(float).eps:
            break
    return g


def principal_components(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of a scatter, as many as its rank."""
    factor, order = pivoted_cholesky(scatter)
    g = orthogonal_columns(factor)
    norms = np.sqrt((g * g).sum(0))
    fall = np.argsort(-norms, kind="stable")
    vectors = np.zeros_like(g)
    vectors[order] = g[:, fall] / norms[fall]
    largest = np.abs(vectors).argmax(0)
    return norms[fall] ** 2, vectors * np.where(vectors[largest, np.arange(len(fall))] < 0, -1.0, 1.0)


def factored(fits, most: int):
    """(length, component, value, share, vector) of one length's sums of products."""

    def run(table: pa.Table) -> pa.Table:
        length = table.column("length")[0].as_py()
        fit = fits.value[length]
        i, j, total = (table.column(c).to_numpy() for c in ("i", "j", "total"))
        scatter = np.zeros((length, length))
        scatter[i, j] = scatter[j, i] = total
        rest = np.array(fit["rest"], np.float64)
        scatter -= np.outer(rest, rest) / fit["n"]
        values, vectors = principal_components(scatter)
        k = min(most, len(values))
        columns = [
            pa.array([length] * k, pa.int32()), pa.array(range(1, k + 1), pa.int32()), pa.array(values[:k] / fit["n"]),
            pa.array(values[:k] / (scatter.trace() or 1.0)), pa.array(list(vectors.T[:k]), pa.list_(pa.float64())),
        ]
        return pa.Table.from_arrays(columns, names=["length", "component", "value", "share", "vector"])

    return run


def projected(x: np.ndarray, fit: dict) -> np.ndarray:
    y = (x - (fit["centre"] - OFFSET)).astype(np.float64) - np.array(fit["rest"], np.float64) / fit["n"]
    return y @ fit["vectors"] / np.sqrt(fit["values"])


def whitened_products(fits):
    """(length, i, j, total): sums of products of whitened columns i <= j, and of each column as j -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = defaultdict(float)
        for _, _, x in matrices(batches):
            fit = fits.value.get(x.shape[1])
            if fit:
                w = projected(x, fit)
                held[x.shape[1]] += np.concatenate([w, np.ones((len(w), 1))], 1).T @ w
        for length, sums in held.items():
            i, j = np.indices(sums.T.shape)
            j = np.where(j == sums.shape[1], -1, j)
            some = (j < 0) | (i <= j)
            columns = [pa.array(np.full(some.sum(), length), pa.int32()), pa.array(i[some], pa.int32()), pa.array(j[some], pa.int32()), pa.array(sums.T[some])]
            yield pa.RecordBatch.from_arrays(columns, names=["length", "i", "j", "total"])

    return run


def deviations(x: np.ndarray, fit: dict) -> pa.Array:
    """Exact sums of (n * x - S)^2, null where 64 bits do not hold one."""
    n, rest = fit["n"], fit["rest"]
    y = x - (fit["centre"] - OFFSET)
    largest = n * int(np.abs(y).max(initial=0)) + max(map(abs, rest))
    if largest * largest * len(rest) < 1 << 63:
        return pa.array(((n * y - np.array(rest, np.int64)) ** 2).sum(1), pa.int64())
    exact = ((y.astype(object) * n - np.array(rest, object)) ** 2).sum(1).tolist()
    return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())


def whitened_rows(fits, id_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, rows, x in matrices(batches):
            fit = fits.value.get(x.shape[1])
            if not fit:
                continue
            k = len(fit["values"])
            step = max(1, ENTRIES_AT_ONCE // (4 * k))
            for a in range(0, len(rows), step):
                some, own = x[a : a + step], rows[a : a + step]
                each = pa.array(np.repeat(np.arange(len(own)), k))
                columns = [
                    batch.column("id").take(pa.array(own)).take(each), pa.array(np.tile(np.arange(1, k + 1), len(own)), pa.int32()),
                    pa.array(np.full(len(each), fit["n"]), pa.int64()), deviations(some, fit).take(each), pa.array(projected(some, fit).reshape(-1)),
                    pa.array(np.tile(fit["shares"], len(own))), pa.array(np.full(len(each), fit["error"])),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(<id_col>, component, n, deviation, whitened, explained, identity_error): a row per usable row and component.

    Components are numbered from 1 by falling eigenvalue, up to ``components`` and to the rank of the scatter: a length whose
    vectors are all alike, and the empty vector, have none and give no rows. Rows whose vector is null or has null or
    non-finite entries are left out. Repeated rows count each. Entries beyond 2^35 in size count as that. ``deviation`` is
    exact, and null where 64 bits cannot hold it. ``identity_error`` is the largest entry of the whitened vectors'
    covariance less the identity. An empty table gives none.
    """
    vector = F.col(vector_col).cast("array<double>")
    rows = df.select(F.col(id_col).alias("id"), vector.alias("vector"))
    rows = rows.filter(F.col("vector").isNotNull() & F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))))
    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    vectors = rows.select("vector")
    sums = vectors.mapInArrow(column_sums, "length int, dim int, total long").groupBy("length", "dim").agg(F.sum(F.col("total").cast("decimal(19,0)")).alias("total"))
    sums = materialize(sums, "column-sums")
    out = None
    for block, n_blocks in _blocks(sums, components):
        own = sums.filter(F.pmod(F.xxhash64("length"), F.lit(n_blocks)) == block)
        found = _block(rows, vectors, own, components, schema, id_col)
        out = found if out is None else out.unionByName(found)
    return out


def _blocks(sums: DataFrame, components: int) -> Iterator[tuple[int, int]]:
    """(block, number of blocks), so that the fits of a block's lengths are bounded, or it has one length."""
    lengths = sums.filter("dim = 0").select("length", (F.col("length") * (components + 2)).cast("long").alias("numbers"))
    n_blocks = max(1, -(-(lengths.agg(F.sum("numbers")).first()[0] or 0) // MODEL_NUMBERS))
    while n_blocks > 1:
        most = lengths.groupBy(F.pmod(F.xxhash64("length"), F.lit(n_blocks)).alias("block")).agg(F.sum("numbers").alias("numbers"), F.count("*").alias("of"))
        if most.filter((F.col("numbers") > MODEL_NUMBERS) & (F.col("of") > 1)).isEmpty():
            break
        n_blocks += -(-n_blocks // 4)
    for block in range(n_blocks):
        yield block, n_blocks


def _block(rows: DataFrame, vectors: DataFrame, sums: DataFrame, components: int, schema: str, id_col: str) -> DataFrame:
    context = rows.sparkSession.sparkContext
    fits: dict[int, dict] = {}
    totals: dict[int, dict[int, int]] = defaultdict(dict)
    for x in sums.collect():  # bounded by ``_blocks``
        totals[x.length][x.dim] = int(x.total)
    for length, by_dim in totals.items():
        n, s = by_dim[-1], [by_dim[k] for k in range(length)]
        centre = [(2 * v + n) // (2 * n) for v in s]
        fits[length] = {"n": n, "centre": np.array(centre, np.int64), "rest": [v - n * c for v, c in zip(s, centre, strict=True)]}
    shared = context.broadcast(fits)
    products = vectors.mapInArrow(centred_products(shared), "length int, i int, j int, total double").groupBy("length", "i", "j").agg(F.sum("total").alias("total"))
    found = products.groupBy("length").applyInArrow(factored(shared, components), "length int, component int, value double, share double, vector array<double>")
    by_length: dict[int, list] = defaultdict(list)
    for x in found.collect():
        by_length[x.length].append((x.component, x.value, x.share, x.vector))
    solved = {}
    for length, parts in by_length.items():
        _, values, shares, axes = zip(*sorted(parts), strict=True)
        solved[length] = fits[length] | {"values": np.array(values), "shares": np.array(shares), "vectors": np.array(axes).T, "error": 0.0}
    shared = context.broadcast(solved)
    checked = vectors.mapInArrow(whitened_products(shared), "length int, i int, j int, total double").groupBy("length", "i", "j").agg(F.sum("total").alias("total"))
    means = {(x.length, x.i, x.j): x.total / solved[x.length]["n"] for x in checked.collect()}
    for (length, i, j), entry in means.items():
        if j >= 0:
            off = entry - means[length, i, -1] * means[length, j, -1] - (i == j)
            solved[length]["error"] = max(solved[length]["error"], abs(off))
    return rows.mapInArrow(whitened_rows(context.broadcast(solved), id_col), schema)
