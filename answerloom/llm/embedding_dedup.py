"""Near-duplicate embeddings by a PCA-ordered tiled comparison.

Only vectors of equal length are compared, and each length has axes and blocks of its own. Vectors
of one direction become one class with a count: equal ones, and those that are equal once divided by their largest component. The second moments of a length's classes give the principal axes, and vectors are rotated onto them, so that leading dimensions carry most of a product. Vectors are dealt into blocks along the first axis;
unit vectors whose cosine reaches the threshold lie no more than r apart on any axis, so a vector meets only the blocks
within r of it, each pair of blocks in one group. Where many classes share a place, their block is cut by hash. Within a group, tiles of products are accumulated from the leading
dimensions; what the remaining dimensions can add is at most the product of the remainders' norms, and a pair is given up
as soon as this cannot reach the threshold. Pairs that stay are decided by their cosine in double precision.

A group gives counts and one link per vector that spans its connected pairs, so that dense groups do not give pairs. A
block holds ``BLOCK_BYTES`` of vectors, and the work is that of the pairs of blocks which the first axis cannot part. Axes
only save work: beyond ``AXES_BYTES`` of them, the lengths with fewer bytes of vectors keep their plain coordinates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerloom.llm.arrowtext import mix64
from answerloom.llm.common import joined, matching
from answerloom.llm.components import components
from answerloom.storage import materialize

THRESHOLD = 0.95
BLOCK_BYTES = 4 << 20
AXES_BYTES = 128 << 20  # of all axes together, which every task receives
TILE_ROWS = 512
SLACK = 1e-4  # for products of leading dimensions in single precision


def usable(vector: Column) -> Column:
    """Without null or non-finite components, and not zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    whole = vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(finite(x), F.lit(False)))
    return F.coalesce(whole & F.exists(vector, lambda x: x != 0), F.lit(False))


def scaled_rows(column: pa.Array, dimension: int) -> np.ndarray:
    """A column of usable vectors, each divided by the size of its largest component."""
    x = np.asarray(pc.list_flatten(column).to_numpy(zero_copy_only=False), np.float64).reshape(-1, dimension)
    return x / np.abs(x).max(axis=1, keepdims=True)


def unit_rows(column: pa.Array, dimension: int) -> np.ndarray:
    """The unit vectors of a column of usable vectors."""
    x = scaled_rows(column, dimension)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def principal_axes(classes: DataFrame, dimension: int) -> np.ndarray:
    """The eigenvectors of the second moments of all vectors, the largest eigenvalue first, one per column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moments = np.zeros((dimension, dimension))
        for batch in batches:
            x = unit_rows(batch.column("vector"), dimension)
            moments += x.T @ x
        place = np.arange(dimension * dimension)
        yield pa.RecordBatch.from_arrays([pa.array(place // dimension), pa.array(place % dimension), pa.array(moments.reshape(-1))], names=["i", "j", "v"])

    found = classes.select("vector").mapInArrow(run, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    moments = np.zeros((dimension, dimension))
    moments[found.column("i").to_numpy(), found.column("j").to_numpy()] = found.column("v").to_numpy()
    values, vectors = np.linalg.eigh((moments + moments.T) / 2)
    return vectors[:, ::-1]


def by_length(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The rows of each vector length in each batch."""
    for batch in batches:
        length = pc.list_value_length(batch.column("vector"))
        lengths = pc.unique(length).to_pylist()
        for d in lengths:
            yield d, batch if len(lengths) == 1 else batch.filter(pc.equal(length, d))


def direction_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, times, class_id, length, h1, h2): 128 bits of the scaled vector, from which alone cosines are computed."""
    for d, batch in by_length(batches):
        bits = np.ascontiguousarray((scaled_rows(batch.column("vector"), d) + 0.0).T).view(np.uint64)
        hashes = []
        for seed in (0x1234567, 0x89ABCDE):
            state = np.full(batch.num_rows, seed, np.uint64)
            for component in bits:
                state = mix64(state + component)
            hashes.append(pa.array(state.view(np.int64)))
        columns = [batch.column(c) for c in ("key", "times", "class_id")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(np.full(batch.num_rows, d, np.int32)), *hashes], names=["key", "times", "class_id", "length", "h1", "h2"])


def axes_by_length(classes: DataFrame, sizes: dict[int, int]) -> dict[int, np.ndarray]:
    """Principal axes of the lengths with most bytes of vectors, as many as ``AXES_BYTES`` hold."""
    axes, held = {}, 0
    for d in sorted(sizes, key=lambda d: (-d * sizes[d], d)):
        held += d * d * 8
        if held > AXES_BYTES:
            break
        axes[d] = principal_axes(classes.filter(F.col("length") == d), d)
    return axes


def cut_points(dimension: int) -> list[int]:
    """After how many leading dimensions a pair is looked at."""
    return sorted({max(1, dimension // 4), max(1, dimension // 2), dimension})


def tile_links(a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of the rotated unit rows of a and b whose cosine reaches the threshold."""
    cuts = cut_points(a.shape[1])
    rest = [[np.sqrt(np.maximum(0, (x[:, c:] ** 2).sum(1))) for c in cuts] for x in (a, b)]
    c = cuts[0]
    product = a[:, :c].astype(np.float32) @ b[:, :c].astype(np.float32).T
    product += np.outer(rest[0][0], rest[1][0]).astype(np.float32)
    i, j = np.nonzero(product >= threshold - SLACK)
    if len(i) * 8 > product.size:  # a dense tile: all products at once
        i, j = np.nonzero(a @ b.T >= threshold - 1e-9)
    else:
        partial = np.zeros(len(i))
        for k, c in enumerate(cuts):
            begin = cuts[k - 1] if k else 0
            partial += np.einsum("ij,ij->i", a[i, begin:c], b[j, begin:c])
            open_ = partial + rest[0][k][i] * rest[1][k][j] >= threshold - 1e-9
            i, j, partial = i[open_], j[open_], partial[open_]
    return i, j


def united(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after uniting the sets of each a and b; a label is the least member's place."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        np.minimum.at(label, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (label[label] != label).any():
            label = label[label]


def compared(axes: dict[int, np.ndarray], threshold: float):
    def run(table: pa.Table) -> pa.Table:
        """(key, root, links) of one pair of blocks: a vector of the same connected set, and how many vectors are linked."""
        table = table.combine_chunks()
        left = table.column("left").to_numpy(zero_copy_only=False)
        table = table.take(pa.array(np.argsort(~left, kind="stable")))
        n_left = int(left.sum())
        key, times = table.column("key").to_numpy(), table.column("times").to_numpy()
        length = table.column("length")[0].as_py()
        plain = unit_rows(table.column("vector").combine_chunks(), length)
        x = plain @ axes[length] if length in axes else plain
        n = len(x)
        same = table.column("low")[0].as_py() == table.column("high")[0].as_py()  # a block is compared with itself
        links, label = np.zeros(n, np.int64), np.arange(n)
        for p in range(0, n_left, TILE_ROWS):
            for q in range(p if same else n_left, n, TILE_ROWS):
                a, b = slice(p, min(p + TILE_ROWS, n_left)), slice(q, q + TILE_ROWS)
                i, j = tile_links(x[a], x[b], threshold)
                i, j = i + p, j + q
                if same:
                    i, j = i[i < j], j[i < j]
                cosine = np.concatenate([np.einsum("ij,ij->i", plain[i[k : k + 65536]], plain[j[k : k + 65536]]) for k in range(0, len(i), 65536)] or [np.zeros(0)])
                i, j = i[cosine >= threshold], j[cosine >= threshold]
                np.add.at(links, i, times[j])
                np.add.at(links, j, times[i])
                label = united(label, i, j)
        some = np.flatnonzero(links)
        return pa.table({"key": key[some], "root": key[label[some]], "links": links[some]})

    return run


def blocks_by_length(classes: DataFrame, sizes: dict[int, int], first: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """(cuts, start) of each length of more than one block.

    The first axis is cut at ``cuts``; the part k of it has the blocks from ``start[k]`` up to ``start[k + 1]``, several where
    more classes share a place than a block holds.
    """
    blocks = {d: -(-n * d * 8 // BLOCK_BYTES) for d, n in sizes.items()}
    blocks = {d: k for d, k in blocks.items() if k > 1}
    if not blocks:
        return {}

    def on_first_axis(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for d, batch in by_length(batches):
            at = unit_rows(batch.column("vector"), d) @ first[d]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), d, np.int32)), pa.array(at)], names=["length", "at"])

    places = classes.filter(F.col("length").isin(list(blocks))).select("vector").mapInArrow(on_first_axis, "length int, at double")
    places = materialize(places, "places")
    most = max(blocks.values())
    grid = [k / most for k in range(1, most)]
    found = places.groupBy("length").agg(F.percentile_approx("at", grid, 8 * most).alias("at")).collect()
    cuts = {x.length: np.unique([x.at[k * most // blocks[x.length] - 1] for k in range(1, blocks[x.length])]) for x in found}

    def in_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, at = batch.column("length").to_numpy(), batch.column("at").to_numpy()
            for d in np.unique(length):
                rows = np.bincount(np.searchsorted(cuts[int(d)], at[length == d], "right"))
                part = np.flatnonzero(rows)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), d, np.int32)), pa.array(part), pa.array(rows[part])], names=["length", "part", "n"])

    counts = {d: np.zeros(len(c) + 1, np.int64) for d, c in cuts.items()}
    for x in places.mapInArrow(in_parts, "length int, part long, n long").groupBy("length", "part").agg(F.sum("n").alias("n")).collect():
        counts[x.length][x.part] = x.n
    own = {d: np.maximum(1, np.rint(n * d * 8 / BLOCK_BYTES)).astype(np.int64) for d, n in counts.items()}
    return {d: (cuts[d], np.concatenate([[0], np.cumsum(own[d])])) for d in cuts}


def linked_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """(<id_col>, n_links, component_id, kept): one row per input row.

    Vectors of equal length are compared by cosine in double precision. Vectors that are null or zero or that hold null or
    non-finite components link with nothing. Vectors of one direction are linked. ``component_id`` is the
    smallest id reachable over links, null ids coming last; rows that repeat an id count as vectors of their own.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    good = usable(F.col("vector"))
    classes = rows.filter(good).groupBy("vector").agg(F.count("*").alias("times"), F.min("id").alias("class_id"))
    classes = materialize(classes.select(F.xxhash64("vector").alias("key"), F.size("vector").alias("length"), "vector", "times", "class_id"), "classes")
    id_type = classes.schema["class_id"].dataType.simpleString()
    members = classes.select("key", "vector", "times", "class_id").mapInArrow(direction_rows, f"key long, times long, class_id {id_type}, length int, h1 long, h2 long")
    members = materialize(members, "directions")
    direction = ["length", "h1", "h2"]
    several = members.groupBy(direction).agg(F.min("key").alias("head"), F.sum("times").alias("all_times"), F.min("class_id").alias("least_id"), F.count("*").alias("of"))
    several = materialize(several.filter("of > 1").drop("of"), "several")
    n_several = several.count()
    heads, gone = members.drop(*direction), None
    if n_several:  # one class of each direction goes on
        members = matching(members, several, n_several, direction, "left").select(
            "key", F.coalesce("head", "key").alias("head"), F.coalesce("all_times", "times").alias("times"), F.coalesce("least_id", "class_id").alias("class_id")
        )
        members = materialize(members, "members")
        heads, gone = members.filter("key = head").drop("head"), members.filter("key != head").select("key", "head")
        more = several.select(F.col("head").alias("key"), "all_times")
        classes = matching(joined(classes, gone.select("key"), ["key"], "left_anti", "gone"), more, n_several, ["key"], "left")
        classes = materialize(classes.select("key", "length", "vector", F.coalesce("all_times", "times").alias("times")), "heads")
    sizes = {x.length: x.n for x in classes.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        none = F.lit(0).cast("long")
        return rows.select(F.col("id").alias(id_col), none.alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))

    axes = axes_by_length(classes, sizes)
    first = {d: np.ascontiguousarray(axes[d][:, 0]) if d in axes else np.eye(1, d)[0] for d in sizes}
    blocks = blocks_by_length(classes, sizes, first)
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-6

    def in_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for d, batch in by_length(batches):
            at = unit_rows(batch.column("vector"), d) @ first[d]
            cuts, start = blocks.get(d, (np.zeros(0), np.array([0, 1])))
            part = np.searchsorted(cuts, at, "right")
            own = start[part] + (batch.column("key").to_numpy().view(np.uint64) % (start[part + 1] - start[part]).astype(np.uint64)).astype(np.int64)
            begin, end = start[np.searchsorted(cuts, at - reach, "right")], start[np.searchsorted(cuts, at + reach, "right") + 1]
            copies = end - begin
            row = np.repeat(np.arange(len(at)), copies)
            other = np.arange(len(row)) - np.repeat(np.cumsum(copies) - copies, copies) + begin[row]
            step = max(1, (8 << 20) // (8 * d))
            for k in range(0, len(row), step):
                r, o = row[k : k + step], other[k : k + step]
                pair = [pa.array(np.minimum(own[r], o)), pa.array(np.maximum(own[r], o))]
                taken = batch.take(pa.array(r))
                yield pa.RecordBatch.from_arrays([*pair, pa.array(own[r] <= o), *taken.columns], names=["low", "high", "left", *taken.schema.names])

    vector_type = classes.schema["vector"].dataType.simpleString()
    groups = classes.select("key", "length", "times", "vector").mapInArrow(in_groups, f"low long, high long, left boolean, key long, length int, times long, vector {vector_type}")
    found = groups.groupBy("length", "low", "high").applyInArrow(compared(axes, threshold), "key long, root long, links long")
    found = materialize(found, "tile-links")
    counts = found.groupBy("key").agg(F.sum("links").alias("links"))
    parts = components(found.select(F.col("key").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "key")
    named = heads.select("key", "times", "class_id").join(counts, "key", "left").join(parts, "key", "left")
    named = materialize(named.withColumn("component", F.coalesce("component", "key")), "named")
    least = named.groupBy("component").agg(F.min("class_id").alias("component_id"))
    named = named.join(least, "component").select("key", (F.col("times") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    if gone is not None:
        of = matching(named, several.select(F.col("head").alias("key")), n_several, ["key"]).withColumnRenamed("key", "head")
        named = named.unionByName(matching(gone, of, n_several, ["head"], "inner").drop("head"))
    rows = rows.select("id", F.when(good, F.xxhash64("vector")).alias("key")).join(named, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return rows.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept")
    )
