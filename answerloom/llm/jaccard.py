"""Exact Jaccard join of word shingles in a metric space: pivots, their regions and triangle-inequality windows.

1. Equal sets become one class, by size and 128 bits of their shingle hashes; only classes are joined.
2. Candidates for a pivot. Documents that are no near copies lie at distance 1 from each other, so distances to a few
   pivots would tell nothing; there must be a pivot in every neighbourhood. With all sets ordered by hash, but shingles that
   are common in the corpus (passages, families of copies) last, linked pairs share k of their first
   size - ceil(percent * size / 100) + k shingles. Each of these that is not common is a cell, held by sets of neighbouring
   size classes, and a cell has one pivot. So both ends of every link come to one pivot, and what shares a common passage
   does not meet over it, however many texts have it. Two sets that meet only in cells of their own, and in fewer than k,
   are not linked.
   Sets whose first shingles reach the common ones also meet each other in cells of a second kind. For sets of some size,
   linked pairs differ in at most D shingles: with the shingles dealt by hash into D + 1 (and some spare) parts, a linked
   pair agrees wholly in one part at least. Sets that agree in a part share a cell.
3. Candidates are bounded before sets travel: by size, then by sketches, bitmaps of one to two bits a shingle. Common bits,
   and the fewer of the shingles that share a bit within a set, bound what two sets share from above. For what this
   leaves, mostly linked pairs, the distance to the pivot is computed exactly; of the rest a lower bound is known, which
   is as good for what follows.
4. All within the threshold t are linked with the pivot, so links among them add nothing to components. What is left of a
   region, the members beyond t, and those members within t that the triangle inequality allows to be linked to them
   (distances to the pivot no more than t apart), are first bounded among themselves by their sketches. Those that may have
   a partner fall into parts that sketches tell apart; parts of several regions that have members in common are one. The sets of a part are
   joined recursively, with pivots of their own, in one group (a set none of
   whose rarest shingles within the group is shared drops out first). Regions above ``SKETCHED_SHINGLES`` and parts above
   ``REGION_SHINGLES`` are dealt into blocks, each pair of which is a group.
5. Components of the links.

Crowded cells are reduced in the slice of rows where they arise (one member goes on, the others hang onto it), so a cell
that a third of all rows share costs a member per slice. Texts are not shuffled: after steps 1 and 2 sketches of the
candidates are, and the sets of those that sketches do not settle. Tables are deleted as soon as nothing reads them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerloom.llm.arrowtext import flat, gather, lower_ascii, mix64, pack, pieces, release, slices, steady, unpack, word_hashes, words
from answerloom.llm.common import joined, keep_rows, matching, row_key
from answerloom.llm.components import components
from answerloom.storage import BROADCAST_ROWS, discard, materialize

WIDTH = 4
LINK_PERCENT = 85  # 100 * intersection >= 85 * union
SLICE_BYTES = 2 << 20
BUCKET_BYTES = 32 << 20  # text whose cells one task reduces
REGION_SHINGLES = 1_000_000
SKETCHED_SHINGLES = 4_000_000  # of a block whose sketches one task compares
SLICE_MEMBERS = 16  # of a cell that a slice sends; of more it sends one, and the others hang onto that
FEW_MEMBERS = 64  # of a group that is compared at once
MET_OFTEN = 4  # cells that linked sets share at least, if they have as many shingles to share
COMMON_SETS = 16  # a shingle is common from so many sets on, of those that share it with another one of their slice
MOST_COMMON = 1_000_000  # shingles that are treated as common; of more, those of the most sets
HELD_CELLS = 1 << 20  # that a task gathers over its slices before it sends them
KEY_BITS = 1 << 26  # of the bitmap of wanted keys, at most
BITMAP_BITS = 32768  # fixed value: bits of one bitmap of Spark's
IDX_BITS = 16
CELL_BITS = 64 - IDX_BITS
RARE = np.uint64(1 << IDX_BITS)  # set in the cells of single shingles
SET_BYTES = 6  # of a shingle hash, where sets are compared
SKETCH_BITS = 6  # a sketch has 2^6 bits at least


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of one document after the other, how many each has).

    A document of fewer words than ``width`` has its whole sequence as one shingle, one without words none.
    """
    data = lower_ascii(data)
    starts, lengths, n = words(data, offsets)
    hashes = word_hashes(data, starts, lengths)
    first = np.cumsum(n) - n
    counts = np.where(n >= width, n - width + 1, (n > 0).astype(np.int64))
    begin = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    for size in range(1, width + 1):
        docs = np.flatnonzero(n == size if size < width else n >= width)
        at = gather(first[docs], counts[docs])
        value = np.full(len(at), size, np.uint64)
        for k in range(size):
            value = mix64(value + hashes[at + k])
        out[gather(begin[docs], counts[docs])] = value
    for b, c in zip(begin.tolist(), counts.tolist(), strict=True):
        out[b : b + c].sort()
    doc = np.repeat(np.arange(len(n)), counts)
    new = np.ones(len(out), bool)
    new[1:] = (out[1:] != out[:-1]) | (doc[1:] != doc[:-1])
    return out[new], np.bincount(doc[new], minlength=len(n))


def set_hashes(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits per set."""
    some = np.flatnonzero(counts)
    begin = (np.cumsum(counts) - counts)[some]
    out = np.zeros((2, len(counts)), np.uint64)
    for k, seed in enumerate((0x1234567, 0x89ABCDE)):
        if len(some):
            out[k, some] = np.add.reduceat(mix64(values ^ np.uint64(seed)), begin)
    return out[0].view(np.int64), out[1].view(np.int64)


def size_classes(most: int, percent: int = LINK_PERCENT) -> list[int]:
    """Lower bounds of size classes: sets that may be linked are of one class or of neighbouring ones."""
    bounds = [1]
    while bounds[-1] <= most:
        bounds.append(100 * bounds[-1] // percent + 1)
    return bounds + [100 * bounds[-1] // percent + 1, 100 * (100 * bounds[-1] // percent + 1) // percent + 1]


def parts_and_spare(bounds: list[int], level: int, percent: int = LINK_PERCENT) -> tuple[int, int]:
    """Into how many parts a level deals its sets, and how many of them may be empty without harm.

    A pair of sizes adding up to S shares at least percent * S / (100 + percent) shingles, so it differs in at most
    (100 - percent) * S / (100 + percent). Of D + 1 + spare parts it agrees in spare + 1 at least; unless both sets have
    more empty parts than spare, one of these is not empty.
    """
    most = bounds[level + 1] - 1 + bounds[level + 2] - 1
    differ = (100 - percent) * most // (100 + percent)
    spare = 2 + -(-differ * 3 // 200) if differ else 0
    return differ + 1 + spare, spare


def cells(values: np.ndarray, counts: np.ndarray, percent: int = LINK_PERCENT) -> np.ndarray:
    """The cells of the sets, sorted: each a number of CELL_BITS bits above the set's index of IDX_BITS bits."""
    if not len(values):
        return np.zeros(0, np.uint64)
    bounds = size_classes(int(counts.max()), percent)
    own = np.searchsorted(bounds, counts, "right") - 1
    begin = np.cumsum(counts) - counts
    out = []
    for level in range(int(own.max()) + 1):
        docs = np.flatnonzero((counts > 0) & ((own == level) | (own == level + 1)))
        if not len(docs):
            continue
        n_parts, spare = parts_and_spare(bounds, level, percent)
        v = values[gather(begin[docs], counts[docs])]
        # Parts follow the order of the hashes, so that each is a run.
        part = ((v >> np.uint64(32)) * np.uint64(n_parts)) >> np.uint64(32)
        place = np.repeat(np.arange(len(docs), dtype=np.uint64), counts[docs]) * np.uint64(n_parts) + part
        run = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        content = np.add.reduceat(mix64(v + np.uint64(level)), run)
        place = place[run]
        filled = np.bincount((place // np.uint64(n_parts)).astype(np.int64), minlength=len(docs))
        sparse = np.flatnonzero(n_parts - filled > spare)
        if len(sparse):  # these must also meet in empty parts
            every = (sparse[:, None] * n_parts + np.arange(n_parts)).reshape(-1).astype(np.uint64)
            empty = np.setdiff1d(every, place)
            place, content = np.concatenate([place, empty]), np.concatenate([content, np.zeros(len(empty), np.uint64)])
        which, part = place // np.uint64(n_parts), place % np.uint64(n_parts)
        cell = mix64(content ^ mix64(part * np.uint64(1 << 20) + np.uint64(level)))
        out.append((cell >> np.uint64(IDX_BITS) << np.uint64(IDX_BITS)) | docs[which.astype(np.int64)].astype(np.uint64))
    packed = np.concatenate(out)
    packed.sort()
    return packed


def first_of_equal(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether each set is the first of its kind, and not empty."""
    a, b = set_hashes(values, counts)
    _, first = np.unique(np.stack([a, b, counts.astype(np.int64)], 1), axis=0, return_index=True)
    out = np.zeros(len(counts), bool)
    out[first] = True
    return out & (counts > 0)


def as_bytes(values: np.ndarray) -> np.ndarray:
    """The SET_BYTES high bytes of each hash; order is kept."""
    return np.ascontiguousarray(values.byteswap().view(np.uint8).reshape(-1, 8)[:, :SET_BYTES]).reshape(-1)


def from_bytes(data: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(data) // SET_BYTES, 8), np.uint8)
    wide[:, :SET_BYTES] = data.reshape(-1, SET_BYTES)
    return wide.reshape(-1).view(">u8").astype(np.uint64)


def leader(cell: np.ndarray, member: np.ndarray, key: np.ndarray) -> np.ndarray:
    """The pivot of each cell: the member that meets most others over all cells here, of these the one of least key.

    In a family of copies that is a middle one, common to most of its cells, so that few pivots serve the family.
    """
    met = np.bincount(cell)[cell] - 1
    popular = np.bincount(member, met, len(key))
    rank = np.empty(len(key), np.int64)
    order = np.lexsort((key, -popular))
    rank[order] = np.arange(len(key))
    best = np.full(int(cell.max()) + 1, len(key))
    np.minimum.at(best, cell, rank[member])
    return order[best]


def least_met(counts: np.ndarray, percent: int) -> np.ndarray:
    """How many of its first shingles a set shares at least with one that it is linked with, the lesser number of both."""
    return np.minimum(-(-percent * counts // 100), MET_OFTEN)


def rare_cells(values: np.ndarray, counts: np.ndarray, common: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(cells of the first shingles of each set that are not ``common``, like those of ``cells``, unsorted; the sets that have too few)."""
    place = np.searchsorted(common, values)
    rare = np.append(common, np.uint64(0))[place] != values if len(common) else np.ones(len(values), bool)
    rare |= place == len(common)
    of = np.repeat(np.arange(len(counts)), counts)
    have = np.bincount(of[rare], minlength=len(counts))
    need = np.where(counts > 0, counts - -(-percent * counts // 100) + least_met(counts, percent), 0)
    head = rare & ((np.cumsum(rare) - 1 - np.repeat(np.cumsum(have) - have, counts)) < need[of])
    return mix64(values[head]) >> np.uint64(IDX_BITS) << np.uint64(IDX_BITS) | RARE | of[head].astype(np.uint64), have < need


def uncrowded(packed: np.ndarray, n_sets: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted cells of a slice with one member for each crowded one, and (member, that one) of the others."""
    if not len(packed):
        return packed, np.zeros((0, 2), np.int64)
    cell, idx = packed >> np.uint64(IDX_BITS), (packed & np.uint64((1 << IDX_BITS) - 1)).astype(np.int64)
    new = np.concatenate([[True], cell[1:] != cell[:-1]])
    run = np.cumsum(new) - 1
    own = leader(run, idx, np.arange(n_sets))[run]
    crowded = np.bincount(run)[run] > SLICE_MEMBERS
    pairs = np.unique((idx << 32 | own)[crowded & (idx != own)])
    return packed[~crowded | (idx == own)], np.stack([pairs >> 32, pairs & 0xFFFFFFFF], 1)


def bucket_rows(n_buckets: int, packed: np.ndarray, keys: np.ndarray, levels: np.ndarray, pairs: np.ndarray) -> pa.RecordBatch:
    """For each bucket its cells, and the keys and levels of the sets that have them; a row more for ``pairs`` of keys.

    A level is a size class above eight bits of ``least_met``.
    """
    packed.sort()
    bucket = (packed >> np.uint64(IDX_BITS) >> np.uint64(CELL_BITS - 32)) * np.uint64(n_buckets) >> np.uint64(32)
    edges = np.searchsorted(bucket, np.arange(n_buckets + 1, dtype=np.uint64))
    rows = []
    for b in np.flatnonzero(np.diff(edges)).tolist():
        own = packed[edges[b] : edges[b + 1]]
        used, idx = np.unique((own & np.uint64((1 << IDX_BITS) - 1)).astype(np.int64), return_inverse=True)
        own = own >> np.uint64(IDX_BITS) << np.uint64(IDX_BITS) | idx.astype(np.uint64)
        rows.append((b, pack(own, True), pack(keys[used]), pack(levels[used])))
    if len(pairs):
        rows.append((int(pairs[0, 0]) % n_buckets, None, pack(pairs.reshape(-1)), None))
    columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int32(), pa.binary(), pa.binary(), pa.binary()))]
    return pa.RecordBatch.from_arrays(columns, names=["bucket", "cells", "keys", "levels"])


def cell_rows(n_buckets: int, percent: int, width: int, common: np.ndarray | None = None):
    """Per some slices of (row_key, text): their cells for each bucket, and which sets share a cell within a slice.

    ``common`` are sorted hashes of shingles; whatever they are, all linked sets meet. Without them there are only cells of the second kind.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        n_sets = n_cells = 0
        for part in pieces(batches, "text", SLICE_BYTES):
            keys = np.array(part.column("row_key").to_numpy())
            values, counts = shingle_sets(*flat(part.column("text")), width)
            use = first_of_equal(values, counts)
            if not use.any():
                continue
            values, counts = values[np.repeat(use, counts)], np.where(use, counts, 0)
            packed, sparse = (np.zeros(0, np.uint64), counts > 0) if common is None else rare_cells(values, counts, common, percent)
            whole = cells(values[np.repeat(sparse, counts)], np.where(sparse, counts, 0), percent) & ~RARE
            whole.sort()
            whole, pairs = uncrowded(whole, len(keys))
            levels = np.searchsorted(size_classes(int(counts.max()), percent), counts, "right") << 8 | least_met(counts, percent)
            levels = levels.astype(np.uint32)
            if held and (n_sets + len(keys) > 1 << IDX_BITS or n_cells > HELD_CELLS):
                yield bucket_rows(n_buckets, *map(np.concatenate, zip(*held, strict=True)))
                held, n_sets, n_cells = [], 0, 0
            packed = np.concatenate([packed, whole])
            held.append((packed + np.uint64(n_sets), keys, levels, keys[pairs]))
            n_sets, n_cells = n_sets + len(keys), n_cells + len(packed)
        if held:
            yield bucket_rows(n_buckets, *map(np.concatenate, zip(*held, strict=True)))

    return run


def pivot_rows(table: pa.Table) -> pa.Table:
    """(x, pivot, local, alone, met, least) of one bucket: the sets of each cell that several have, with its pivot.

    Sets that share a shingle meet in the cell of it and their size class, and in that of it and the class below. ``alone``
    are two that no third one joins in any cell they share here: they share ``met`` shingles and are linked only if they share
    ``least`` over all buckets.
    """
    steady()
    rows = list(zip(*(table.column(c).to_pylist() for c in ("cells", "keys", "levels")), strict=True))
    local = np.concatenate([np.zeros((0, 2), np.int64), *[unpack(k, np.int64).reshape(-1, 2) for c, k, _ in rows if c is None]])
    sent = [(unpack(c, np.uint64, True), unpack(k, np.int64), unpack(v, np.uint32)) for c, k, v in rows if c is not None]
    ordered = np.concatenate([np.zeros(0, np.uint64), *[packed >> np.uint64(IDX_BITS) for packed, _, _ in sent]])
    ordered.sort()
    shared = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    del ordered
    at, key, level = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for packed, keys, levels in sent if len(shared) else ():
        cell = packed >> np.uint64(IDX_BITS)
        place = np.minimum(np.searchsorted(shared, cell), len(shared) - 1)
        hit = shared[place] == cell
        idx = (packed[hit] & np.uint64((1 << IDX_BITS) - 1)).astype(np.int64)
        at.append(place[hit])
        key.append(keys[idx])
        level.append(levels[idx].astype(np.int64))
    at, key, level = np.concatenate(at), np.concatenate(key), np.concatenate(level)
    least = level & 255
    rare = (shared[at] & np.uint64(1)).astype(bool)
    at = np.concatenate([at << 32 | np.where(rare, level >> 8, 0), (at << 32 | (level >> 8) - 1)[rare]])
    key, least = np.concatenate([key, key[rare]]), np.concatenate([least, least[rare]])
    order = np.argsort(at, kind="stable")
    at, key, least = at[order], key[order], least[order]
    _, run, often = np.unique(at, return_inverse=True, return_counts=True)
    many = (often[run] > 2) | (shared[at >> 32] & np.uint64(1) == 0)  # others may hang onto the members of cells without a shingle
    first = np.flatnonzero(~many & (often[run] == 2))[::2]
    two = np.stack([np.maximum(key[first], key[first + 1]), np.minimum(key[first], key[first + 1]), at[first] >> 32, np.minimum(least[first], least[first + 1])], 1)
    two = np.unique(two[two[:, 0] != two[:, 1]], axis=0)
    two, met = np.unique(two[:, [0, 1, 3]], axis=0, return_counts=True)
    _, at = np.unique(run[many], return_inverse=True)
    key = key[many]
    pairs = np.zeros((0, 2), np.int64)
    if len(key):
        names, member = np.unique(key, return_inverse=True)
        pivot = names[leader(at, member, names)]
        pairs = np.unique(np.stack([key, pivot[at]], 1)[key != pivot[at]], axis=0)
    n = len(pairs) + len(local)
    x, p = (np.concatenate([pairs[:, k], local[:, k], two[:, k]]) for k in (0, 1))
    kind = np.repeat([0, 1, 2], [len(pairs), len(local), len(two)])
    met, least = np.concatenate([np.zeros(n, np.int64), met]), np.concatenate([np.zeros(n, np.int64), two[:, 2]])
    return pa.table({"x": x, "pivot": p, "local": kind == 1, "alone": kind == 2, "met": met, "least": least})


def shared_count(a: np.ndarray, b: np.ndarray) -> int:
    """The size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def sketches(values: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """A bitmap for each set of sorted hashes, by their leading bits: as many bits as it has hashes, up to a power of two."""
    out = []
    for end, n in zip(np.cumsum(counts).tolist(), counts.tolist(), strict=True):
        level = max(SKETCH_BITS, (n - 1).bit_length())
        bits = np.zeros(1 << level, np.uint8)
        bits[(values[end - n : end] >> np.uint64(64 - level)).astype(np.int64)] = 1
        out.append(np.packbits(bits).tobytes())
    return out


def folded(sketch: bytes, n_bytes: int) -> np.ndarray:
    """A sketch as one of fewer bits, as 64-bit words."""
    bits = np.frombuffer(sketch, np.uint8)
    if len(bits) > n_bytes:
        bits = np.packbits(np.unpackbits(bits).reshape(8 * n_bytes, -1).any(1))
    return bits.view(np.uint64)


def most_shared(sketch: np.ndarray, others: np.ndarray, n: int, n_others: np.ndarray) -> np.ndarray:
    """Upper bounds of what a set shares with others, from sketches of one size.

    Sets share at most one shingle for each common bit, and besides only shingles beyond the first of a bit in both.
    """
    common = np.bitwise_count(others & sketch).sum(1, dtype=np.int64)
    beyond = n - int(np.bitwise_count(sketch).sum())
    beyond_others = n_others - np.bitwise_count(others).sum(1, dtype=np.int64)
    return np.minimum(common + np.minimum(beyond, beyond_others), np.minimum(n, n_others))


def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(x, pivot, n_x, n_pivot, most) from rows that hold both sketches."""
    for batch in batches:
        n_x, n_pivot = (batch.column(c).to_numpy() for c in ("n_x", "n_pivot"))
        most = []
        for a, b, i, j in zip(batch.column("x_sketch"), batch.column("pivot_sketch"), n_x.tolist(), n_pivot, strict=True):
            a, b = a.as_py(), b.as_py()
            size = min(len(a), len(b))
            most.append(int(most_shared(folded(a, size), folded(b, size)[None], i, np.array([j]))[0]))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("x", "pivot", "n_x", "n_pivot")), pa.array(most, pa.int64())], names=["x", "pivot", "n_x", "n_pivot", "most"])
    release()


def parts(keys, label, n, distance, beyond, block, sent, percent: int) -> np.ndarray:
    """The part of each member of a group: what may be linked is of one part."""
    size = min(map(len, sent))
    bits = np.stack([folded(s, size) for s in sent])
    t = 1 - percent / 100 + 1e-9
    part = np.arange(len(keys))
    few = len(keys) <= FEW_MEMBERS
    if few:
        common = np.bitwise_count(bits[:, None] & bits[None]).sum(2, dtype=np.int64)
        more = n - np.diagonal(common)
        most = np.minimum(common + np.minimum.outer(more, more), np.minimum.outer(n, n))
        open_ = beyond[:, None] & (beyond | (distance[:, None] - distance <= t)) & (label[:, None] != label)
        may = open_ & ((block == block[0]).all() | (block[:, None] != block)) & (100 * most >= percent * (np.add.outer(n, n) - most))
    else:
        one = bool((block == block[0]).all())
    for y in np.flatnonzero(may.any(1) if few else beyond):
        if few:
            others = np.flatnonzero(may[y])
        else:
            others = np.flatnonzero((beyond | (distance[y] - distance <= t)) & (label != label[y]) & (one | (block != block[y])))
            most = most_shared(bits[y], bits[others], int(n[y]), n[others])
            others = others[100 * most >= percent * (n[others] + n[y] - most)]
        same = np.unique(part[np.append(others, y)])
        if len(same) > 1:
            part[np.isin(part, same)] = same[0]
    return part


def possible(percent: int):
    def run(table: pa.Table) -> pa.Table:
        """(h1, h2, x, n) of the members of groups that may have a partner in theirs, by the parts they may connect to.

        Rows are (group, x, label, n, distance, linked, block, sketch); two blocks are compared with one another, one with itself,
        and what has one label is connected already. A part is named by 128 bits of its members, so that what meets in several
        regions is one part.
        """
        steady()
        table = table.combine_chunks()
        group, key = (table.column(c).to_numpy() for c in ("group", "x"))
        order = np.lexsort((key, group))
        new = np.concatenate([[True], (group[order][1:] != group[order][:-1]) | (key[order][1:] != key[order][:-1])])
        table = table.take(pa.array(order[new]))
        group, key, label, n, distance, block = (table.column(c).to_numpy() for c in ("group", "x", "label", "n", "distance", "block"))
        beyond = ~table.column("linked").to_numpy(zero_copy_only=False)
        sent = table.column("sketch").to_pylist()
        out = []
        edges = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]]))
        for at in map(slice, edges[:-1].tolist(), edges[1:].tolist()):
            keys = key[at]
            _, part, often = np.unique(parts(keys, label[at], n[at], distance[at], beyond[at], block[at], sent[at], percent), return_inverse=True, return_counts=True)
            own = np.flatnonzero(often[part] > 1)
            if not len(own):
                continue
            names = []
            for seed in (0x5EED, 0xBEEF):
                sums = np.zeros(len(often), np.uint64)
                np.add.at(sums, part, mix64(keys.view(np.uint64) ^ np.uint64(seed)))
                names.append(sums[part[own]].view(np.int64))
            out.append(np.stack([*names, keys[own], n[at][own]]))
        h1, h2, x, n = np.concatenate([np.zeros((4, 0), np.int64), *out], 1)
        return pa.table({"h1": h1, "h2": h2, "x": x, "n": n})

    return run


def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(x, pivot, n_x, n_pivot, shared) from rows that hold both sets."""
    for batch in (part for whole in batches for part in slices(whole, "x_set", SLICE_BYTES)):
        a, b = (flat(batch.column(c)) for c in ("x_set", "pivot_set"))
        sizes = [np.diff(offsets) // SET_BYTES for _, offsets in (a, b)]
        sets = [(from_bytes(data), offsets // SET_BYTES) for data, offsets in (a, b)]
        shared = [
            shared_count(*(values[offsets[i] : offsets[i + 1]] for values, offsets in sets)) for i in range(batch.num_rows)
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("x"), batch.column("pivot"), pa.array(sizes[0]), pa.array(sizes[1]), pa.array(shared, pa.int64())],
            names=["x", "pivot", "n_x", "n_pivot", "shared"],
        )
    release()


def may_link(values: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """Which sets of a group may be linked with another one of it.

    With all sets ordered from the group's rarest shingle to its commonest, linked sets share a shingle among their first
    size - ceil(percent * size / 100) + 1.
    """
    _, value, often = np.unique(values, return_inverse=True, return_counts=True)
    of = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((value, often[value], of))
    value, of = value[order], of[order]
    place = np.arange(len(value)) - np.repeat(np.cumsum(counts) - counts, counts)
    head = place < (counts - -(-percent * counts // 100) + 1)[of]
    value, of = value[head], of[head]
    met = np.bincount(value, minlength=len(often))[value] > 1
    out = np.zeros(len(counts), bool)
    out[of[met]] = True
    return out


class Region:
    """Sets of one group and a way to count what one shares with all."""

    def __init__(self, values: np.ndarray, counts: np.ndarray, percent: int):
        self.counts, self.percent = counts, percent
        self.begin = np.cumsum(counts) - counts
        _, self.values = np.unique(values, return_inverse=True)
        order = np.argsort(self.values, kind="stable")
        self.owner = np.repeat(np.arange(len(counts)), counts)[order]
        self.posting = np.searchsorted(self.values[order], np.arange(self.values.max() + 2 if len(values) else 1))

    def shared(self, i: int) -> np.ndarray:
        v = self.values[self.begin[i] : self.begin[i] + self.counts[i]]
        at = gather(self.posting[v], self.posting[v + 1] - self.posting[v])
        return np.bincount(self.owner[at], minlength=len(self.counts))

    def linked(self, i: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the others are linked with i, and their distances to it."""
        shared = self.shared(i)[others]
        union = self.counts[i] + self.counts[others] - shared
        return 100 * shared >= self.percent * union, 1 - shared / union

    def join(self, members: np.ndarray, links: list[tuple[int, int]]) -> None:
        """Links that connect all linked members: a pivot and its ball, then the ball's border with the rest, then the rest."""
        t = 1 - self.percent / 100 + 1e-9
        while len(members) > 1:
            pivot, others = members[0], members[1:]
            linked, distance = self.linked(pivot, others)
            links.extend((int(pivot), int(x)) for x in others[linked])
            ball, at = others[linked], distance[linked]
            near = ~linked & (distance <= 2 * t)
            for y, d in zip(others[near], distance[near], strict=True):
                window = ball[at >= d - t]
                if len(window):
                    hit, _ = self.linked(y, window)
                    if hit.any():
                        links.append((int(y), int(window[hit.argmax()])))
            members = others[~linked]


def joined_region(percent: int):
    def run(table: pa.Table) -> pa.Table:
        """(a, b) links that connect all linked members of one group of (x, set)."""
        steady()
        table = table.combine_chunks()
        keys = table.column("x").to_numpy()
        _, first = np.unique(keys, return_index=True)
        table, keys = table.take(pa.array(first)), keys[first]
        data, offsets = flat(table.column("set"))
        values, counts = from_bytes(data), np.diff(offsets) // SET_BYTES
        open_ = may_link(values, counts, percent)
        region = Region(values[np.repeat(open_, counts)], counts[open_], percent)
        keys = keys[open_]
        links: list[tuple[int, int]] = []
        region.join(np.arange(len(keys)), links)
        ends = np.array(links, np.int64).reshape(-1, 2)
        return pa.table({"a": keys[ends[:, 0]], "b": keys[ends[:, 1]]})

    return run


def set_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(row_key, set) of each row: the high bytes of its sorted shingle hashes."""
        for part in pieces(batches, "text", SLICE_BYTES):
            values, counts = shingle_sets(*flat(part.column("text")), width)
            data = as_bytes(values)
            ends = np.concatenate([[0], np.cumsum(counts)]) * SET_BYTES
            sets = pa.array([data[a:b].tobytes() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("row_key"), sets], names=["row_key", "set"])

    return run


def sketch_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "text", SLICE_BYTES):
            sent = sketches(*shingle_sets(*flat(part.column("text")), width))
            yield pa.RecordBatch.from_arrays([part.column("row_key"), pa.array(sent, pa.binary())], names=["row_key", "sketch"])

    return run


def size_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(id, row_key, n, h1, h2) of each row; the first of a slice has the shingles that several sets of the slice share."""
        for part in pieces(batches, "text", SLICE_BYTES):
            values, counts = shingle_sets(*flat(part.column("text")), width)
            a, b = set_hashes(values, counts)
            once = values[np.repeat(first_of_equal(values, counts), counts)]
            once.sort()
            again = np.flatnonzero(once[1:] == once[:-1])
            repeated, often = np.unique(once[again], return_counts=True)
            seen = [pack(np.stack([repeated.view(np.int64), often + 1], 1).reshape(-1))] + [None] * (len(counts) - 1)
            columns = [part.column("id"), part.column("row_key"), pa.array(counts, pa.int64()), pa.array(a), pa.array(b), pa.array(seen, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "row_key", "n", "h1", "h2", "seen"])

    return run


def seen_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shingle, often) of what several sets of a slice share."""
    for batch in batches:
        for seen in batch.column("seen").to_pylist():
            both = unpack(seen, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["shingle", "often"])


def common_shingles(sizes: DataFrame) -> np.ndarray:
    """The sorted hashes of shingles that many sets have, from the rows of ``size_rows``.

    Only what slices see several times is counted, which finds whatever some multiple of the root of the number of slices has.
    """
    often = sizes.filter("seen IS NOT NULL").select("seen").mapInArrow(seen_rows, "shingle long, often long")
    often = materialize(often.groupBy("shingle").agg(F.sum("often").alias("often")).filter(F.col("often") >= COMMON_SETS), "common")
    least = COMMON_SETS
    while often.filter(F.col("often") >= least).count() > MOST_COMMON:
        least *= 2
    found = often.filter(F.col("often") >= least).select("shingle").toArrow().column(0).to_numpy().view(np.uint64)
    discard(often)
    return np.sort(found)


def jaccard_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = LINK_PERCENT, width: int = WIDTH, rare: bool = False) -> DataFrame:
    """(row_key, <id_col>, n_shingles, component_id, component): one row per input row; ``component`` is a label.

    Two rows are linked when 100 * shared >= ``percent`` * union of their sets of shingles of ``width`` words. ``component_id`` is the smallest id
    that a row reaches over links, its own included; null ids come after all others. Null texts count as empty, and a row
    without words is linked with nothing. Repeated rows have equal sets and so one component. An empty table gives none.
    ``rare`` lets sets meet over rare shingles, which parts texts that share passages; the result is the same.
    """
    texts = df.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("row_key"), F.col(text_col).alias("text"))
    id_type = texts.schema["id"].dataType.simpleString()
    sizes = texts.mapInArrow(size_rows(width), f"id {id_type}, row_key long, n long, h1 long, h2 long, seen binary")
    sizes = materialize(sizes, "set-sizes")
    common = common_shingles(sizes) if rare else None
    kinds = ["n", "h1", "h2"]
    classes = sizes.filter("n > 0").groupBy(kinds).agg(F.min("row_key").alias("class"), F.min("id").alias("class_id"), F.count("*").alias("of"))
    several = classes.filter("of > 1").select(*kinds, "class", "class_id")
    members = joined(sizes, several, kinds, "left", "several").select("id", "row_key", "n", F.coalesce("class", "row_key").alias("class"), F.coalesce("class_id", "id").alias("class_id"))
    members = materialize(members, "classes")
    discard(sizes)

    total = df.agg(F.sum(F.octet_length(text_col)).alias("n")).first().n or 0
    n_buckets = max(1, -(-total // BUCKET_BYTES))
    found = texts.select("row_key", "text").mapInArrow(cell_rows(n_buckets, percent, width, common), "bucket int, cells binary, keys binary, levels binary")
    found = found.groupBy("bucket").applyInArrow(pivot_rows, "x long, pivot long, local boolean, alone boolean, met long, least long")
    found = found.groupBy("x", "pivot", "local").agg(F.bool_and("alone").alias("alone"), F.sum("met").alias("met"), F.min("least").alias("least"))
    found = found.filter("NOT alone OR met >= least").select("x", "pivot", "local", "alone")
    of = members.filter("n > 0").select("row_key", "class", "n").distinct()
    found = found.join(of.toDF("x", "cx", "n_x"), "x").join(of.toDF("pivot", "cp", "n_pivot"), "pivot").select(F.col("cx").alias("x"), F.col("cp").alias("pivot"), "n_x", "n_pivot", "local", "alone")
    columns = ["x", "pivot", "n_x", "n_pivot"]
    found = materialize(found.filter("x != pivot").groupBy(*columns, "local").agg(F.bool_and("alone").alias("alone")), "pivots")
    # What hangs onto a set within its slice also comes to that set's pivots.
    onward = found.filter("local").select("x", "n_x", F.col("pivot").alias("via"))
    onward = onward.join(found.filter("not local").select(F.col("x").alias("via"), "pivot", "n_pivot"), "via")
    pairs = found.select(*columns, "alone").union(onward.select(*columns, F.lit(False))).filter("x != pivot")
    candidates = materialize(pairs.groupBy(*columns).agg(F.bool_and("alone").alias("alone")), "candidates")
    discard(found)
    regions, pairs = candidates.filter("NOT alone").select("x", "pivot"), candidates.select(*columns)

    # Bounds first, so that no set is sent for a pair that its sizes or sketches tell apart.
    smaller, larger = F.least("n_x", "n_pivot"), F.greatest("n_x", "n_pivot")
    near = 100 * smaller >= percent * larger
    drawn = _of_texts(texts, _ends(pairs), sketch_rows(width), "row_key long, sketch binary", "sketches")
    both = pairs.filter(near).join(drawn.toDF("x", "x_sketch"), "x").join(drawn.toDF("pivot", "pivot_sketch"), "pivot")
    bounds = both.mapInArrow(bounded, "x long, pivot long, n_x long, n_pivot long, most long")
    bounds = materialize(bounds.unionByName(pairs.filter(~near).withColumn("most", smaller)), "bounds")
    open_ = 100 * F.col("most") >= percent * (F.col("n_x") + F.col("n_pivot") - F.col("most"))
    left = materialize(bounds.filter(open_), "open-pairs")
    # Each set's least pivot first. A pair that one pivot, linked with both, connects already needs no sets.
    first = materialize(left.join(left.groupBy("x").agg(F.min("pivot").alias("pivot")), ["x", "pivot"], "left_semi"), "first-pairs")
    done = _exact(texts, first, percent, width)
    label = done.filter("linked").select(F.col("x").alias("node"), F.col("pivot").alias("label"))
    second = left.join(first.select("x", "pivot"), ["x", "pivot"], "left_anti")
    second = joined(second, label.toDF("x", "x_label"), ["x"], "left", "labels").join(label.toDF("pivot", "pivot_label"), "pivot", "left")
    connected = F.coalesce("x_label", "x") == F.coalesce("pivot_label", "pivot")
    second = materialize(second.withColumn("connected", connected), "second-pairs")
    more = _exact(texts, second.filter("NOT connected").drop("connected", "x_label", "pivot_label"), percent, width)
    columns = ["x", "pivot", "n_x", "linked", "distance"]
    t = 1 - percent / 100
    through = second.filter("connected").withColumns({"linked": F.lit(True), "distance": F.lit(2 * t)})  # at most, over their pivot
    union = F.col("n_x") + F.col("n_pivot") - F.col("most")
    rest = bounds.filter(~open_).withColumns({"linked": F.lit(False), "distance": 1 - F.col("most") / union})  # at least
    distances = done.select(*columns).unionByName(more.select(*columns)).unionByName(through.select(*columns)).unionByName(rest.select(*columns))
    distances = materialize(distances.join(regions, ["x", "pivot"], "left_semi"), "distances")  # a third set may be linked with x
    links = done.union(more).filter("linked").select(F.col("x").alias("a"), F.col("pivot").alias("b"))
    links = materialize(links, "pivot-links")
    discard(candidates, bounds, left, first, done, second, more)

    links = links.union(_region_links(distances, links, texts, drawn, percent, width))
    found = components(links)
    ids = members.select(F.col("class").alias("node"), "class_id").distinct()
    named = found.join(ids, "node").groupBy("component").agg(F.min("class_id").alias("component_id"))
    named = found.join(named, "component").select(F.col("node").alias("class"), "component", "component_id")
    own_id = F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("id"))
    return members.join(named, "class", "left").select(
        "row_key", F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", own_id).alias("component_id"),
        F.coalesce("component", "class").alias("component"),
    )


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = LINK_PERCENT, width: int = WIDTH) -> DataFrame:
    """The rows of ``df`` with one row of each component, the one of the smallest id; all columns unchanged.

    Rows without words are linked with nothing and all stay.
    """
    found = jaccard_components(df, id_col, text_col, percent, width, rare=True).filter("n_shingles > 0").select("row_key", F.col(id_col).alias("id"), "component")
    found = materialize(found, "components")
    best = found.groupBy("component").agg(F.min(F.struct(F.col("id").isNull(), "id", "row_key")).alias("best"), F.count("*").alias("of"))
    several = joined(found, best.filter("of > 1"), ["component"], "inner", "best").select("row_key", (F.col("row_key") == F.col("best.row_key")).alias("stays"))
    several = materialize(several.groupBy("row_key", "stays").agg(F.count("*").alias("n")), "near-duplicates")
    return keep_rows(df, id_col, text_col, several.filter("not stays"), several.filter("stays and n > 1"), several.count())


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("x", "pivot")).alias("row_key")).distinct()


def _of_texts(texts: DataFrame, wanted: DataFrame, function, schema: str, name: str) -> DataFrame:
    """What ``function`` makes of the wanted rows' texts, written to the shared folder."""
    wanted = materialize(wanted, "wanted")
    texts = texts.select("row_key", "text")
    if (n := wanted.count()) <= BROADCAST_ROWS:
        rows = matching(texts, wanted, n, ["row_key"]).mapInArrow(function, schema)
    else:
        rows = texts.mapInArrow(among(_bitmap(wanted, n), function), schema).join(wanted, "row_key", "left_semi")
    rows = materialize(rows.dropDuplicates(["row_key"]), name)
    discard(wanted)
    return rows


def among(bitmap: np.ndarray, function):
    """``function`` over the rows whose key may be wanted: the bit of its place among all bits is set."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column("row_key").to_numpy() & (8 * len(bitmap) - 1)
            some = np.flatnonzero(bitmap[place >> 3] >> (place & 7).astype(np.uint8) & 1)
            if len(some):
                yield batch.take(pa.array(some))

    return lambda batches: function(kept(batches))


def _bitmap(keys: DataFrame, n: int) -> np.ndarray:
    """A bit for the place of each key, a power of two of bits: eight for each of the n keys at least, up to KEY_BITS."""
    bits = min(KEY_BITS, max(BITMAP_BITS, 1 << (8 * n - 1).bit_length()))
    place = F.col("row_key").bitwiseAND(F.lit(bits - 1))
    chunks = keys.select((place / BITMAP_BITS).cast("int").alias("chunk"), (place % BITMAP_BITS).alias("at"))
    out = np.zeros(bits // 8, np.uint8)
    for x in chunks.groupBy("chunk").agg(F.bitmap_construct_agg("at").alias("set")).collect():
        out[x.chunk * BITMAP_BITS // 8 : (x.chunk + 1) * BITMAP_BITS // 8] = np.frombuffer(x.set, np.uint8)
    return out


def _exact(texts: DataFrame, pairs: DataFrame, percent: int, width: int) -> DataFrame:
    """(x, pivot, n_x, linked, distance) of pairs, from their sets."""
    sets = _of_texts(texts, _ends(pairs), set_rows(width), "row_key long, set binary", "sets")
    both = pairs.select("x", "pivot").join(sets.toDF("x", "x_set"), "x").join(sets.toDF("pivot", "pivot_set"), "pivot")
    found = both.mapInArrow(compared, "x long, pivot long, n_x long, n_pivot long, shared long")
    union = F.col("n_x") + F.col("n_pivot") - F.col("shared")
    linked = 100 * F.col("shared") >= percent * union
    found = materialize(found.select("x", "pivot", "n_x", linked.alias("linked"), (1 - F.col("shared") / union).alias("distance")), "exact")
    discard(sets)
    return found


def _paired_blocks(rows: DataFrame, by: list[str], most: int) -> DataFrame:
    """``rows`` (x, n, ...) with ``group`` and ``block``: what ``by`` names in blocks of ``most`` shingles, each pair of which is a group."""
    sizes = rows.groupBy(by).agg(F.sum("n").alias("shingles"), F.count("*").alias("members"))
    sizes = sizes.filter("members > 1").select(*by, F.ceil(F.col("shingles") / most).cast("int").alias("blocks"))
    rows = joined(rows, sizes, by, "inner", "sizes").withColumn("block", F.pmod(F.xxhash64("x"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    group = F.xxhash64(*by, F.least("block", "other"), F.greatest("block", "other"))
    return rows.withColumn("group", group).drop("other", "blocks")


def _region_links(distances: DataFrame, known: DataFrame, texts: DataFrame, drawn: DataFrame, percent: int, width: int) -> DataFrame:
    """(a, b) links among the members of each region that its pivot does not settle, beside the ``known`` (a, b: pivot)."""
    t = 1 - percent / 100 + 1e-9
    open_ = distances.groupBy("pivot").agg(
        F.min(F.when(~F.col("linked"), F.col("distance"))).alias("nearest"), F.count(F.when(~F.col("linked"), 1)).alias("beyond")
    )
    rows = joined(distances, open_.filter("beyond > 0"), ["pivot"], "inner", "open-regions").filter(~F.col("linked") | (F.col("distance") >= F.col("nearest") - t))
    label = known.groupBy(F.col("a").alias("x")).agg(F.min("b").alias("label"))
    rows = joined(rows, label, ["x"], "left", "labels").select("pivot", "x", F.coalesce("label", "x").alias("label"), F.col("n_x").alias("n"), "distance", "linked")
    rows = _paired_blocks(rows, ["pivot"], SKETCHED_SHINGLES).select("group", "block", "x", "label", "n", "distance", "linked")
    # Most groups are small: a task takes many of them together.
    n_bins = -(-(rows.agg(F.sum("n").alias("n")).first().n or 0) // SKETCHED_SHINGLES)
    rows = rows.withColumn("bin", F.pmod("group", F.lit(max(1, n_bins))))
    found = rows.join(drawn.toDF("x", "sketch"), "x").groupBy("bin").applyInArrow(possible(percent), "h1 long, h2 long, x long, n long")
    found = materialize(found.distinct(), "possible-members")
    sets = _of_texts(texts, found.select(F.col("x").alias("row_key")).distinct(), set_rows(width), "row_key long, set binary", "region-sets")
    # Parts that have members in common are joined as one, so that each set is sent once.
    whole = components(found.select(F.col("h1").alias("a"), F.col("x").alias("b"))).toDF("x", "part")
    rows = materialize(found.select("x", "n").distinct().join(whole, "x"), "parts")
    rows = _paired_blocks(rows, ["part"], REGION_SHINGLES).select("group", "x").join(sets.toDF("x", "set"), "x")
    links = materialize(rows.groupBy("group").applyInArrow(joined_region(percent), "a long, b long").distinct(), "region-links")
    discard(drawn, found, sets)
    return links
