"""Byte-level BPE encoding and decoding with the ranks of a public vocabulary.

Each match of the splitting pattern is a piece. The distinct pieces of a slice of rows are laid out as byte rows of padded
numpy matrices, one per length bucket. In each round every row merges its leftmost pair of least rank, found in an
open-addressing hash table of all pairs that merge; merged rows lose a column and finished rows leave the matrix. Pieces
above ``MATRIX_BYTES`` bytes, whose matrix would cost the square of their length, are merged with a heap instead, which
gives the same ids. Nothing is shuffled: rows are encoded where they are read, and a worker keeps the pieces it met last.

The vocabulary (a bounded table, checked against ``MAX_VOCABULARY``) is read by the driver and broadcast.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from answerloom.llm.arrowtext import binary_array, flat, gather, release, slices

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
MAX_VOCABULARY = 300_000
MATRIX_BYTES = 256
MATRIX_CELLS = 1 << 21
SLICE_BYTES = 1 << 20
KEPT_PIECES = 150_000
NONE = np.int32(2**31 - 1)


@dataclass
class Vocabulary:
    """Token bytes by id, ids by bytes, and the table of merging pairs."""

    ids: dict[bytes, int]
    data: np.ndarray = field(init=False)
    starts: np.ndarray = field(init=False)
    lengths: np.ndarray = field(init=False)

    def __post_init__(self):
        if len(self.ids) > MAX_VOCABULARY:
            raise ValueError(f"more than {MAX_VOCABULARY} tokens")
        tokens = [b""] * (max(self.ids.values()) + 1)
        for token, i in self.ids.items():
            tokens[i] = token
        self.lengths = np.array([len(t) for t in tokens])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(tokens), np.uint8)
        self.single = np.array([self.ids[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for token, i in self.ids.items():
            for cut in range(1, len(token)):
                a, b = self.ids.get(token[:cut]), self.ids.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = i
        self._fill(np.array(list(pairs), np.int64), np.array(list(pairs.values()), np.int32))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _fill(self, keys: np.ndarray, ranks: np.ndarray) -> None:
        self.bits = max(4, int(4 * len(keys)).bit_length())
        self.keys, self.ranks = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, NONE, np.int32)
        slot = self._slot(keys)
        while len(keys):
            free = self.keys[slot] == -1
            self.keys[slot[free]] = keys[free]  # of several keys for a slot the last one stays
            placed = self.keys[slot] == keys
            self.ranks[slot[placed]] = ranks[placed]
            keys, ranks, slot = keys[~placed], ranks[~placed], (slot[~placed] + 1) & ((1 << self.bits) - 1)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank, which is also the id, of each merged pair; NONE where a pair does not merge or is padding."""
        shape = left.shape
        keys = (left.astype(np.int64) << 32 | right.astype(np.int64)).reshape(-1)
        keys[(right.reshape(-1) < 0) | (left.reshape(-1) < 0)] = -2
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.ranks[slot], NONE)
        open_ = np.flatnonzero((found != keys) & (found != -1) & (keys >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slot[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.ranks[slot[open_[hit]]]
            open_ = open_[~hit & (found != -1)]
        return out.reshape(shape)

    def merge_matrix(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge the rows of a matrix of ids padded with -1; (ids row by row, ids per row)."""
        n, width = tokens.shape
        done = np.full((n, width), -1, np.int32)
        rows = np.arange(n)
        ranks = self.pair_ranks(tokens[:, :-1], tokens[:, 1:])
        while len(rows):
            if ranks.shape[1]:
                at = ranks.argmin(1)
                best = ranks[np.arange(len(rows)), at]
            else:
                at, best = np.zeros(len(rows), np.int64), np.full(len(rows), NONE)
            if (ended := best == NONE).any():
                done[rows[ended], : tokens.shape[1]] = tokens[ended]
                going = ~ended
                rows, tokens, ranks, at, best = rows[going], tokens[going], ranks[going], at[going], best[going]
                if not len(rows):
                    break
            each = np.arange(len(rows))
            tokens[each, at] = best
            columns = np.arange(tokens.shape[1] - 1)
            shift = columns + (columns > at[:, None])
            tokens = np.take_along_axis(tokens, shift, 1)
            ranks = np.take_along_axis(ranks, shift[:, :-1], 1)
            for near in (at - 1, at):
                inside = (near >= 0) & (near < ranks.shape[1])
                i, j = each[inside], near[inside]
                ranks[i, j] = self.pair_ranks(tokens[i, j], tokens[i, j + 1])
        return done[done >= 0], (done >= 0).sum(1)

    def merge_long(self, piece: bytes) -> list[int]:
        """The ids of one piece: a heap of pairs by rank and place over a linked list of tokens."""
        ids = self.single[np.frombuffer(piece, np.uint8)].tolist()
        after = list(range(1, len(ids) + 1))
        before = list(range(-1, len(ids) - 1))
        rank = lambda a, b: int(self.pair_ranks(np.array([a]), np.array([b]))[0])
        first = self.pair_ranks(np.array(ids[:-1], np.int64), np.array(ids[1:], np.int64)).tolist()
        known: dict[tuple[int, int], int] = dict(zip(zip(ids, ids[1:], strict=False), first, strict=True))
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r != NONE]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= len(ids) or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = r, -1, after[j]
            if after[i] < len(ids):
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < len(ids):
                    pair = ids[x], ids[y]
                    if pair not in known:
                        known[pair] = rank(*pair)
                    if known[pair] != NONE:
                        heapq.heappush(heap, (known[pair], x, *pair))
        return [t for t in ids if t >= 0]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """The bytes of each run of ids between offsets."""
        lengths = self.lengths[ids]
        ends = np.concatenate([[0], np.cumsum(lengths)])[offsets]
        return binary_array(self.data[gather(self.starts[ids], lengths)], ends)

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of one piece after the other, ids per piece)."""
        counts = np.zeros(len(pieces), np.int64)
        lengths = np.array([len(p) for p in pieces], np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []  # (pieces, their ids)
        whole = np.array([self.ids.get(p, -1) for p in pieces], np.int64)
        direct = np.flatnonzero(whole >= 0)
        counts[direct] = 1
        found.append((direct, whole[direct].astype(np.int32)))
        for i in np.flatnonzero((whole < 0) & (lengths > MATRIX_BYTES)):
            ids = np.array(self.merge_long(pieces[i]), np.int32)
            counts[i] = len(ids)
            found.append((np.array([i]), ids))
        low, high = 0, 4
        while low < MATRIX_BYTES:
            bucket = np.flatnonzero((whole < 0) & (lengths > low) & (lengths <= high))
            step = max(1, MATRIX_CELLS // high)
            for k in range(0, len(bucket), step):
                rows = bucket[k : k + step]
                matrix = np.full((len(rows), high), -1, np.int32)
                filled = np.arange(high) < lengths[rows][:, None]
                matrix[filled] = self.single[np.frombuffer(b"".join([pieces[i] for i in rows]), np.uint8)]
                ids, counts[rows] = self.merge_matrix(matrix)
                found.append((rows, ids))
            low, high = high, min(high * 2, MATRIX_BYTES)
        starts = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), np.int32)
        for rows, ids in found:
            out[gather(starts[rows], counts[rows])] = ids
        return out, counts


class Encoder:
    """Ids of whole texts; keeps the pieces met so far, up to ``KEPT_PIECES``, with their ids."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.split = vocabulary, regex.compile(pattern).findall
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.counts = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of one text after the other, ids per text)."""
        split = [self.split(t) for t in texts]
        per_text = np.array([len(s) for s in split], np.int64)
        pieces = [p for s in split for p in s]
        if len(self.known) > KEPT_PIECES:
            self._forget()
        new = list(set(pieces).difference(self.known))
        if new:
            ids, counts = self.vocabulary.encode_pieces([p.encode() for p in new])
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
            self.ids, self.counts = np.concatenate([self.ids, ids]), np.concatenate([self.counts, counts])
        starts = np.cumsum(self.counts) - self.counts
        codes = np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))
        counts = self.counts[codes]
        out = self.ids[gather(starts[codes], counts)]
        ends = np.concatenate([[0], np.cumsum(counts)])[np.concatenate([[0], np.cumsum(per_text)])]
        return out, np.diff(ends)


def load(lines: bytes) -> Vocabulary:
    """The vocabulary of a rank file's bytes; a task builds it once."""
    return Vocabulary({base64.b64decode(t): int(i) for t, i in (x.split() for x in lines.splitlines() if x)})


def _rank_file(path: str | None) -> bytes:
    with open(path or public_tokenizers.path(VOCABULARY), "rb") as f:
        return f.read()


def encode(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), ranks: str | None = None, decoded: bool = False) -> DataFrame:
    """``keep`` and n_tokens long, ids binary (little-endian unsigned 32-bit): one row per input row, in no given order.

    Null counts as an empty text, which has no ids. ``ranks`` is the rank file's path on the driver. With ``decoded`` a
    column of that name has the bytes that the ids decode to, worked out from the ids by the same worker.
    """
    lines = df.sparkSession.sparkContext.broadcast(_rank_file(ranks))
    pattern = public_tokenizers.PATTERN
    rows = df.select(*[F.col(c) for c in keep], F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    added = [StructField("n_tokens", LongType()), StructField("ids", BinaryType())]
    added += [StructField("decoded", BinaryType())] if decoded else []
    schema = StructType([*rows.schema.fields[:-1], *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(load(lines.value), pattern)
        for batch in batches:
            for part in slices(batch, "__text", SLICE_BYTES):
                ids, counts = encoder.encode(part.column("__text").to_pylist())
                ends = np.concatenate([[0], np.cumsum(counts)])
                columns = [*part.columns[:-1], pa.array(counts, pa.int64()), binary_array(ids.astype("<u4").view(np.uint8), ends * 4)]
                if decoded:
                    columns.append(encoder.vocabulary.decode(ids, ends))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
        del encoder
        release()

    return rows.mapInArrow(run, schema)


def decode(df: DataFrame, ids_col: str = "ids", ranks: str | None = None) -> DataFrame:
    """All columns of ``df`` and decoded binary, the bytes of the ids; null ids decode to no bytes."""
    lines = df.sparkSession.sparkContext.broadcast(_rank_file(ranks))
    schema = StructType([*df.schema.fields, StructField("decoded", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = load(lines.value)
        for batch in batches:
            for part in slices(batch, ids_col, SLICE_BYTES):
                data, offsets = flat(part.column(ids_col))
                decoded = tokens.decode(np.frombuffer(data.tobytes(), "<u4"), offsets // 4)
                yield pa.RecordBatch.from_arrays([*part.columns, decoded], names=[*part.schema.names, "decoded"])

    return df.mapInArrow(run, schema)
