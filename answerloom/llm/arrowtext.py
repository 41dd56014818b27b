"""Texts of Arrow columns as flat numpy arrays: bytes, documents, words and word hashes, without a Python object per word."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# The bytes that separate words.
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACE_BYTES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column, one value after the other, and the n + 1 offsets; null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):
        column = pa.array([], pa.large_binary())
    column = column.cast(pa.large_binary())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    data = data[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    if column.null_count:
        lengths = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.diff(offsets), 0)
        data = data[gather(offsets[:-1], lengths)] if lengths.sum() != len(data) else data
        offsets = np.concatenate([[0], np.cumsum(lengths)])
    return data, offsets


def slices(batch: pa.RecordBatch, column: str, most_bytes: int, most_rows: int = 1 << 15) -> Iterator[pa.RecordBatch]:
    """The batch in runs of up to ``most_rows`` rows whose ``column`` holds about ``most_bytes``, a longer value alone."""
    steady()
    _, offsets = flat(batch.column(column))
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most_bytes, "right")) - 1)
        end = min(end, start + most_rows)
        yield batch.slice(start, end - start)
        start = end


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of each run, one run after the other."""
    total = int(lengths.sum())
    first = np.cumsum(lengths) - lengths
    return np.repeat(starts - first, lengths) + np.arange(total)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def words(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, words per document) of the runs of bytes that are not ``between`` words; documents end words."""
    letter = ~between[data]
    before = np.empty_like(letter)
    before[1:], after = letter[:-1], np.empty_like(letter)
    after[:-1] = letter[1:]
    inner = offsets[:-1][offsets[:-1] < len(data)]
    before[inner] = False
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(letter & ~before)
    ends = np.flatnonzero(letter & ~after) + 1
    return starts, ends - starts, np.diff(np.searchsorted(starts, offsets))


def mix64(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64 bits for each run of bytes; runs of up to eight bytes have distinct ones for one length."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.as_strided(padded.view(np.uint8)[: len(data) + 1], (len(data) + 1, 8), (1, 1))
    mask = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)
    state = mix64(lengths.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    rest, at, left = np.arange(len(starts)), starts, lengths
    while len(rest):
        block = np.ascontiguousarray(eight[at]).view("<u8").reshape(-1) & mask[np.minimum(left, 8)]
        state[rest] = mix64(state[rest] ^ block)
        more = left > 8
        rest, at, left = rest[more], at[more] + 8, left[more] - 8
    return state


def binary_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary column from flat bytes and offsets."""
    buffers = [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, buffers).cast(pa.binary())


def pieces(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int, most_rows: int = 1 << 15) -> Iterator[pa.RecordBatch]:
    """All batches in runs as of ``slices``, small neighbouring batches put together."""
    held: list[pa.RecordBatch] = []
    size = rows = 0
    for batch in batches:
        for part in slices(batch, column, most_bytes, most_rows):
            n = len(flat(part.column(column))[0])
            if held and (size + n > most_bytes or rows + part.num_rows > most_rows):
                yield _joined(held)
                held, size, rows = [], 0, 0
            held.append(part)
            size, rows = size + n, rows + part.num_rows
    if held:
        yield _joined(held)
        held = []
    release()


def steady() -> None:
    """Let this process give large arrays back to the system as they are freed, instead of holding on to ever larger ones.

    Called for each batch: a cached function would travel to the workers by name, and they need not have this package.
    """
    mallopt = getattr(ctypes.CDLL(None), "mallopt", None)  # glibc only
    if mallopt:
        mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD, which otherwise grows to 32 MB


def release() -> None:
    """Give freed memory back to the system: a reused worker would otherwise hold what its largest task once took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def pack(values: np.ndarray, ascending: bool = False) -> bytes:
    """An array as compressed bytes; steps instead of values where these ascend, equal bytes of all numbers together."""
    if ascending:
        values = np.diff(values, prepend=values.dtype.type(0))
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpack(blob: bytes, dtype, ascending: bool = False) -> np.ndarray:
    size = int.from_bytes(blob[:8], "little")
    raw = np.frombuffer(pa.decompress(blob[8:], size, "zstd", asbytes=True), np.uint8)
    values = np.ascontiguousarray(raw.reshape(np.dtype(dtype).itemsize, -1).T).reshape(-1).view(dtype)
    return np.cumsum(values, dtype=values.dtype) if ascending else values
