"""Removal of repeated passages with prefix-partitioned suffix trees over words.

A passage is a window of ``window`` words; a word goes when some window over it occurs anywhere else. Suffixes are sampled:
of the prefixes (``PREFIX`` words) that start in a window, the one of least hash is the window's anchor, so equal windows
have their anchors at the same place, and only suffixes at anchors, one in fifteen, need be compared.

1. Prefixes of anchors that occur once in the whole table are dropped: a hash and a place per anchor is shuffled, and a
   prefix that occurs several times in a slice of rows costs one row for the slice.
2. What is left is grouped by prefix. A group of up to ``GROUP_SUFFIXES`` suffixes becomes a suffix tree of what follows
   the anchor and one of what precedes it, as sorted suffixes with the lengths of their common prefixes; a window is
   repeated when another suffix shares its nodes in both trees. For larger groups the prefix grows to the whole window,
   whose suffixes are all alike in a node, so that counting suffices and nothing need fit in one task; again a slice
   sends one row for each.
3. Spans of repeated windows go back to their documents.

Texts are shuffled once, by row, for steps 2 and 3 together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerloom.llm.arrowtext import binary_array, flat, gather, mix64, pack, pieces, unpack, word_hashes, words
from answerloom.llm.common import joined, row_key
from answerloom.storage import materialize

WINDOW = 35
PREFIX = 8  # words, a power of two
GROUP_SUFFIXES = 2000
SLICE_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20  # text whose suffixes one task compares
WORD_BYTES = 5  # of a word's hash, where suffixes of one prefix are compared


def prefix_hashes(hashes: np.ndarray) -> np.ndarray:
    """A hash of the PREFIX words from each place, by doubling; the last places wrap around."""
    size = 1
    while size < PREFIX:
        hashes = mix64(hashes * np.uint64(0xD6E8FEB86659FD93) + np.roll(hashes, -size))
        size *= 2
    return hashes


def least_places(values: np.ndarray, width: int) -> np.ndarray:
    """Where the least of the ``width`` values from each place is, the first among equals."""
    place = np.arange(len(values))
    done = 1
    while done < width:
        step = min(done, width - done)
        other = np.roll(place, -step)
        place = np.where(np.roll(values, -step) < values, other, place)
        values = np.minimum(values, np.roll(values, -step))
        done += step
    return place


class Anchors:
    """The anchors of a slice of documents, each with the run of windows that it stands for."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int):
        starts, lengths, self.n_words = words(data, offsets)
        self.hashes = word_hashes(data, starts, lengths)
        self.first = np.cumsum(self.n_words) - self.n_words
        self.prefix = prefix_hashes(self.hashes)
        anchor = least_places(mix64(self.prefix ^ np.uint64(0xA5A5)), window - PREFIX + 1)
        n_windows = np.maximum(self.n_words - window + 1, 0)
        at = gather(self.first, n_windows)
        doc = np.repeat(np.arange(len(self.n_words)), n_windows)
        anchor = anchor[at]
        new = np.ones(len(at), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
        begin = np.flatnonzero(new)
        self.doc, self.place = doc[begin], anchor[begin]
        self.from_window, self.to_window = at[begin], at[np.append(begin[1:], len(at)) - 1] if len(at) else at


def occurrence_rows(key: np.ndarray, row: np.ndarray, at: np.ndarray, n_buckets: int) -> list[dict]:
    """One occurrence of each key, for the bucket of the key, and all of those that occur several times here.

    The latter are known to be repeated and go to any bucket, so that a key that is everywhere meets in none.
    """
    order = np.lexsort((at, row, key))
    key, row, at = key[order], row[order], at[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    several = np.diff(np.append(np.flatnonzero(new), len(key)))[np.cumsum(new) - 1] > 1 if len(key) else new
    out = []
    for kind, use in (("first", new), ("repeated", several)):
        k, r, a, s = key[use], row[use], at[use], several[use]
        if kind == "first":
            bucket = ((k >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)
            edges = np.searchsorted(bucket, np.arange(n_buckets + 1, dtype=np.uint64))
            cut = [(b, slice(edges[b], edges[b + 1])) for b in np.flatnonzero(np.diff(edges))]
        else:
            cut = [(int(r[0]) % n_buckets, slice(0, len(k)))] if len(k) else []
        for b, part in cut:
            names, index = np.unique(r[part], return_inverse=True)
            out.append(
                {"bucket": int(b), "kind": kind, "key": pack(k[part], True), "row": pack(names, True), "index": pack(index.astype(np.uint32)),
                 "at": pack(a[part].astype(np.uint32)), "more": pack(s[part].astype(np.uint8)), "words": None}
            )
    return out


PARTS = pa.schema([("bucket", pa.int32()), ("kind", pa.string()), *((c, pa.binary()) for c in ("key", "row", "index", "at", "more", "words"))])
PARTS_SQL = "bucket int, kind string, key binary, row binary, index binary, at binary, more binary, words binary"


def repeated_occurrences(parts: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, row, at) of all occurrences of keys that occur more than once, from ``occurrence_rows`` of one bucket."""
    read = [(p["kind"], unpack(p["key"], np.uint64, True), unpack(p["row"], np.int64, True)[unpack(p["index"], np.uint32)], unpack(p["at"], np.uint32), unpack(p["more"], np.uint8) > 0) for p in parts]
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, bool)
    key, row, at, more = (np.concatenate([none[i], *[r[i + 1] for r in read if r[0] == "first"]]) for i in range(4))
    ordered = np.sort(np.concatenate([key, key[more]]))
    shared = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    single = np.isin(key, shared) & ~more
    return tuple(np.concatenate([x[single], *[r[i + 1] for r in read if r[0] == "repeated"]]) for i, x in enumerate((key, row, at)))


def anchor_rows(n_buckets: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "text", SLICE_BYTES):
            a = Anchors(*flat(part.column("text")), window)
            rows = part.column("row_key").to_numpy()
            yield pa.RecordBatch.from_pylist(occurrence_rows(a.prefix[a.place], rows[a.doc], a.place - a.first[a.doc], n_buckets), PARTS)

    return run


def repeated_anchors(table: pa.Table) -> pa.Table:
    key, row, at = repeated_occurrences(table.to_pylist())
    return pa.table({"prefix": key.view(np.int64), "row_key": row, "place": at.astype(np.int32)})


def suffix_rows(n_buckets: int, window: int):
    """For rows with the places of their repeated anchors: the suffixes of small groups, the windows of large ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "text", SLICE_BYTES):
            a = Anchors(*flat(part.column("text")), window)
            rows = part.column("row_key").to_numpy()
            counts = pc.list_value_length(part.column("places")).to_numpy(zero_copy_only=False)
            place = pc.list_flatten(part.column("places")).to_numpy() + np.repeat(a.first, counts)
            large = pc.list_flatten(part.column("large")).to_numpy(zero_copy_only=False)
            order = np.argsort(a.place)  # places of one slice are distinct
            which = order[np.searchsorted(a.place[order], place)]
            out = window_parts(a, which[large], rows, n_buckets, window) + tree_parts(a, which[~large], rows, n_buckets, window)
            yield pa.RecordBatch.from_pylist(out, PARTS)

    return run


def window_parts(a: Anchors, which: np.ndarray, rows: np.ndarray, n_buckets: int, window: int) -> list[dict]:
    n = a.to_window[which] - a.from_window[which] + 1
    at = gather(a.from_window[which], n)
    whole = np.full(len(at), window, np.uint64)
    for k in range(window):
        whole = mix64(whole + a.hashes[at + k])
    doc = np.repeat(a.doc[which], n)
    return occurrence_rows(whole, rows[doc], at - a.first[doc], n_buckets)


def tree_parts(a: Anchors, which: np.ndarray, rows: np.ndarray, n_buckets: int, window: int) -> list[dict]:
    which = which[np.argsort(a.prefix[a.place[which]], kind="stable")]
    place, doc = a.place[which], a.doc[which]
    low, high = place - a.to_window[which], place - a.from_window[which]  # words of its windows before the anchor
    n = high + window - low
    bucket = ((a.prefix[place] >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)
    edges = np.searchsorted(bucket, np.arange(n_buckets + 1, dtype=np.uint64))
    out = []
    for b in np.flatnonzero(np.diff(edges)):
        s = slice(edges[b], edges[b + 1])
        content = a.hashes[gather(place[s] - high[s], n[s])].view(np.uint8).reshape(-1, 8)[:, :WORD_BYTES]
        names, index = np.unique(rows[doc[s]], return_inverse=True)
        reach = np.stack([low[s], high[s]], 1).astype(np.uint16).reshape(-1)
        out.append(
            {"bucket": int(b), "kind": "tree", "key": pack(a.prefix[place[s]], True), "row": pack(names, True), "index": pack(index.astype(np.uint32)),
             "at": pack((place - a.first[doc])[s].astype(np.uint32)), "more": pack(reach), "words": np.ascontiguousarray(content).tobytes()}
        )
    return out


def tree(group: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A suffix tree per group in array form: (order of the rows, symbols each shares with the one before; -1: none)."""
    order = np.lexsort((*symbols.T[::-1], group))
    same = np.ones(max(len(order) - 1, 0), bool)
    shared = np.zeros(len(order), np.int64)
    shared[1:][group[order][1:] != group[order][:-1]] = -1
    shared[:1] = -1
    same = shared[1:] >= 0
    for column in symbols.T:
        same = same & (column[order][1:] == column[order][:-1])
        shared[1:] += same
    return order, shared


def nodes(order: np.ndarray, shared: np.ndarray, depth: int) -> np.ndarray:
    """Per row the number of the node at ``depth`` that it is below: the interval of rows that share that many symbols."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(shared < depth)
    return out


def tree_windows(parts: list[dict], window: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, window) of the repeated windows among the suffixes of one bucket."""
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = np.concatenate([unpack(p["key"], np.uint64, True) for p in parts])
    row = np.concatenate([unpack(p["row"], np.int64, True)[unpack(p["index"], np.uint32)] for p in parts])
    at = np.concatenate([unpack(p["at"], np.uint32) for p in parts]).astype(np.int64)
    low, high = np.concatenate([unpack(p["more"], np.uint16) for p in parts]).reshape(-1, 2).astype(np.int64).T
    content = np.frombuffer(b"".join(p["words"] for p in parts), np.uint8).reshape(-1, WORD_BYTES)
    wide = np.zeros((len(content) + 1, 8), np.uint8)
    wide[:-1, :WORD_BYTES] = content
    symbols = wide.reshape(-1).view(np.uint64)  # the last one, 0, stands where a suffix has no more words
    n = high + window - low
    anchor = np.cumsum(n) - n + high
    after, before = np.arange(window), np.arange(window - PREFIX)
    right = symbols[np.where(after < (window - low)[:, None], anchor[:, None] + after, len(content))]
    left = symbols[np.where(before < high[:, None], anchor[:, None] - 1 - before, len(content))]
    group = np.unique(key, return_inverse=True)[1]
    right, left = tree(group, right), tree(group, left)
    rows, windows = [], []
    for offset in range(window - PREFIX + 1):
        own = np.flatnonzero((low <= offset) & (offset <= high))
        node = nodes(*right, window - offset)[own] * (len(key) + 1) + nodes(*left, offset)[own]
        _, which, count = np.unique(node, return_inverse=True, return_counts=True)
        repeated = own[count[which] > 1]
        rows.append(row[repeated])
        windows.append(at[repeated] - offset)
    return np.concatenate(rows), np.concatenate(windows)


def span_rows(window: int):
    def run(table: pa.Table) -> pa.Table:
        """(row_key, begin, end) of the words under the repeated windows of one bucket."""
        parts = table.to_pylist()
        row, at = tree_windows([p for p in parts if p["kind"] == "tree"], window)
        _, whole_row, whole_at = repeated_occurrences([p for p in parts if p["kind"] != "tree"])
        row, at = np.concatenate([row, whole_row]), np.concatenate([at, whole_at.astype(np.int64)])
        order = np.lexsort((at, row))
        row, at = row[order], at[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (at[1:] > at[:-1] + 1)
        begin = np.flatnonzero(new)
        last = np.append(begin[1:], len(row))[: len(begin)] - 1
        return pa.table({"row_key": row[begin], "begin": at[begin].astype(np.int32), "end": (at[last] + window).astype(np.int32)})

    return run


def kept_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, n_words, n_removed, kept) from (id, text, begins, ends)."""
    for part in pieces(batches, "text", SLICE_BYTES):
        data, offsets = flat(part.column("text"))
        starts, lengths, n_words = words(data, offsets)
        first = np.cumsum(n_words) - n_words
        counts = pc.list_value_length(part.column("begins")).to_numpy(zero_copy_only=False)
        change = np.zeros(len(starts) + 1, np.int64)
        for name, step in (("begins", 1), ("ends", -1)):
            np.add.at(change, pc.list_flatten(part.column(name)).to_numpy() + np.repeat(first, counts), step)
        kept = np.cumsum(change)[:-1] == 0
        doc = np.repeat(np.arange(len(n_words)), n_words)[kept]
        starts, lengths = starts[kept], lengths[kept]
        n_kept = np.bincount(doc, minlength=len(n_words))
        spaced = lengths + 1
        if len(doc):
            spaced[np.flatnonzero(np.append(doc[1:] != doc[:-1], True))] -= 1  # none after the last word
        out = np.full(int(spaced.sum()), 0x20, np.uint8)
        out[gather(np.cumsum(spaced) - spaced, lengths)] = data[gather(starts, lengths)]
        ends = np.concatenate([[0], np.cumsum(spaced)])[np.concatenate([[0], np.cumsum(n_kept)])]
        columns = [part.column("id"), pa.array(n_words), pa.array(n_words - n_kept), binary_array(out, ends)]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "n_words", "n_removed", "kept"])


def repeated_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(row_key, begin, end): runs of a row's words under windows that occur more than once; runs may overlap.

    Null texts have no words. A row that is repeated, id and text, repeats all its windows.
    """
    texts = _texts(df, id_col, text_col)
    total = texts.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    n_buckets = max(1, -(-total // BUCKET_BYTES))
    parts = texts.select("row_key", "text").mapInArrow(anchor_rows(n_buckets, window), PARTS_SQL)
    anchors = parts.groupBy("bucket").applyInArrow(repeated_anchors, "prefix long, row_key long, place int")
    anchors = materialize(anchors, "repeated-anchors")
    large = anchors.groupBy("prefix").agg(F.count("*").alias("n")).filter(F.col("n") > GROUP_SUFFIXES)
    marked = joined(anchors, large, ["prefix"], "left", "large-groups").select("row_key", F.struct("place", F.col("n").isNotNull().alias("large")).alias("a"))
    marked = marked.groupBy("row_key").agg(F.collect_set("a").alias("a")).select("row_key", F.col("a.place").alias("places"), F.col("a.large").alias("large"))
    # The id comes along unused: with the columns of the join in remove_repeats, one shuffle of the texts serves both.
    parts = texts.join(marked, "row_key").mapInArrow(suffix_rows(n_buckets, window), PARTS_SQL)
    return parts.groupBy("bucket").applyInArrow(span_rows(window), "row_key long, begin int, end int")


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(<id_col>, n_words, n_removed, kept binary): one row per input row.

    ``kept`` has the words outside all repeated windows, joined by one space. Rows of fewer words than a window lose
    nothing, null and empty texts have no words; an empty table gives none.
    """
    spans = repeated_spans(df, id_col, text_col, window)
    spans = spans.groupBy("row_key").agg(F.collect_list(F.struct("begin", "end")).alias("s"))
    texts = _texts(df, id_col, text_col).join(spans, "row_key", "left")
    none = F.array().cast("array<int>")
    texts = texts.select("id", "text", F.coalesce("s.begin", none).alias("begins"), F.coalesce("s.end", none).alias("ends"))
    id_type = texts.schema["id"].dataType.simpleString()
    kept = texts.mapInArrow(kept_rows, f"id {id_type}, n_words long, n_removed long, kept binary")
    return kept.withColumnRenamed("id", id_col)


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("row_key"), F.col(text_col).alias("text"))
