"""Benchmark decontamination: a broadcast hash set of the benchmark's word windows, and one scan over the documents.

Texts are lower-cased (A-Z) and cut into words of digits, letters a-z and characters beyond ASCII. A window is ``width``
consecutive words of one benchmark item; an item of fewer words, but not none, is one window. Each task slides over its
documents' words in flat byte arrays, looks the hash of every run of words up in the set, and compares the words of each
hit with the window's, so that equal hashes of different words mark nothing. Words inside an occurrence of a window are hit.

Items are cut into pieces of bounded length, which overlap so that no window is lost, and pieces are dealt into blocks of up
to ``block_words`` words, counted before anything is broadcast. One block is broadcast for one scan of the documents; a
benchmark of several blocks takes as many scans, whose hits (rows with hits only) are put together by row. Documents
are not shuffled. Templates that many items share are one window with many items, and documents with the same windows
share the list of their items.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerloom.llm.arrowtext import flat, gather, lower_ascii, mix64, pieces, word_hashes, words
from answerloom.llm.common import free_names, matching, row_key128
from answerloom.storage import materialize

WIDTH = 10
BLOCK_WORDS = 1_000_000  # of the benchmark, broadcast at once: about 40 MB
PIECE_WORDS = 10_000
SLICE_BYTES = 4 << 20
VERIFIED = 1 << 15  # windows compared at once
ITEMS_AT_ONCE = 1 << 20  # of the documents of one output batch

_BETWEEN = np.ones(256, dtype=bool)
_BETWEEN[0x30:0x3A] = _BETWEEN[0x61:0x7B] = _BETWEEN[0x80:] = False

SPANS = "array<struct<word:bigint,words:bigint,start:bigint,bytes:bigint>>"
_SPAN = pa.struct([(name, pa.int64()) for name in ("word", "words", "start", "bytes")])


@dataclass
class Words:
    """The words of several texts: lower-cased bytes, where words start, their lengths and hashes, the text of each."""

    data: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    hashes: np.ndarray
    n: np.ndarray  # words per text

    @classmethod
    def of(cls, data: np.ndarray, offsets: np.ndarray) -> Words:
        data = lower_ascii(data)
        starts, lengths, n = words(data, offsets, _BETWEEN)
        return cls(data, starts, lengths, word_hashes(data, starts, lengths), n)


def same_words(a: Words, i: np.ndarray, b: Words, j: np.ndarray, size: int) -> np.ndarray:
    """For each pair of places whether the ``size`` words of ``a`` from i on are those of ``b`` from j on."""
    out = np.zeros(len(i), bool)
    for k in range(0, len(i), VERIFIED):
        x, y = ((p[k : k + VERIFIED, None] + np.arange(size)).reshape(-1) for p in (i, j))
        alike = a.lengths[x] == b.lengths[y]
        n = np.where(alike, a.lengths[x], 0)
        differ = a.data[gather(a.starts[x], n)] != b.data[gather(b.starts[y], n)]
        alike &= np.bincount(np.repeat(np.arange(len(x)), n), differ, len(x)) == 0
        out[k : k + VERIFIED] = alike.reshape(-1, size).all(1)
    return out


@dataclass
class Table:
    """The distinct windows of one size, by hash: first word of an occurrence, and the items (numbers) of each."""

    hashes: np.ndarray
    at: np.ndarray
    begin: np.ndarray  # n + 1 places in items
    items: np.ndarray

    @classmethod
    def of(cls, text: Words, at: np.ndarray, item: np.ndarray, hashes: np.ndarray, size: int) -> Table:
        kind, first = np.full(len(at), -1), np.zeros(0, np.int64)
        left = np.arange(len(at))
        while len(left):  # a second round only where different windows have one hash
            _, one, which = np.unique(hashes[left], return_index=True, return_inverse=True)
            same = same_words(text, at[left], text, at[left[one]][which], size)
            kind[left[same]] = len(first) + which[same]
            first, left = np.concatenate([first, left[one]]), left[~same]
        order = np.argsort(hashes[first], kind="stable")
        rank = np.empty(len(first), np.int64)
        rank[order] = np.arange(len(first))
        pairs = np.unique(np.stack([rank[kind], item], 1), axis=0)
        return cls(hashes[first][order], at[first][order], np.searchsorted(pairs[:, 0], np.arange(len(first) + 1)), pairs[:, 1])


@dataclass
class Windows:
    """A block of the benchmark: its words, its items' names in order, and a table for each size of window."""

    mask: np.uint64
    names: list[str]
    text: Words
    tables: dict[int, Table]

    @classmethod
    def of(cls, names: list[str], texts: pa.ChunkedArray, width: int, hash_bits: int = 64) -> Windows:
        self = cls(np.uint64((1 << hash_bits) - 1), sorted(set(names)), Words.of(*flat(texts)), {})
        number = {name: i for i, name in enumerate(self.names)}
        item = np.array([number[name] for name in names], np.int64)
        n = self.text.n
        size = np.minimum(n, width)
        counts = np.where(n > 0, n - size + 1, 0)
        at = gather(np.cumsum(n) - n, counts)
        of, size = np.repeat(item, counts), np.repeat(size, counts)
        for k in np.unique(size).tolist():
            own = size == k
            self.tables[k] = Table.of(self.text, at[own], of[own], self.runs(self.text.hashes, k)[at[own]], k)
        return self

    def state(self) -> tuple:
        """Plain arrays: what is broadcast is unpickled where this package may not be installed."""
        return self.mask, self.names, tuple(vars(self.text).values()), {k: tuple(vars(t).values()) for k, t in self.tables.items()}

    @classmethod
    def loaded(cls, state: tuple) -> Windows:
        mask, names, text, tables = state
        return cls(mask, names, Words(*text), {k: Table(*t) for k, t in tables.items()})

    def runs(self, hashes: np.ndarray, size: int, shorter: np.ndarray | None = None, done: int = 0) -> np.ndarray:
        """The hash of each run of ``size`` words, from that of its first ``done`` words where given."""
        value = np.zeros(len(hashes), np.uint64) if shorter is None else shorter
        for k in range(done, size):
            value = value[: max(len(hashes) - k, 0)]
            value = mix64(value * np.uint64(31) + hashes[k:])
        return value & self.mask if shorter is None else value

    def found(self, text: Words) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(size, first words, windows) of all occurrences in the texts, size by size."""
        of = np.repeat(np.arange(len(text.n)), text.n)
        value, done = np.zeros(len(of), np.uint64), 0
        for size, table in sorted(self.tables.items()):
            value, done = self.runs(text.hashes, size, value, done), size
            inside = np.flatnonzero(of[: len(value)] == of[size - 1 :]) if len(value) else np.zeros(0, np.int64)
            looked = value[inside] & self.mask
            few = np.zeros(1 << 22, bool)  # by the low bits: most runs of words end here
            few[(table.hashes & np.uint64((1 << 22) - 1)).astype(np.int64)] = True
            hit = few[(looked & np.uint64((1 << 22) - 1)).astype(np.int64)]
            inside, looked = inside[hit], looked[hit]
            low, high = (np.searchsorted(table.hashes, looked, side) for side in ("left", "right"))
            place, window = np.repeat(inside, high - low), gather(low, high - low)
            same = same_words(text, place, self.text, table.at[window], size)
            yield size, place[same], window[same]


def scanned(block: int, shared, everything: bool):
    """Per slice of (id, key, text): words, spans of hit words and items' names of each document, or of those with hits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows.loaded(shared.value)
        names = pa.array(windows.names, pa.string())
        for part in pieces(batches, "text", SLICE_BYTES):
            data, offsets = flat(part.column("text"))
            text = Words.of(data, offsets)
            of = np.repeat(np.arange(len(text.n)), text.n)
            edge = np.zeros(len(of) + 1, np.int64)
            pairs, lists = [np.zeros((0, 2), np.int64)], []
            base = 0
            for size, place, window in windows.found(text):
                np.add.at(edge, place, 1)
                np.add.at(edge, place + size, -1)
                pairs.append(np.unique(np.stack([of[place], window + base], 1), axis=0))
                lists.append(windows.tables[size])
                base += len(windows.tables[size].at)
            hit = np.cumsum(edge[:-1]) > 0
            starts_span = hit.copy()
            starts_span[1:] &= ~hit[:-1] | (of[1:] != of[:-1])
            ends_span = hit.copy()
            ends_span[:-1] &= ~hit[1:] | (of[1:] != of[:-1])
            a, b = np.flatnonzero(starts_span), np.flatnonzero(ends_span)
            first = np.cumsum(text.n) - text.n
            begin = text.starts[a] - offsets[of[a]]
            spans = [a - first[of[a]], b - a + 1, begin, text.starts[b] + text.lengths[b] - offsets[of[b]] - begin]
            ends = np.searchsorted(of[a], np.arange(len(text.n) + 1))
            pairs = np.concatenate(pairs)
            pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
            own = np.searchsorted(pairs[:, 0], np.arange(len(text.n) + 1))
            kept = np.arange(len(text.n)) if everything else np.flatnonzero(np.diff(own))
            for chosen, item, n_items in item_lists(kept, pairs[:, 1], own, lists):
                n_spans = np.diff(ends)[chosen]
                at = gather(ends[chosen], n_spans)
                columns = [
                    pa.array(np.full(len(chosen), block), pa.int32()),
                    *(part.column(c).take(pa.array(chosen)) for c in ("id", "k1", "k2")),
                    pa.array(text.n[chosen], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_spans)]), pa.int32()), pa.StructArray.from_arrays([pa.array(s[at], pa.int64()) for s in spans], fields=list(_SPAN))),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_items)]), pa.int32()), names.take(pa.array(item))),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "id", "k1", "k2", "n_words", "spans", "items"])

    return run


def item_lists(docs: np.ndarray, window: np.ndarray, own: np.ndarray, tables: list[Table]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(documents, their items one after the other, how many each has), a bounded number of items at a time."""
    bases = np.cumsum([0, *(len(t.at) for t in tables)])
    known: dict[bytes, np.ndarray] = {b"": np.zeros(0, np.int64)}
    chosen: list[int] = []
    held: list[np.ndarray] = []
    size = 0
    for doc in docs.tolist():
        mine = window[own[doc] : own[doc + 1]]
        key = mine.tobytes()
        if key not in known:
            level = np.searchsorted(bases, mine, "right") - 1
            parts = [t.items[gather(t.begin[w], t.begin[w + 1] - t.begin[w])] for k, t in enumerate(tables) for w in [mine[level == k] - bases[k]]]
            known[key] = np.unique(np.concatenate(parts))
        items = known[key]
        if chosen and size + len(items) > ITEMS_AT_ONCE:
            yield np.array(chosen), np.concatenate(held), np.array([len(h) for h in held])
            chosen, held, size = [], [], 0
            known = {b"": known[b""], key: items}
        chosen.append(doc)
        held.append(items)
        size += len(items)
    if chosen:
        yield np.array(chosen), np.concatenate(held), np.array([len(h) for h in held])


def merged_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with sorted spans, those put together that overlap or follow one another."""
    for batch in batches:
        lists = batch.column("spans")
        n = lists.value_lengths().to_numpy()
        word, size, start, length = (x.to_numpy() for x in lists.flatten().flatten())
        row = np.repeat(np.arange(len(n)), n)
        apart = row * (1 << 40)  # rows lie beyond each other
        end = np.maximum.accumulate(word + size + apart) if len(row) else word
        new = np.concatenate([[True], (row[1:] != row[:-1]) | (word[1:] + apart[1:] > end[:-1])])[: len(row)]
        first = np.flatnonzero(new)
        if len(first):
            size = np.maximum.reduceat(word + size, first) - word[first]
            length = np.maximum.reduceat(start + length, first) - start[first]
        counts = np.bincount(row[first], minlength=len(n))
        spans = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (word[first], size, start[first], length)], fields=list(_SPAN))
        yield batch.set_column(batch.schema.get_field_index("spans"), "spans", pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), spans))


def item_pieces(width: int, most_words: int):
    """Per item its normalised words, joined by one space, in pieces that overlap by all but one word of a window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = most_words - width + 1
        for part in pieces(batches, "text", SLICE_BYTES):
            items = part.column("item").to_pylist()
            text = Words.of(*flat(part.column("text")))
            ends = text.starts + text.lengths
            rows = []
            for item, first, n in zip(items, (np.cumsum(text.n) - text.n).tolist(), text.n.tolist(), strict=True):
                for k in range(0, max(n - width, 0) + 1 if n else 0, step):
                    own = slice(first + k, first + min(n, k + most_words))
                    found = [text.data[a:b].tobytes() for a, b in zip(text.starts[own].tolist(), ends[own].tolist(), strict=True)]
                    rows.append((item, b" ".join(found), len(found)))
            columns = [pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.string(), pa.binary(), pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["item", "words", "n"])

    return run


def benchmark_blocks(benchmark: DataFrame, item_col: str, text_col: str, width: int, block_words: int, piece_words: int) -> tuple[DataFrame, int]:
    """(item, words, n, block) and the number of blocks, none of which has more than ``block_words`` words."""
    if not width <= piece_words <= block_words:
        raise ValueError("a window must fit a piece, and a piece a block")
    rows = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text"))
    cut = materialize(rows.mapInArrow(item_pieces(width, piece_words), "item string, words binary, n int").distinct(), "benchmark")
    total = cut.agg(F.sum("n").alias("n")).first().n or 0
    n_blocks = max(1, -(-total // block_words))
    while True:
        dealt = cut.withColumn("block", F.pmod(F.xxhash64("item", "words"), F.lit(n_blocks)).cast("int"))
        if n_blocks == 1 or dealt.groupBy("block").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] <= block_words:
            return dealt, n_blocks
        n_blocks += -(-n_blocks // 4)


def find_contamination(
    df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", width: int = WIDTH, block_words: int = BLOCK_WORDS, piece_words: int = PIECE_WORDS, hash_bits: int = 64,
) -> DataFrame:
    """(row_key, <id_col>, n_words, n_hit, spans, items): a row per row of ``df``.

    ``spans`` are the maximal runs of hit words: first word, words, first byte (from 0) and bytes, in order. ``items`` are
    the ids, as sorted strings, of the items that a window in the text belongs to; rows with one id are one item, and those
    without an id one named by the empty string. Null and empty texts have no words. Repeated rows are reported each. An
    empty benchmark marks nothing, an empty table gives none. ``row_key`` is 128 bits of id and text.
    """
    rows = df.select(F.col(id_col).alias("id"), row_key128(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    rows = rows.select("id", "key.*", "text")
    dealt, n_blocks = benchmark_blocks(benchmark, item_col, item_text_col, width, block_words, piece_words)
    schema = f"block int, id {rows.schema['id'].dataType.simpleString()}, k1 long, k2 long, n_words long, spans {SPANS}, items array<string>"
    scans = []
    for block in range(n_blocks):
        held = dealt.filter(F.col("block") == block).select("item", "words").toArrow()
        windows = Windows.of(held.column("item").to_pylist(), held.column("words"), width, hash_bits)
        shared = df.sparkSession.sparkContext.broadcast(windows.state())
        scans.append(rows.mapInArrow(scanned(block, shared, block == 0), schema))
    if n_blocks == 1:
        found = scans[0].withColumn("n_hit", _summed("spans"))
        return found.select(_key(), F.col("id").alias(id_col), "n_words", "n_hit", "spans", "items")
    first = materialize(scans[0], "scanned")
    hits = first.filter(F.size("items") > 0)
    for scan in scans[1:]:
        hits = hits.unionByName(materialize(scan, "scanned"))
    # A repeated row has the same hits of a block each time. There is one row a block left, so a group is bounded.
    together = hits.dropDuplicates(["k1", "k2", "block"]).groupBy("k1", "k2").agg(
        F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
    )
    together = together.mapInArrow(merged_spans, together.schema)
    left = first.select("k1", "k2", "id", "n_words").join(together, ["k1", "k2"], "left")
    left = left.withColumns({"spans": F.coalesce("spans", F.array().cast(SPANS)), "items": F.coalesce("items", F.array().cast("array<string>"))})
    return left.withColumn("n_hit", _summed("spans")).select(_key(), F.col("id").alias(id_col), "n_words", "n_hit", "spans", "items")


def remove_spans(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``df`` with the hit words cut out of its texts, each span from its first word to its last; other columns unchanged."""
    found = find_contamination(df, benchmark, id_col, text_col, **settings).filter("n_hit > 0").select("row_key", "spans")
    found = materialize(found.dropDuplicates(["row_key"]), "spans")
    key, cuts = free_names(df, "row_key", "cuts")
    raw = F.encode(F.col(text_col), "UTF-8")
    begin = F.concat(F.array(F.lit(0).cast("long")), F.transform(cuts, lambda s: s["start"] + s["bytes"]))
    end = F.concat(F.transform(cuts, lambda s: s["start"]), F.array(F.octet_length(text_col).cast("long")))
    between = F.zip_with(begin, end, lambda b, e: F.decode(F.substring(raw, (b + 1).cast("int"), (e - b).cast("int")), "UTF-8"))
    rest = F.when(F.col(cuts).isNull(), F.col(text_col)).otherwise(F.array_join(between, ""))
    rows = matching(df.withColumn(key, row_key128(id_col, text_col)), found.toDF(key, cuts), found.count(), [key], "left")
    return rows.withColumn(text_col, rest).select(*df.columns)


def drop_contaminated(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: float = 0.0, **settings) -> DataFrame:
    """The rows of ``df`` of whose words no more than ``share`` are hit; all columns unchanged."""
    found = find_contamination(df, benchmark, id_col, text_col, **settings).filter(F.col("n_hit") > F.col("n_words") * share)
    found = materialize(found.select("row_key").distinct(), "contaminated")
    (key,) = free_names(df, "row_key")
    rows = df.withColumn(key, row_key128(id_col, text_col))
    return matching(rows, found.toDF(key), found.count(), [key], "left_anti").select(*df.columns)


def _key() -> Column:
    return F.struct("k1", "k2").alias("row_key")


def _summed(spans: str) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["words"])
