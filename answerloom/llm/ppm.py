"""Language-model scores by prediction by partial matching over a byte-context trie.

A text is read as its lower-cased words, one space after each, and an end mark. The trie holds, for every context of up to
ORDER bytes, how often each byte followed it in the training rows. A byte's probability comes from the longest context
that was seen with it, where half an occurrence of each distinct byte is set aside for escapes; each longer context costs its
escape probability and excludes the bytes seen there from what follows; below order 0 the remaining bytes are equally
likely.

The trie grows with the corpus, so it is kept in parts by the two bytes before the predicted one, whose deeper
contexts then lie in one part; what is needed of orders 0 and 1 has a fixed size and is broadcast. Rows are dealt into
chunks by hash. A chunk sends each part the distinct contexts and bytes it holds, with their training counts; a part sums
the counts of all chunks and answers each with the logarithms it asked for; the chunk adds them up by row.
So the number of contexts shuffled is that of distinct ones per chunk, not of positions. Word counts for the word-level
base score go the same way. Texts are shuffled once. ``CHUNK_BYTES`` bounds the memory of a chunk, ``PART_BYTES`` that of a part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerloom.llm.arrowtext import flat, gather, lower_ascii, mix64, pack, pieces, slices, unpack, word_hashes, words
from answerloom.llm.common import row_key

ORDER = 6
SPLIT = 2  # bytes of context that name a part of the trie
CHUNK_BYTES = 16 << 20
CHUNK_ROWS = 100_000
PART_BYTES = 16 << 20
BLOCK_BYTES = 2 << 20
BLOCK_ROWS = 256  # a row's place in its block fits into the 8 bits that a gram leaves free
END = 0x0A  # no word holds it
END_WORD = np.uint64(0x5851F42D4C957F2D)
ESCAPE = 0.5  # of an occurrence, per distinct byte
PAD = 0.1  # added to each word's count in the base score


class Stream:
    """What is predicted for a slice of documents, and the words that it is made of."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        data = lower_ascii(data)
        starts, lengths, self.n_words = words(data, offsets)
        n = len(self.n_words)
        self.word_hashes = word_hashes(data, starts, lengths)
        self.word_doc = np.repeat(np.arange(n), self.n_words)
        of_doc = np.bincount(self.word_doc, lengths + 1, n).astype(np.int64)
        self.size = np.maximum(of_doc, 1)  # the last space becomes the end mark
        begin = np.cumsum(self.size + ORDER) - self.size  # ORDER end marks stand before each text
        first_word = np.cumsum(self.n_words) - self.n_words
        place = np.cumsum(lengths + 1) - (lengths + 1)
        base = place[np.minimum(first_word, max(len(place) - 1, 0))] if len(place) else np.zeros(n, np.int64)
        at = place + (begin - base)[self.word_doc]
        self.bytes = np.full(int((self.size + ORDER).sum()), 0x20, np.uint8)
        self.bytes[gather(at, lengths)] = data[gather(starts, lengths)]
        self.bytes[gather(begin - ORDER, np.full(n, ORDER))] = END
        self.bytes[begin + self.size - 1] = END
        self.places = gather(begin, self.size)

    def tokens(self) -> tuple[np.ndarray, np.ndarray]:
        """(hash, document) of all words and of one end per document."""
        n = len(self.n_words)
        return np.concatenate([self.word_hashes, np.full(n, END_WORD)]), np.concatenate([self.word_doc, np.arange(n)])

    def grams(self) -> np.ndarray:
        """Per predicted byte: the byte before it, the one before that, ... and the byte itself, from high to low bits."""
        out = self.bytes[self.places].astype(np.uint64)
        for back in range(1, ORDER + 1):
            out |= self.bytes[self.places - back].astype(np.uint64) << np.uint64(8 * (ORDER + 1 - back))
        return out


def log_probabilities(grams: np.ndarray, counts: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The natural logarithm of each gram's last byte given the bytes before.

    ``grams`` are sorted and distinct and hold all that were trained of their contexts of SPLIT bytes; ``counts`` are their
    training counts and ``pairs[a, b]`` says how often byte b followed byte a.
    """
    symbol = grams & np.uint64(255)
    cells, cell_counts, parents = [], [], []
    for order in range(ORDER, SPLIT - 1, -1):
        shift = np.uint64(8 * (ORDER - order) + 8)
        key = ((grams >> shift) << np.uint64(8)) | symbol
        found, inverse = np.unique(key, return_inverse=True)
        cells.append(found)
        cell_counts.append(np.bincount(inverse, counts, len(found)))
    for found, below in zip(cells, cells[1:], strict=False):  # the cell of the same byte in the next shorter context
        parents.append(np.searchsorted(below, ((found >> np.uint64(16)) << np.uint64(8)) | (found & np.uint64(255))))
    # Below the split the cells are those of the fixed tables.
    cells += [np.arange(65536, dtype=np.uint64), np.arange(256, dtype=np.uint64)]
    cell_counts += [pairs.reshape(-1).astype(np.float64), pairs.sum(0).astype(np.float64)]
    last = cells[ORDER - SPLIT]
    parents += [((last >> np.uint64(16)) << np.uint64(8) | (last & np.uint64(255))).astype(np.int64), np.arange(65536) & 255]

    out = np.zeros(len(grams))
    at = np.searchsorted(cells[0], grams)
    pending = np.ones(len(grams), bool)
    excluded_count, excluded_kinds = np.zeros(len(grams)), np.zeros(len(grams))
    for level in range(ORDER + 1):
        count = cell_counts[level]
        node = np.unique(cells[level] >> np.uint64(8), return_inverse=True)[1]
        total, kinds = np.bincount(node, count), np.bincount(node, count > 0)
        mine, here = count[at], node[at]
        new_kinds = kinds[here] - excluded_kinds
        room = total[here] - excluded_count
        hit = pending & (mine > 0)
        out[hit] += np.log((mine[hit] - ESCAPE) / room[hit])
        escape = pending & ~hit & (total[here] > 0) & (room > 0)
        out[escape] += np.log(new_kinds[escape] * ESCAPE / room[escape])
        pending &= ~hit
        if level < ORDER:
            below = np.where(count > 0, cell_counts[level + 1][parents[level]], 0)
            excluded_count, excluded_kinds = np.bincount(node, below)[here], kinds[here]
            at = parents[level][at]
    left = 256 - (pairs.sum(0) > 0).sum()
    out[pending] -= np.log(max(left, 1))
    return out


def part_of(grams: np.ndarray, n_parts: int) -> np.ndarray:
    context = grams >> np.uint64(8 * (ORDER + 1 - SPLIT))
    return ((mix64(context + np.uint64(1)) >> np.uint64(32)) * np.uint64(n_parts) >> np.uint64(32)).astype(np.int64)


def runs(ordered: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate([ordered[:1] == ordered[:1], ordered[1:] != ordered[:-1]]))


def blocks(table: pa.Table) -> list[pa.RecordBatch]:
    return [b for batch in table.combine_chunks().to_batches() for b in slices(batch, "text", BLOCK_BYTES, BLOCK_ROWS)]


def requests(table: pa.Table, chunk: int, n_parts: int) -> pa.Table:
    """A chunk's distinct grams and words with their training counts, gathered block by block, for each part."""
    grams, words_ = [], []
    for block in blocks(table):
        stream, train = Stream(*flat(block.column("text"))), _flags(block.column("train"))
        packed = stream.grams() << np.uint64(1) | np.repeat(train, stream.size)
        grams.append(_counted(packed))
        hashes, doc = stream.tokens()
        words_.append(_counted_by(hashes, train[doc]))
    grams, gram_counts = _summed(*zip(*grams, strict=True))
    words_, word_counts = _summed(*zip(*words_, strict=True))
    gram_part = part_of(grams, n_parts)
    order = np.argsort(gram_part, kind="stable")
    grams, gram_counts = grams[order], gram_counts[order].astype(np.uint32)
    word_part = ((words_ >> np.uint64(32)) * np.uint64(n_parts) >> np.uint64(32)).astype(np.int64)
    edges = [np.searchsorted(x, np.arange(n_parts + 1)) for x in (gram_part[order], word_part)]
    rows = []
    for p in range(n_parts):
        g, w = (slice(e[p], e[p + 1]) for e in edges)
        rows.append((p, chunk, pack(grams[g], True), pack(gram_counts[g]), pack(words_[w], True), pack(word_counts[w].astype(np.uint32))))
    return pa.Table.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names=["part", "chunk", "grams", "gram_counts", "words", "word_counts"])


def _ordered(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, values = np.concatenate(keys), np.concatenate(values)
    order = np.argsort(keys)
    return keys[order], values[order]


def scores(table: pa.Table, replies: pa.Table) -> pa.Table:
    """The scores of a chunk's rows from what all parts say of its grams and words."""
    replies = replies.to_pylist()
    grams, logs = _ordered([unpack(r["grams"], np.uint64, True) for r in replies], [unpack(r["logs"], np.float32) for r in replies])
    words_, counts = _ordered([unpack(r["words"], np.uint64, True) for r in replies], [unpack(r["counts"], np.int64) for r in replies])
    total, kinds = sum(r["total"] for r in replies), sum(r["kinds"] for r in replies)
    per_word = np.log10((counts + PAD) / (total + PAD * (kinds + 1)))
    out = []
    for block in blocks(table):
        stream, n = Stream(*flat(block.column("text"))), block.num_rows
        packed = stream.grams() << np.uint64(8) | np.repeat(np.arange(n, dtype=np.uint64), stream.size)
        packed.sort()
        doc = (packed & np.uint64(255)).astype(np.int64)
        packed >>= np.uint64(8)
        run = runs(packed)
        of_run = logs[np.searchsorted(grams, packed[run])].astype(np.float64)
        score = np.bincount(doc, np.repeat(of_run, np.diff(np.append(run, len(packed)))), n) / np.log(10)
        hashes, doc = stream.tokens()
        at = np.searchsorted(words_, hashes)
        known = np.bincount(doc, counts[at] > 0, n).astype(np.int64)
        columns = [block.column("id"), pa.array(stream.n_words + 1), pa.array(known), pa.array(np.full(n, total)), pa.array(np.bincount(doc, per_word[at], n)), pa.array(score)]
        out.append(pa.RecordBatch.from_arrays(columns, names=["id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]))
    return pa.Table.from_batches(out)


def _flags(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.uint64)


def _counted(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values above the lowest bit, and how often that bit is set with each."""
    packed.sort()
    run = runs(packed >> np.uint64(1))
    return packed[run] >> np.uint64(1), np.add.reduceat((packed & np.uint64(1)).astype(np.int64), run)


def _counted_by(keys: np.ndarray, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys = keys[order]
    run = runs(keys)
    return keys[run], np.add.reduceat(flags[order].astype(np.int64), run)


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of several lists, each sorted and without repeats, and the sums of their counts."""
    ordered = np.sort(np.concatenate(keys))
    distinct = ordered[runs(ordered)]
    total = np.zeros(len(distinct), np.int64)
    for k, c in zip(keys, counts, strict=True):
        total[np.searchsorted(distinct, k)] += c
    return distinct, total


def answers(pairs):
    """The function of one part: logarithms and word counts for what each chunk asked."""

    def run(table: pa.Table) -> pa.Table:
        asked = table.to_pylist()
        grams, words_ = ([unpack(r[c], np.uint64, True) for r in asked] for c in ("grams", "words"))
        grams_here, gram_counts = _summed(grams, [unpack(r["gram_counts"], np.uint32) for r in asked])
        words_here, word_counts = _summed(words_, [unpack(r["word_counts"], np.uint32) for r in asked])
        logs = log_probabilities(grams_here, gram_counts, pairs.value).astype(np.float32)
        total, kinds = int(word_counts.sum()), int((word_counts > 0).sum())
        rows = [
            (r["part"], r["chunk"], r["grams"], pack(logs[np.searchsorted(grams_here, g)]), r["words"], pack(word_counts[np.searchsorted(words_here, w)]), total, kinds)
            for r, g, w in zip(asked, grams, words_, strict=True)
        ]
        return pa.Table.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names=["part", "chunk", "grams", "logs", "words", "counts", "total", "kinds"])

    return run


def byte_pairs(texts: DataFrame) -> np.ndarray:
    """How often each byte follows each byte in the training rows: a table of fixed size over the whole corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(65536, np.int64)
        for part in pieces(batches, "text", BLOCK_BYTES):
            stream = Stream(*flat(part.column("text")))
            seen += np.bincount(stream.bytes[stream.places - 1].astype(np.int64) << 8 | stream.bytes[stream.places], minlength=65536)
        found = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(seen[found])], names=["pair", "n"])

    found = texts.filter("train").select("text").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(65536, np.int64)
    out[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    return out.reshape(256, 256)


def score_texts(df: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(<id_col>, n_tokens, n_known, train_tokens, base_score, score): one row per input row.

    ``train`` says which rows are learnt from; null means yes. A text's tokens are its words and one end. ``score`` is the
    model's log10 probability of the text, ``base_score`` that of add-0.1 word frequencies; ``n_known`` counts tokens that
    training rows hold. Null texts count as empty and consist of the end alone. Without training rows all bytes are
    equally likely; an empty table gives none.
    """
    texts = df.select(
        F.col(id_col).alias("id"), row_key(id_col, text_col).alias("row_key"), F.coalesce(train, F.lit(True)).alias("train"), F.col(text_col).alias("text")
    )
    size, rows = texts.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    n_chunks = max(1, -(-(size or 0) // CHUNK_BYTES), -(-rows // CHUNK_ROWS))
    n_parts = max(1, -(-(size or 0) // PART_BYTES))
    pairs = df.sparkSession.sparkContext.broadcast(byte_pairs(texts))
    chunks = texts.withColumn("chunk", F.pmod("row_key", F.lit(n_chunks).cast("long"))).groupBy("chunk")

    def ask(table: pa.Table) -> pa.Table:
        return requests(table, table.column("chunk")[0].as_py(), n_parts)

    asked = chunks.applyInArrow(ask, "part long, chunk long, grams binary, gram_counts binary, words binary, word_counts binary")
    replies = asked.groupBy("part").applyInArrow(answers(pairs), "part long, chunk long, grams binary, logs binary, words binary, counts binary, total long, kinds long")
    id_type = texts.schema["id"].dataType.simpleString()
    scored = chunks.cogroup(replies.groupBy("chunk")).applyInArrow(
        scores, f"id {id_type}, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
    return scored.withColumnRenamed("id", id_col)
