"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

A document's terms are pairs of neighbouring character classes (small letters, capitals, digits, line ends and each sign of
their own, so that the terms mean the same in any language) and marks of repeated words and of short texts. Terms are weighted by
inverse document frequency over the whole table, and a truncated singular value decomposition of a bounded sample of
labelled rows gives the latent axes. The sample's vectors are broadcast (``most`` rows of ``AXES`` numbers); every document
is compared with all of them in blocks of a matrix product, and the ``VOTERS`` most similar vote with weights that grow
with the cosine. No row is shuffled: the table is read once for frequencies and once for scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from answerloom.llm.arrowtext import flat, slices, word_hashes, words
from answerloom.llm.labelled import labelled_sample

MOST_LABELLED = 4000
AXES = 24
VOTERS = 32
SHARPNESS = 4
SLICE_BYTES = 2 << 20
SLICE_ROWS = 2048  # of N_TERMS numbers each
BLOCK_ROWS = 512

_CLASS = np.zeros(256, dtype=np.int32)  # 0: small letters and bytes of other scripts
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[:32] = 3
_CLASS[ord("\n")] = 4
_SIGNS = [b for b in range(32, 127) if not chr(b).isalnum()]
_CLASS[_SIGNS] = np.arange(5, 5 + len(_SIGNS))
N_CLASSES = 5 + len(_SIGNS)
PAIRS = N_CLASSES * N_CLASSES
# After the pairs: repeated word, word repeated after one other, short word, long word, new word, short text, empty text.
N_TERMS = PAIRS + 7


def term_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How often each document has each term, as shares of its characters or words."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    doc = np.repeat(np.arange(n, dtype=np.int64), size)
    kind = _CLASS[data]
    same = doc[1:] == doc[:-1]
    codes = doc[1:][same] * N_TERMS + (kind[:-1] * N_CLASSES + kind[1:])[same]
    counts = np.bincount(codes, minlength=n * N_TERMS).reshape(n, N_TERMS).astype(np.float32)
    counts[:, :PAIRS] /= np.maximum(size, 1)[:, None]
    starts, lengths, per_doc = words(data, offsets)
    of = np.repeat(np.arange(n), per_doc)
    hashes = word_hashes(data, starts, lengths)
    extra = np.zeros((n, 5), np.float32)
    for k, gap in enumerate((1, 2)):
        repeated = (hashes[gap:] == hashes[:-gap]) & (of[gap:] == of[:-gap])
        extra[:, k] = np.bincount(of[gap:][repeated], minlength=n)
    extra[:, 2] = np.bincount(of[lengths <= 2], minlength=n)
    extra[:, 3] = np.bincount(of[lengths >= 14], minlength=n)
    order = np.lexsort((hashes, of))
    first = np.ones(len(order), bool)
    first[1:] = (hashes[order][1:] != hashes[order][:-1]) | (of[order][1:] != of[order][:-1])
    extra[:, 4] = np.bincount(of[order][first], minlength=n)
    counts[:, PAIRS : PAIRS + 5] = extra / np.maximum(per_doc, 1)[:, None]
    counts[:, PAIRS + 5] = np.where(per_doc > 0, 1 / np.maximum(per_doc, 1), 0)
    counts[:, PAIRS + 6] = per_doc == 0
    return counts


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit term vectors; no term, zero vector."""
    x = np.sqrt(counts) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def latent(counts: np.ndarray, idf: np.ndarray, axes: np.ndarray) -> np.ndarray:
    y = weighted(counts, idf) @ axes
    return y / np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-12)


def latent_axes(counts: np.ndarray, idf: np.ndarray, n_axes: int = AXES) -> np.ndarray:
    """The leading right singular vectors of the sample's term vectors, one per column."""
    x = weighted(counts, idf).astype(np.float64)
    _, vectors = np.linalg.eigh(x.T @ x if x.shape[0] > x.shape[1] else x @ x.T)
    vectors = vectors[:, ::-1][:, :n_axes]
    if x.shape[0] <= x.shape[1]:
        vectors = x.T @ vectors
        vectors /= np.maximum(np.linalg.norm(vectors, axis=0), 1e-12)
    return vectors.astype(np.float32)


def vote(vectors: np.ndarray, voters: np.ndarray, labels: np.ndarray, prior: float) -> np.ndarray:
    """The labels' mean for each vector, weighted by similarity over the most similar voters, one vote for the prior."""
    k = min(VOTERS, len(voters))
    out = np.full(len(vectors), prior)
    for start in range(0, len(vectors) if k else 0, BLOCK_ROWS):
        cosine = vectors[start : start + BLOCK_ROWS] @ voters.T
        near = np.argpartition(cosine, len(voters) - k, axis=1)[:, len(voters) - k :]
        weight = np.maximum(np.take_along_axis(cosine, near, 1).astype(np.float64), 0) ** SHARPNESS
        out[start : start + BLOCK_ROWS] = ((weight * labels[near]).sum(1) + prior) / (weight.sum(1) + 1)
    return out


def document_frequencies(df: DataFrame, text_col: str = "text") -> tuple[np.ndarray, int]:
    """In how many rows of the whole table each term occurs, and the number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros(N_TERMS, np.int64), 0
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES, SLICE_ROWS):
                seen += (term_counts(*flat(part.column("text"))) > 0).sum(0)
                rows += part.num_rows
        found = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *found.tolist()]), pa.array([rows, *seen[found].tolist()])], names=["term", "n"])

    texts = df.select(F.col(text_col).alias("text"))
    counted = texts.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()  # N_TERMS + 1 rows at most
    seen = {x.term: x.n for x in counted}
    return np.array([seen.get(t, 0) for t in range(N_TERMS)], np.float64), seen.get(-1, 0)


def score_quality(df: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label: str = "quality", most: int = MOST_LABELLED) -> DataFrame:
    """(<id_col>, score): one row per input row, score from 0 to 1.

    Labels are learnt from up to ``most`` rows of ``labels`` where ``learn`` holds. Null texts count as empty, and empty
    texts are compared like others. Without any usable label each score is 0.5; an empty table gives none.
    """
    sample = labelled_sample(df, labels, label, learn, most, id_col, text_col).select("text", "label")

    def sample_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES, SLICE_ROWS):
                counts = pa.array(list(term_counts(*flat(part.column("text")))), pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([part.column("label"), counts], names=["label", "counts"])

    # No texts come back but N_TERMS numbers for each of at most ``most`` rows.
    sample = sample.mapInArrow(sample_counts, "label int, counts array<float>").toArrow()
    seen, rows = document_frequencies(df, text_col)
    idf = (np.log((rows + 1) / (seen + 1)) + 0.1).astype(np.float32)
    known = np.array(sample.column("label").to_pylist(), np.float64)
    prior = float(known.mean()) if len(known) else 0.5
    counts = np.array(sample.column("counts").combine_chunks().flatten(), np.float32).reshape(-1, N_TERMS)
    axes = latent_axes(counts, idf) if len(counts) else np.zeros((N_TERMS, 1), np.float32)
    model = df.sparkSession.sparkContext.broadcast((idf, axes, latent(counts, idf, axes), known, prior))
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = StructType([StructField(id_col, texts.schema["id"].dataType), StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, axes, voters, known, prior = model.value
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES, SLICE_ROWS):
                score = vote(latent(term_counts(*flat(part.column("text"))), idf, axes), voters, known, prior)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(score)], names=[id_col, "score"])

    return texts.mapInArrow(run, schema)
