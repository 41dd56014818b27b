"""Toxicity by a weighted finite-state pattern grammar.

The lexicon maps words to classes: insults with their strength, threats, targets, negations and words of reported speech.
Transducers for negation, reported speech and targets, composed into one in ``grammar``, read the classes of a clause from
the left, and one for targets that follow reads its output from the right. They write the patterns that match: an
insult or a targeted threat, each with the context it stands in (targeted, negated, reported). A document's evidence is the strength of its matched patterns, and
weights per pattern turn evidence into a probability; a clause without a pattern adds nothing.

Insults are a general list and those learnt from labelled rows: whole words, or beginnings of words where the endings vary,
that toxic rows have far more often than chance allows. Lexicon and weights are fitted on a bounded sample (``most``
rows); every whole text is then scored where it is read, without a shuffle. Words are found in flat byte arrays, and only
clauses with a candidate are read word by word.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from answerloom.llm.arrowtext import flat, lower_ascii, release, slices
from answerloom.llm.grammar import INSULT, NEGATED, NEGATION, OTHER, PATTERNS, REPORT, REPORTED, TARGET, TARGETED, THREAT, kind, matches
from answerloom.llm.labelled import labelled_sample
from answerloom.storage import discard, materialize

MOST_LABELLED = 8000
SLICE_BYTES = 2 << 20
SHORTEST, LONGEST = 4, 8  # letters of a learnt beginning of a word
PRECISION = 0.6  # share of toxic rows among those with a learnt term
LEAST_CASES = 3
SURPRISE = 4.0  # log odds against chance beyond the number of terms tried
GENERAL_ROWS = 4.0  # what a general insult counts before labels are seen

# The general lexicon.
INSULTS = """idiot idiots moron morons stupid scum trash loser losers clown clowns pathetic worthless disgusting dumbass
imbecile jerk bastard bitch asshole idiota idiotas imbécil estúpido estúpida basura payaso patético inútil asqueroso
imbécile stupide ordure connard crétin minable dégoûtant dummkopf idioten abschaum versager widerlich erbärmlich
wertlos arschloch""".split()
THREATS = """kill hurt destroy murder stab strangle töten umbringen vernichten verprügeln matar matarte golpear destruir
tuer frapper détruire blesser""".split()
TARGETS = """you your he she they him her them u dich dir euch du ihr sie tú te ti usted ustedes vos tu toi vous il elle
ils elles""".split()
NEGATIONS = "not never no isn't aren't wasn't don't nicht kein keine nie nunca jamás pas jamais".split()
REPORTS = """said says quoted reported wrote claimed called sagte schrieb berichtete zitierte dijo escribió citó
dit écrit affirme""".split()

# Words are runs of letters; of forms with an apostrophe only the lexicon's own are one word, so that l'idiot is two.
_WORD = re.compile("|".join(rf"(?<![^\W\d_]){w}(?![^\W\d_])" for w in NEGATIONS if "'" in w) + r"|[^\W\d_]+")
_CLAUSE_END = np.zeros(256, dtype=bool)
_CLAUSE_END[[ord(c) for c in ".!?;:\n"]] = True
# Letters below U+10000, as _WORD has them.
_LETTER = np.array([chr(c).isalnum() and not chr(c).isdecimal() for c in range(1 << 16)])
_KINDS = {w: c for c, ws in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (THREAT, THREATS)) for w in ws}


@dataclass(frozen=True)
class Lexicon:
    words: dict[str, float]  # whole words and their strength
    beginnings: dict[str, float]

    def strength(self, word: str) -> float:
        found = self.words.get(word, 0.0)
        for n in range(SHORTEST, min(LONGEST, len(word)) + 1):
            found = max(found, self.beginnings.get(word[:n], 0.0))
        return found

    def heads(self) -> np.ndarray:
        """The first four bytes of every insult and threat, with small and capital first letter."""
        terms = [*self.words, *self.beginnings, *THREATS]
        heads = {form.encode()[:4] for t in terms for form in (t, t.capitalize(), t.upper())}
        data = b"".join(h.ljust(4, b"\0") for h in heads)
        return np.unique(np.frombuffer(lower_ascii(np.frombuffer(data, np.uint8)).tobytes(), "<u4"))


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower().replace("\u2019", "'"))


def letters(data: np.ndarray) -> np.ndarray:
    """Whether each byte belongs to a letter: quotation marks, dashes and the like beyond ASCII part words as ASCII ones do."""
    out = (data < 0x80) & _LETTER[data]
    at = np.flatnonzero(data >= 0xC0)
    if len(at):
        padded = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.int64)
        first, *rest = (padded[at + k] for k in range(4))
        rest = [b & 0x3F for b in rest]
        size = np.where(first < 0xE0, 2, np.where(first < 0xF0, 3, 4))
        code = np.where(size == 2, (first & 0x1F) << 6 | rest[0], (first & 0x0F) << 12 | rest[0] << 6 | rest[1])
        wide = (first & 0x07) << 18 | rest[0] << 12 | rest[1] << 6 | rest[2]
        # Beyond U+FFFF scripts are letters, blocks of notes, tiles and pictures are not.
        picture = ((wide >= 0x1D000) & (wide < 0x1D400)) | ((wide >= 0x1F000) & (wide < 0x20000))
        letter = np.where(size == 4, ~picture, _LETTER[code & 0xFFFF])
        for k in range(4):
            own = (size > k) & (at + k < len(data))
            out[at[own] + k] = letter[own]
    return out


def candidates(data: np.ndarray, offsets: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words start whose first four bytes may be an insult or a threat; the number of words per document."""
    if len(data) < 4:
        return np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    small = lower_ascii(data)
    letter = letters(small)
    starting = letter.copy()
    starting[1:] &= ~letter[:-1]
    starts = offsets[:-1][offsets[:-1] < len(data)]
    starting[starts] = letter[starts]
    at = np.flatnonzero(starting[: len(data) - 3])
    four = np.lib.stride_tricks.as_strided(small, (len(small) - 3, 4), (1, 1))
    hit = np.isin(np.ascontiguousarray(four[at]).view("<u4").reshape(-1), heads)
    return at[hit], np.diff(np.searchsorted(at, offsets))


def evidence(data: np.ndarray, offsets: np.ndarray, lexicon: Lexicon, heads: np.ndarray) -> np.ndarray:
    """Per document, the summed strength of each pattern's matches in its clauses, and of all per hundred words."""
    out = np.zeros((len(offsets) - 1, len(PATTERNS) + 1))
    at, n_words = candidates(data, offsets, heads)
    if not len(at):
        return out
    doc = np.searchsorted(offsets, at, "right") - 1
    ends = np.flatnonzero(_CLAUSE_END[data])
    place = np.searchsorted(ends, at)
    padded = np.concatenate([[-1], ends, [len(data)]])
    begin = np.maximum(padded[place] + 1, offsets[doc])
    end = np.minimum(padded[place + 1], offsets[doc + 1])
    _, first = np.unique(begin, return_index=True)
    number = {p: i for i, p in enumerate(PATTERNS)}
    for i in first:
        clause = words_of(data[begin[i] : end[i]].tobytes().decode("utf-8", "replace"))
        strengths = [lexicon.strength(w) for w in clause]
        classes = [INSULT if s else _KINDS.get(w, OTHER) for w, s in zip(clause, strengths, strict=True)]
        for symbol, s in zip(matches(classes), strengths, strict=True):
            if symbol in number:
                out[doc[i], number[symbol]] += s or 1.0
    out[:, -1] = 100 * out[:, :-1].sum(1) / np.maximum(n_words, 1)
    return out


def term_rows(sample: DataFrame) -> DataFrame:
    """(term, whole, toxic, clean): in how many rows of the sample each word and beginning of a word occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                words = {w for w in words_of(text or "") if len(w) >= SHORTEST}
                seen[label].update((w, True) for w in words)
                seen[label].update({(w[:n], False) for w in words for n in range(SHORTEST, min(LONGEST, len(w)) + 1)})
        terms = list(seen[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array([t for t, _ in terms], pa.string()), pa.array([w for _, w in terms], pa.bool_()),
             pa.array([seen[1][t] for t in terms], pa.int64()), pa.array([0 for _ in terms], pa.int64())],
            names=["term", "whole", "toxic", "clean"],
        )
        others = list(seen[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array([t for t, _ in others], pa.string()), pa.array([w for _, w in others], pa.bool_()),
             pa.array([0 for _ in others], pa.int64()), pa.array([seen[0][t] for t in others], pa.int64())],
            names=["term", "whole", "toxic", "clean"],
        )

    counted = sample.mapInArrow(run, "term string, whole boolean, toxic long, clean long")
    return counted.groupBy("term", "whole").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def context_rows(sample: DataFrame, terms: list[tuple[str, bool]]) -> DataFrame:
    """(term, whole, toxic, clean): in how many contexts, the words before and after, each of the terms stands."""
    words, beginnings = {t for t, whole in terms if whole}, {t for t, whole in terms if not whole}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = set()
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                read = words_of(text or "")
                for before, word, after in zip(["", *read], read, [*read[1:], ""], strict=False):
                    context = f"{before} {after}"
                    if word in words:
                        found.add((word, True, label, context))
                    found.update((word[:n], False, label, context) for n in range(SHORTEST, min(LONGEST, len(word)) + 1) if word[:n] in beginnings)
            columns = zip(*found, strict=True) if found else ((), (), (), ())
            kinds = (pa.string(), pa.bool_(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["term", "whole", "label", "context"])

    found = sample.mapInArrow(run, "term string, whole boolean, label int, context string").distinct()
    return found.groupBy("term", "whole").agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))


def telling(base: float, tried: int) -> Column:
    """Whether a term's share of toxic cases is above PRECISION and beyond chance among ``tried`` terms."""
    toxic, clean = F.col("toxic"), F.col("clean")
    n = toxic + clean
    odds = toxic * F.log(toxic / n / base) + F.coalesce(clean * F.log(F.nullif(clean, F.lit(0)) / n / (1 - base)), F.lit(0.0))
    return (toxic >= LEAST_CASES) & (toxic >= PRECISION * n) & (odds >= math.log(max(tried, 1)) + SURPRISE)


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """General insults, kept as far as the labels bear them out, and the terms that set toxic rows apart.

    Terms are found by the rows that have them and confirmed by the contexts they stand in, of which copies have the same.
    """
    rows, toxic = sample.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    words, beginnings = dict.fromkeys(INSULTS, GENERAL_ROWS / (GENERAL_ROWS + 1)), {}
    if not toxic or toxic == rows:
        return Lexicon(words, {})
    counts = materialize(term_rows(sample), "terms")
    tried = counts.count()
    listed = F.col("whole") & F.col("term").isin(INSULTS)
    order = [F.desc("toxic"), F.desc("whole"), F.length("term").desc(), "term"]
    frequent = counts.filter(telling(toxic / rows, 1)).orderBy(*order).collect()  # the sample bounds them
    for x in counts.filter(listed).collect():
        words[x.term] = (x.toxic + GENERAL_ROWS) / (x.toxic + x.clean + GENERAL_ROWS + 1)
    discard(counts)
    contexts = context_rows(sample, [(x.term, x.whole) for x in frequent])
    taken: list = []
    for x in contexts.filter(telling(toxic / rows, tried)).orderBy(*order).collect():
        # From frequent to rare; a term within or around a taken one must add contexts.
        related = [t for t in taken if x.term.startswith(t.term) and not t.whole or t.term.startswith(x.term) and not x.whole]
        if any(x.term.startswith(t.term) or x.toxic < 1.2 * t.toxic for t in related):
            continue
        taken.append(x)
        (words if x.whole else beginnings)[x.term] = (x.toxic + 1) / (x.toxic + x.clean + 2)
    return Lexicon(words, beginnings)


def prior_weights() -> np.ndarray:
    """The bias, each pattern's weight and that of the density before any label is seen."""
    weights = [-4.0]
    for p in PATTERNS:
        w = 4.5 if kind(p) == INSULT else 3.5
        weights.append(w + (0.5 if p & TARGETED else 0) - (1.5 if p & NEGATED else 0) - (1.5 if p & REPORTED else 0))
    return np.array([*weights, 0.5])


def probability(found: np.ndarray, weights: np.ndarray) -> np.ndarray:
    z = weights[0] + np.log1p(found) @ weights[1:] / math.log(2)
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_weights(found: np.ndarray, labels: np.ndarray, strength: float = 2.0, rounds: int = 25) -> np.ndarray:
    """Logistic regression by Newton steps, held near the prior weights."""
    prior = prior_weights()
    x = np.hstack([np.ones((len(found), 1)), np.log1p(found) / math.log(2)])
    w = prior.copy()
    for _ in range(rounds if len(found) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (labels - p) - strength * (w - prior)
        bend = (x * (p * (1 - p))[:, None]).T @ x + strength * np.eye(len(w))
        w = w + np.clip(np.linalg.solve(bend, slope), -2, 2)
    return w


def with_toxicity(df: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic", most: int = MOST_LABELLED, score_col: str = "score") -> DataFrame:
    """All rows and columns of ``df`` and ``score_col``, from 0 to 1; a column of that name is replaced.

    Lexicon and weights are learnt from up to ``most`` rows of ``labels`` where ``learn`` holds; without labels the general
    list and weights stand. Null and empty texts match no pattern and get the score of a clean text. Repeated rows get
    equal scores, an empty table gives an empty one.
    """
    sample = labelled_sample(df, labels, label, learn, most, id_col, text_col).select("text", "label")
    sample = materialize(sample, "labelled-texts")
    lexicon = learn_lexicon(sample)
    heads = lexicon.heads()

    def sample_evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = evidence(*flat(batch.column("text")), lexicon, heads)
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(found.tolist(), pa.list_(pa.float64()))], names=["label", "found"])

    # The sample is bounded, and so is what comes back of it.
    fitted = sample.mapInArrow(sample_evidence, "label int, found array<double>").collect()
    discard(sample)
    found = np.array([x.found for x in fitted]).reshape(-1, len(PATTERNS) + 1)
    weights = fit_weights(found, np.array([x.label for x in fitted], float))

    rows = df.drop(score_col)
    schema = StructType([*rows.schema.fields, StructField(score_col, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col, SLICE_BYTES):
                score = probability(evidence(*flat(part.column(text_col)), lexicon, heads), weights)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score)], names=schema.names)
        release()

    return rows.mapInArrow(run, schema)
