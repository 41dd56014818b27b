"""Answer metrics: normalised exact match, token F1, ROUGE-L and the step proxy."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from answerloom.functions.text import BLANK_CLASS, SPACE_CLASS, bind, single_spaced, word_count

# The ASCII punctuation characters.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# A word character as Python's re sees it.
WORD = r"[\p{L}\p{N}_]"
# Looking behind only where an article ends is cheaper than at every character.
ARTICLES = rf"(?:an?|the)(?!{WORD})(?<!{WORD}(?:a|an|the))"

# A numbered or bulleted item: first on its line, apart from blanks, and followed by whitespace.
ITEM = rf"(?md)^[{BLANK_CLASS}]*+(?:\p{{Nd}}++[.):]|[-\u2022*])[{SPACE_CLASS}]"

# What counts as visible working, with a string it cannot do without, and how often one kind must occur.
STEP_PATTERNS = (
    (r"\$\$[^$]+\$\$", "$$"),
    (r"\$[^$]+\$", "$"),
    (ITEM, ""),
    (rf"(?iu)step[{SPACE_CLASS}]*+\p{{Nd}}+|first[,.]|second[,.]|third[,.]|finally[,.]", ""),
    (r"\\frac|\\sqrt|\\sum|\\int|\\cdot", "\\"),
)
MIN_STEPS = 3


def normalize_answer(text: Column) -> Column:
    """Lower-case, drop articles, drop ASCII punctuation, collapse whitespace (in this order)."""
    return single_spaced(F.regexp_replace(F.lower(text), ARTICLES, " "), drop=PUNCTUATION)


def exact_match(prediction: Column, reference: Column) -> Column:
    """1 when both normalised texts are equal; a missing one equals nothing and scores 0. Takes normalised text."""
    return F.coalesce((prediction == reference).cast("int"), F.lit(0))


def token_f1(prediction: Column, reference: Column) -> Column:
    """F1 of distinct common tokens over both token counts. Takes normalised text."""
    common = F.size(F.array_intersect(F.split(prediction, " "), F.split(reference, " ")))
    counts = F.struct(
        common.alias("common"), word_count(prediction).alias("predicted"), word_count(reference).alias("expected")
    )

    def f1(n: Column) -> Column:
        precision, recall = n["common"] / n["predicted"], n["common"] / n["expected"]
        some = (n["common"] > 0) & (n["predicted"] > 0) & (n["expected"] > 0)
        return F.when(some, 2.0 * precision * recall / (precision + recall)).otherwise(F.lit(0.0))

    return bind(counts, f1)


def rouge_text(text: Column) -> Column:
    """Lower-case runs of ASCII letters and digits, joined by single spaces."""
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]++", " "))


def _lcs_tokens():
    """The function of two token lists that gives the length of their longest common subsequence.

    Where few places match, as in long texts of many words, matches are taken one by one: of all common subsequences of some
    length, only the least end in the shorter text is kept (Hunt and Szymanski). Where many match, all places of the shorter text
    are held as bits of one number (Hyyrö). The number of matches, counted first, decides; either takes memory in proportion to the
    texts. Defined in here, it travels to Python workers by value, so they need not have this package installed.
    """
    from bisect import bisect_left

    def sparse(where: dict[str, list[int]], b: list[str]) -> int:
        ends: list[int] = []
        for token in b:
            for i in reversed(where[token]):
                k = bisect_left(ends, i)
                if k == len(ends):
                    ends.append(i)
                else:
                    ends[k] = i
        return len(ends)

    def dense(where: dict[str, list[int]], b: list[str], size: int) -> int:
        def bits(places: list[int]) -> int:
            held = bytearray(size // 8 + 1)
            for i in places:
                held[i >> 3] |= 1 << (i & 7)
            return int.from_bytes(held, "little")

        # Numbers of the frequent tokens are kept, some 2,000 at most.
        kept = {token: bits(places) for token, places in where.items() if len(places) > size // 2000}
        full = (1 << size) - 1
        free = full
        for token in b:
            step = free & (kept[token] if token in kept else bits(where[token]))
            free = ((free + step) | (free - step)) & full
        return size - free.bit_count()

    def lcs_tokens(left: str, right: str) -> int:
        a, b = left.split(), right.split()
        if len(a) > len(b):
            a, b = b, a
        same = 0
        while same < len(a) and a[same] == b[same]:
            same += 1
        a, b, tail = a[same:], b[same:], 0
        while tail < len(a) and a[-1 - tail] == b[-1 - tail]:
            tail += 1
        if tail:
            a, b = a[:-tail], b[:-tail]
        where: dict[str, list[int]] = {}
        for i, token in enumerate(a):
            where.setdefault(token, []).append(i)
        b = [token for token in b if token in where]
        matches = sum(len(where[token]) for token in b)
        # A match costs about what 3,000 bits do, and a step over bits some fixed time besides.
        few = matches * 5 <= len(b) * (6 + len(a) // 600)
        return same + tail + (sparse(where, b) if few else dense(where, b, len(a)))

    return lcs_tokens


def _lcs_function():
    lcs_tokens = _lcs_tokens()

    def lcs(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([0 if x is None or y is None else lcs_tokens(x, y) for x, y in zip(left, right)], dtype="int64")

    return F.pandas_udf(lcs, "long")


def lcs_length(left: Column, right: Column) -> Column:
    """Length of the longest common subsequence of space-separated tokens (bit-parallel or by matches, Arrow batches)."""
    return _lcs_function()(left, right)


def rouge_l(prediction: Column, reference: Column) -> Column:
    """ROUGE-L F-measure, 0 when either side has no token. Takes ``rouge_text`` output."""
    total = word_count(prediction) + word_count(reference)
    return F.coalesce(2.0 * lcs_length(prediction, reference) / F.nullif(total, F.lit(0)), F.lit(0.0))


def step_proxy(text: Column) -> Column:
    """1 when any one of the working patterns occurs at least three times."""
    found = F.lit(False)
    for pattern, sign in STEP_PATTERNS:
        found = found | (F.contains(text, F.lit(sign)) & (F.regexp_count(text, F.lit(pattern)) >= MIN_STEPS))
    return F.coalesce(found, F.lit(False)).cast("int")


def register(spark: SparkSession) -> None:
    """Make ``nfc`` and ``lcs_length`` callable from SQL text of this session."""
    spark.udf.register("lcs_length", _lcs_function())
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION nfc(t STRING) RETURNS STRING RETURN "
        "CASE WHEN t IS NOT NULL THEN java_method('com.ibm.icu.text.Normalizer', 'compose', t, false) END"
    )
