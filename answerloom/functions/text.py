"""Text cleaning as native column expressions.

Every step runs in the JVM and is linear in the length of the text. Whitespace always means what Python's
``str.isspace`` accepts, because that is what the prepared corpora are defined by.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The code points for which str.isspace() holds, without the line feed.
SPACES = (
    "\t\x0b\x0c\r\x1c\x1d\x1e\x1f \x85"
    "\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# The same set as the body of a Java character class, without and with the line feed.
BLANK_CLASS = "".join(f"\\x{{{ord(c):x}}}" for c in SPACES)
SPACE_CLASS = BLANK_CLASS + "\\n"

# Zero-width space, non-joiner, joiner and byte-order mark.
ZERO_WIDTH = "\u200b\u200c\u200d\ufeff"

# Math delimiters and what replaces them.
MATH_DELIMITERS = {"\\[": "$$", "\\]": "$$", "\\(": "$", "\\)": "$"}


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# Cleaning steps. Each names its argument several times, to test cheaply whether a text needs the work at all, so it
# must be given a plain column or a bound value.


def _nfc(t: Column) -> Column:
    composed = F.java_method(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), t, F.lit(False))
    return F.when(t.isNotNull(), composed)


def _strip_tags(t: Column) -> Column:
    # Only the part up to the last ">" can hold a tag. Searching no further keeps unmatched "<" from rescanning the
    # rest of the text each time.
    tail = F.substring_index(t, ">", -1)
    head = F.left(t, F.length(t) - F.length(tail))
    stripped = F.concat(F.regexp_replace(head, "<[^>]++>", " "), tail)
    return F.when(F.contains(t, F.lit("<")), stripped).otherwise(t)


def _replace_all(t: Column, pairs: dict[str, str]) -> Column:
    for old, new in pairs.items():
        t = F.replace(t, F.lit(old), F.lit(new))
    return t


def _newlines(t: Column) -> Column:
    return F.when(F.contains(t, F.lit("\r")), _replace_all(t, {"\r\n": "\n", "\r": "\n"})).otherwise(t)


def _rstrip_lines(t: Column) -> Column:
    return F.array_join(F.transform(F.split(t, "\n"), lambda line: F.rtrim(line, F.lit(SPACES))), "\n")


def _limit_blank_lines(t: Column) -> Column:
    return F.when(F.contains(t, F.lit("\n" * 4)), F.regexp_replace(t, "\n{4,}", "\n\n\n")).otherwise(t)


def _strip_start(t: Column) -> Column:
    return F.ltrim(t, F.lit(SPACES + "\n"))


def _strip_end(t: Column) -> Column:
    # Every line is stripped already, so only line feeds can be left at the end.
    return F.when(F.endswith(t, F.lit("\n")), F.rtrim(t, F.lit("\n"))).otherwise(t)


def _math(t: Column) -> Column:
    return F.when(F.contains(t, F.lit("\\")), _replace_all(t, MATH_DELIMITERS)).otherwise(t)


def _zero_width(t: Column) -> Column:
    # Looking for the bytes their encodings begin with takes two passes over the text instead of one per character.
    needed = F.lit(False)
    for lead in sorted({c.encode()[:2] for c in ZERO_WIDTH}):
        needed = needed | F.contains(t.cast("binary"), F.lit(lead))
    return F.when(needed, _replace_all(t, dict.fromkeys(ZERO_WIDTH, ""))).otherwise(t)


_LINES = (_rstrip_lines, _limit_blank_lines, _strip_start, _strip_end)
_MARKUP = (_math, _zero_width)
_CLEANING = (_nfc, _strip_tags, _newlines, *_LINES, *_MARKUP)


def _apply(text: Column, *steps: Callable[[Column], Column]) -> Column:
    for step in steps:
        text = bind(text, step)
    return text


def nfc(text: Column) -> Column:
    """Unicode NFC, through the ICU library Spark ships.

    Spark does not look into a Java method and takes it for non-deterministic, so an aggregate function or a join
    condition must be given the projected result.
    """
    return _apply(text, _nfc)


def strip_tags(text: Column) -> Column:
    """Replace every ``<...>`` by one space. Tags may span lines; entities stay as they are."""
    return _apply(text, _strip_tags)


def normalize_newlines(text: Column) -> Column:
    """CR LF and lone CR become LF."""
    return _apply(text, _newlines)


def collapse_blank_lines(text: Column) -> Column:
    """Right-strip each line, keep at most two blank lines in a row, strip both ends."""
    return _apply(text, *_LINES)


def normalize_math(text: Column) -> Column:
    r"""``\[ \]`` become ``$$`` and ``\( \)`` become ``$``; then zero-width characters are removed."""
    return _apply(text, *_MARKUP)


def clean_text(text: Column) -> Column:
    """All cleaning steps in order; null becomes the empty string. Project it before aggregating, see ``nfc``."""
    return F.coalesce(_apply(text, *_CLEANING), F.lit(""))


def with_cleaned(df: DataFrame, *names: str) -> DataFrame:
    """Replace the named string columns by their cleaned text; the fast form of ``clean_text``.

    One projection per step lets generated code hold each intermediate text in a variable. The generator at the end is
    a barrier: Catalyst moves later filters on the cleaned columns below projections, which would run the whole
    cleaning again inside the filter, but not below a generator.
    """
    columns = df.columns
    for step in _CLEANING:
        df = df.withColumns({n: step(F.col(n)) for n in names})
    cleaned = F.struct(*[F.coalesce(F.col(n), F.lit("")).alias(n) for n in names])
    others = [F.col(c) for c in columns if c not in names]
    return df.select(*others, F.inline(F.array(cleaned))).select(*columns)


def combined(question: Column, answer: Column) -> Column:
    """Question and answer joined without a separator."""
    return F.concat(question, answer)


def preview(text: Column, chars: int) -> Column:
    """The first ``chars`` characters, for reports."""
    return F.substring(text, 1, chars)


def single_spaced(text: Column, drop: str = "") -> Column:
    """Whitespace runs become one space, the ends are trimmed, and the characters in ``drop`` are removed."""
    spaced = F.translate(text, SPACES + "\n" + drop, " " * len(SPACES + "\n"))
    return F.trim(F.regexp_replace(spaced, " {2,}", " "))


def word_count(spaced: Column) -> Column:
    """Number of words of text that is already single-spaced."""

    def count(t: Column) -> Column:
        gaps = F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit("")))
        return F.when(t == "", 0).otherwise(gaps + 1)

    return bind(spaced, count)


def token_count(text: Column) -> Column:
    """Number of whitespace-separated tokens."""
    return word_count(single_spaced(text))
