"""Small numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Fixed value: a decimal number.
NUMBER = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def int_or_zero(text: Column) -> Column:
    """The integer a metadata string holds, its fraction cut off; 0 when it is null, not a number or too large.

    Exponents count (``1e3`` is 1000); words that only some readers take for numbers, like ``NaN`` or ``1d``, do not.
    """
    plain = F.when(text.cast("string").rlike(NUMBER), text.cast("string"))
    value = F.trim(plain).try_cast("double")
    return F.coalesce(F.when(F.abs(value) < 2.0**31, value.cast("int")), F.lit(0))


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole``, 0 when ``whole`` is 0."""
    return F.coalesce(100.0 * part / F.nullif(whole, F.lit(0).cast("long")), F.lit(0.0))


def thousands(number: Column, decimals: int = 0) -> Column:
    """A number with thousands separators, for reports."""
    return F.format_number(number, decimals)


def hash_bucket(key: Column, buckets: Column | int, salt: str = "") -> Column:
    """A bucket in ``[0, buckets)`` fixed by the key's text alone: the first 32 bits of md5(salt + key)."""
    head = F.substring(F.md5(F.concat(F.lit(salt), key.cast("string"))), 1, 8)
    return F.conv(head, 16, 10).cast("long") % buckets
