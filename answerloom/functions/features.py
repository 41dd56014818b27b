"""Math-markup features of a text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dollar_count(text: Column) -> Column:
    """How many ``$`` the text holds."""
    return F.length(text) - F.length(F.replace(text, F.lit("$"), F.lit("")))


def has_display_math(text: Column) -> Column:
    """Whether the text holds ``$$``."""
    return F.contains(text, F.lit("$$"))
