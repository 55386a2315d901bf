"""Text to typed values, NULL when the text does not stand for one.

Spark reads more than a warehouse does: a bare time becomes that time today, ``2026`` the first of
January, and Java's number suffixes and hexadecimal digits pass as doubles. Such text is refused.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

# Words that stand for a double.
DOUBLE_WORDS = ("nan", "inf", "+inf", "-inf", "infinity", "+infinity", "-infinity")


def to_instant(text: Column) -> Column:
    """An instant from text that starts with a full date; UTC unless the text names a zone."""
    def dash(position: int) -> Column:
        return F.substring(text, position, 1) == "-"

    return F.when(dash(5) & (dash(8) | dash(7)), text.try_cast("timestamp"))


def to_double(text: Column) -> Column:
    letters = reduce(or_, [text.contains(letter) for letter in "fFdDxX"])
    return F.when(~letters | F.lower(F.trim(text)).isin(*DOUBLE_WORDS), text.try_cast("double"))


def to_type(text: Column, type_name: str) -> Column:
    if type_name == "string":
        return text
    if type_name == "timestamp":
        return to_instant(text)
    if type_name == "double":
        return to_double(text)
    return text.try_cast(type_name)
