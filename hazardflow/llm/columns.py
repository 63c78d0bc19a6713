"""Column expressions shared by the operators: ASCII lower-casing and the word split.

A word is a longest run of characters outside the separators, after lower-casing A-Z only
(``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``): digits, a-z and every non-ASCII character belong to words.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: Separators in text that is lower-cased already, and in raw text (where A-Z are word characters).
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RAW_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lower_ascii(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


def text_of(col: Column) -> Column:
    """Null counts as empty text."""
    return F.coalesce(col.cast("string"), F.lit(""))


def words(col: Column) -> Column:
    """Array of lower-cased words of the whole text; empty for null."""
    return F.array_remove(F.split(lower_ascii(text_of(col)), SEPARATORS), "")


def word_count(col: Column) -> Column:
    """Number of words, without building lower-cased copies."""
    return F.size(F.array_remove(F.split(text_of(col), RAW_SEPARATORS), "")).cast("long")
