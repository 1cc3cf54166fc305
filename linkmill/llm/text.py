"""Column expressions for texts that several operators share."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

#: space, tab, line feed, vertical tab, form feed, carriage return
SPACES = r"[\x20\x09-\x0D]+"
#: everything that is no part of a word, once A-Z are lower case
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def filled(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z in lower case and every other character as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def pieces(text: Column, between: str) -> Column:
    """The non-empty pieces of ``text`` between matches of ``between``; null has none."""
    return F.array_remove(F.split(filled(text), between), "")


def space_words(text: Column) -> Column:
    return pieces(text, SPACES)
