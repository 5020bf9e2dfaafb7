"""Text columns.

``trim`` removes only the space character; tabs and newlines stay.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mdmspark.functions.constants import DESCRIPTION_MAX_CHARS


def clean_text(c: Column) -> Column:
    """Trimmed text."""
    return F.trim(c.cast("string"))


def upper_text(c: Column) -> Column:
    """Upper-cased trimmed text (card type, card brand, merchant state)."""
    return F.upper(F.trim(c.cast("string")))


def title_text(c: Column) -> Column:
    """Trimmed text with each word capitalised: 'FEMALE' -> 'Female'."""
    return F.initcap(F.trim(c.cast("string")))


def bounded_text(c: Column, max_chars: int = DESCRIPTION_MAX_CHARS) -> Column:
    """Trimmed text cut to its first ``max_chars`` characters."""
    return F.substring(F.trim(c.cast("string")), 1, max_chars)


def too_long(c: Column, max_chars: int = DESCRIPTION_MAX_CHARS) -> Column:
    """Trimmed text longer than ``max_chars`` (W8); NULL is not too long."""
    return F.coalesce(F.length(F.trim(c.cast("string"))) > max_chars, F.lit(False))


def is_blank(c: Column) -> Column:
    """NULL or only spaces."""
    return c.isNull() | (F.trim(c.cast("string")) == "")
