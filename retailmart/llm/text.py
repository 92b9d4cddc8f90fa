"""Column helpers that several text operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: what separates words, and what words consist of
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def filled(text: str) -> Column:
    """A text column, NULL as the empty text."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text in order; none for a blank text."""
    return F.array_remove(F.split(text, BLANKS), "")
