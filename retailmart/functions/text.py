"""Cleaning of text columns.

Four rules look alike and differ on NULL and blank input:

==================  ======  =======
function            NULL    blank
==================  ======  =======
``clean``           NULL    ``''``
``email``           NULL    ``''``
``blank_to_null``   NULL    NULL
``or_unknown``      Unknown ``''``
==================  ======  =======
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean(name: str) -> Column:
    """Strip spaces at both ends (spaces only: tabs stay)."""
    return F.trim(F.col(name))


def email(name: str) -> Column:
    """Lower-cased, stripped address: the natural key of people and suppliers."""
    return F.trim(F.lower(F.col(name)))


def blank_to_null(name: str) -> Column:
    """Stripped text, with blank text turned to NULL."""
    return F.nullif(F.trim(F.col(name)), F.lit(""))


def or_unknown(name: str) -> Column:
    """Stripped text, NULL replaced by ``Unknown``; blank text stays blank."""
    return F.coalesce(F.trim(F.col(name)), F.lit("Unknown"))


def not_blank(name: str) -> Column:
    """Filter on text that is neither NULL nor blank (NULL compares to NULL and drops)."""
    return F.trim(F.col(name)) != ""


def full_name(first: str, last: str) -> Column:
    """``first last``; NULL when either part is NULL, as SQL ``||`` gives."""
    return F.concat(F.col(first), F.lit(" "), F.col(last))
