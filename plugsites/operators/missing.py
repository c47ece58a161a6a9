"""Fill missing values in place: no gate query, no second pass."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plugsites.functions.text import WHITE_SPACE, is_missing, whole_number
from plugsites.schema import MISSING_COUNT, UNKNOWN


def fill_text(column: Column, replacement: Column | None = None) -> Column:
    """Missing text becomes the replacement, or ``UNKNOWN`` if that is NULL too."""
    fallback = F.lit(UNKNOWN)
    filled = fallback if replacement is None else F.coalesce(replacement, fallback)
    return F.when(is_missing(column), filled).otherwise(column)


def fill_count(text: Column, unreadable_as_missing: bool = False) -> Column:
    """Missing count becomes 1. Unreadable text is NULL, or 1 if asked for."""
    number = whole_number(text)
    if unreadable_as_missing:
        return F.coalesce(number, F.lit(1))
    return F.when(is_missing(text, MISSING_COUNT), F.lit(1)).otherwise(number)


def stored(column: Column) -> Column:
    """Text as it comes out of a delimited file: trimmed, NULL if nothing is left."""
    return F.nullif(F.btrim(column, F.lit(WHITE_SPACE)), F.lit(""))


def known(column: Column) -> Column:
    """The inverse of ``fill_text``: a missing marker becomes NULL."""
    return F.when(~is_missing(column), column)
