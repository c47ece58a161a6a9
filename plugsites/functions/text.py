"""Text clean-up and the conversions that turn dirty text into typed values.

Spark 4 raises on a bad cast, so every conversion here is a ``try_`` form or is
gated by a pattern: unreadable text becomes NULL, never a failed job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plugsites.schema import MISSING_TEXT


WHITE_SPACE = " \t\r\n\x0b\f"


@dataclass(frozen=True)
class TextRule:
    """How one feed cleans its text."""

    newline: str = ""
    """What a line feed becomes."""
    collapse: bool = True
    """Turn every run of backslashes and white space into one space."""


def clean_text(column: Column, rule: TextRule) -> Column:
    # Backslash runs become a space and space runs become one space, so a mixed
    # run ends as one space: a single pattern does both in one pass. It leaves
    # out single spaces, by far the most frequent runs, as they stay as they are.
    if not rule.collapse:
        return F.replace(column, F.lit("\n"), F.lit(rule.newline))
    if rule.newline == "":
        column = F.replace(column, F.lit("\n"), F.lit(""))
    return F.regexp_replace(column, r"[\s\\]{2,}|[\s\\&&[^ ]]", " ")


def clean_all_text(df: DataFrame, rule: TextRule, keep: tuple[str, ...] = ()) -> DataFrame:
    """Clean every text column, and every text in a list column, but for ``keep``."""
    texts = T.ArrayType(T.StringType())
    cleaned = {}
    for field in df.schema.fields:
        if field.name in keep:
            continue
        if isinstance(field.dataType, T.StringType):
            cleaned[field.name] = clean_text(F.col(f"`{field.name}`"), rule)
        elif field.dataType.simpleString() == texts.simpleString():
            cleaned[field.name] = F.transform(
                F.col(f"`{field.name}`"), lambda item: clean_text(item, rule)
            )
    return df.withColumns(cleaned) if cleaned else df


def decimal_comma(column: Column) -> Column:
    """``52,5200`` or ``52.5200`` to double."""
    return F.replace(column, F.lit(","), F.lit(".")).try_cast("double")


def whole_number(column: Column) -> Column:
    """Integer text to int; a fraction is cut off, anything else is NULL."""
    return F.regexp_extract(F.btrim(column, F.lit(WHITE_SPACE)), r"^([+-]?\d+)(\.\d*)?$", 1).try_cast("int")


def safe_cast(df: DataFrame, target: dict[str, str]) -> DataFrame:
    """Cast several columns in one projection; values that do not fit become NULL."""
    return df.withColumns(
        {
            name: whole_number(F.col(name))
            if kind == "int" and isinstance(df.schema[name].dataType, T.StringType)
            else F.col(name).try_cast(kind)
            for name, kind in target.items()
        }
    )


def coordinate_part(column: Column, index: int) -> Column:
    """One number out of ``"lat, lon"`` text; NULL where that part is not there."""
    return F.trim(F.get(F.split(column, ","), index)).try_cast("double")


def parse_date(column: Column) -> Column:
    """ISO date, ISO timestamp (its date part) or ``dd.MM.yyyy`` to date.

    Written with patterns and a cast instead of date formats: a failing format
    throws and catches an exception for each row, a failing cast does not.
    """
    iso = F.regexp_replace(F.btrim(column, F.lit(WHITE_SPACE)), r"^(\d{2})\.(\d{2})\.(\d{4})$", "$3-$2-$1")
    return F.when(
        iso.rlike(r"^\d{4}-\d{2}-\d{2}([T ].*)?$"), F.substring(iso, 1, 10).try_cast("date")
    )


def postal_code(column: Column, numeric_only: bool) -> Column:
    """Five-digit postal code with its leading zeros.

    Feeds that hold numbers lose any other text; the rest keep it.
    """
    text = F.btrim(column, F.lit(WHITE_SPACE))
    if numeric_only:
        text = whole_number(column).cast("string")
    return F.when(text.rlike(r"^\d{1,4}$"), F.lpad(text, 5, "0")).otherwise(text)


def is_missing(column: Column, markers: tuple[str, ...] = MISSING_TEXT) -> Column:
    """NULL or one of the texts that stand for it."""
    return column.isNull() | column.isin(*markers)


def number_text(column: Column) -> Column:
    """Double to text without a trailing ``.0``."""
    return F.regexp_replace(column.cast("string"), r"\.0$", "")
