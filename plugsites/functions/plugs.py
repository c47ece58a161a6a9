"""Plug labels and charging powers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plugsites.functions.text import WHITE_SPACE, decimal_comma, number_text
from plugsites.schema import PLUG_LABELS, POWER_KW_RANGE


def plug_label(label: Column) -> Column:
    """Known label to its common name, any other label unchanged."""
    pairs = [F.lit(text) for pair in PLUG_LABELS.items() for text in pair]
    # No common name is itself a known label, so one lookup is enough.
    return F.coalesce(F.try_element_at(F.create_map(*pairs), label), label)


def plug_labels(labels: Column) -> Column:
    return F.transform(labels, plug_label)


def pack(columns: list[str], value: Callable[[Column], Column] = lambda column: column) -> Column:
    """Numbered columns to one list without its NULLs; an empty list if there are none.

    ``value`` is applied to each column before packing, where it compiles; inside a
    list it would be interpreted.
    """
    if not columns:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[value(F.col(f"`{name}`")) for name in columns]))


def plug_tokens(text: Column) -> Column:
    """``;``-separated plug text to a list of common names, first mention first."""
    parts = F.transform(
        F.split(F.coalesce(text, F.lit("")), ";"), lambda part: F.btrim(part, F.lit(WHITE_SPACE))
    )
    return F.array_distinct(plug_labels(F.filter(parts, lambda part: part != "")))


def plug_text(text: Column) -> Column:
    """As ``plug_tokens``, joined again; empty text where there is nothing."""
    return F.array_join(plug_tokens(text), "; ")


def plausible_power(text: Column) -> Column:
    """Power text to double if strictly inside the plausible range, else NULL."""
    low, high = POWER_KW_RANGE
    kw = decimal_comma(text)
    return F.when((kw > low) & (kw < high), kw)


def plausible_powers(texts: Column) -> Column:
    """Power texts to the doubles strictly inside the plausible range."""
    return F.array_compact(F.transform(texts, plausible_power))


def powers_text(powers: Column, sep: str = ",") -> Column:
    return F.array_join(F.transform(powers, number_text), sep)


def lists_as_text(df: DataFrame) -> DataFrame:
    """Plug and power lists to comma text, the form in which they leave the registry."""
    return df.withColumns(
        {
            "plug_types": F.array_join("plug_types", ","),
            "power_capacities_kw": powers_text(F.col("power_capacities_kw")),
        }
    )
