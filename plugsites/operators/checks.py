"""Plausibility checks and the accept / reject split.

All checks of a row are evaluated in one projection into a list of reasons. Both
sides of the split read that list, so no check needs a second scan, an anti join
or a count of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plugsites.schema import (
    FIRST_YEAR,
    LATITUDE_RANGE,
    LONGITUDE_RANGE,
    POINTS_RANGE,
    REASON_BBOX,
    REASON_COUNT,
    REASON_NO_COORDINATES,
    REASON_YEAR,
    REASONS,
)

VIOLATIONS = "violations"


def outside_box(latitude: Column, longitude: Column) -> Column:
    """Outside the country's box. NULL, so not true, where nothing can be said."""
    return (
        (latitude < LATITUDE_RANGE[0])
        | (latitude > LATITUDE_RANGE[1])
        | (longitude < LONGITUDE_RANGE[0])
        | (longitude > LONGITUDE_RANGE[1])
    )


def implausible_year(date: Column, last_year: int | Column) -> Column:
    """Commissioned before the first or after the last plausible year."""
    return (F.year(date) < FIRST_YEAR) | (F.year(date) > last_year)


def implausible_count(count: Column) -> Column:
    return (count < POINTS_RANGE[0]) | (count > POINTS_RANGE[1])


def violations(last_year: int | Column) -> Column:
    """Reasons to set a canonical row aside; an empty list for a good row."""
    latitude, longitude = F.col("latitude"), F.col("longitude")
    found = {
        REASON_BBOX: outside_box(latitude, longitude),
        REASON_YEAR: implausible_year(F.col("commissioning_date"), last_year),
        REASON_COUNT: implausible_count(F.col("number_of_charging_points")),
        REASON_NO_COORDINATES: latitude.isNull() | longitude.isNull(),
    }
    # Blanks instead of NULLs: removing a value compiles, a lambda would not.
    reasons = [F.when(bad, reason).otherwise("") for reason, bad in found.items()]
    return F.array_remove(F.array(*reasons), "")


def check(df: DataFrame, last_year: int | Column) -> DataFrame:
    return df.withColumn(VIOLATIONS, violations(last_year))


def with_reason(checked: DataFrame) -> DataFrame:
    """One row for each violation with its ``reason``, one with NULL for a good row.

    A filter on the list itself would be moved in front of the projection that
    computes it, and every conversion and check would be evaluated twice. A filter
    on an exploded column stays behind.
    """
    return checked.withColumn("reason", F.explode_outer(VIOLATIONS)).drop(VIOLATIONS)


def good_rows(checked: DataFrame) -> DataFrame:
    """Rows without a violation; duplicates are kept."""
    return with_reason(checked).where(F.col("reason").isNull()).drop("reason")


def accepted(checked: DataFrame, row_key: str | None = None) -> DataFrame:
    """Rows without a violation, equal rows once.

    With ``row_key``, rows are equal if all other columns are, and the smallest
    key stands for them. Either way duplicates collapse before the shuffle, so a
    row that is repeated very often costs one row per task.
    """
    clean = good_rows(checked)
    if row_key is None:
        return clean.distinct()
    rest = [name for name in clean.columns if name != row_key]
    return clean.groupBy(*rest).agg(F.min(row_key).alias(row_key))


def rejected(checked: DataFrame) -> DataFrame:
    """One row for each violation, with its ``reason``; duplicates are kept."""
    return with_reason(checked).where(F.col("reason").isNotNull())


def reason_counters() -> dict[str, Column]:
    """Aggregates by reason: usable as metrics of a write, too."""
    return {reason: F.count_if(F.array_contains(VIOLATIONS, reason)) for reason in REASONS}


def anomaly_counts(checked: DataFrame) -> DataFrame:
    """Violations per reason: one row of counters per task, whatever was found."""
    counters = checked.agg(*[counter.alias(reason) for reason, counter in reason_counters().items()])
    per_reason = F.array(
        *[F.struct(F.lit(reason).alias("reason"), F.col(reason).alias("rows")) for reason in REASONS]
    )
    return counters.select(F.inline(per_reason)).where(F.col("rows") > 0)
