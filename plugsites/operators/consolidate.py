"""One row per site: first within each feed, then across feeds.

Every aggregate here combines before the shuffle, so a site that holds a large
part of all rows reaches its reducer as one row per task, and lists meet as
their distinct elements.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plugsites.functions.plugs import powers_text
from plugsites.operators.missing import known, stored
from plugsites.schema import CANONICAL, LEVEL_COLUMNS, SITE_KEY, UNKNOWN


def site_first(
    df: DataFrame, order: list[str], keys: tuple[str, ...] = SITE_KEY
) -> DataFrame:
    """The first row of each site by ``order``, all its values from that one row.

    The minimum of (order, values): rows that tie on the order key are told apart
    by their values, so the result never depends on partitioning.
    """
    values = [name for name in df.columns if name not in keys and name not in order]
    first = F.min(F.struct(*order, *values)).alias("first")
    return df.groupBy(*keys).agg(first).select(*keys, "first.*").select(*df.columns)


def first_non_null(column: Column, order: list[str]) -> Column:
    """Aggregate: the value of the first row by ``order`` that has one."""
    return F.min(F.when(column.isNotNull(), F.struct(*order, column.alias("value"))))["value"]


def latest_date(column: Column) -> Column:
    return F.max(column)


def total_points(column: Column) -> Column:
    return F.sum(column.cast("bigint"))


def max_capacity(column: Column) -> Column:
    return F.max(column)


def distinct_tokens(df: DataFrame, keys: list[str], lists: list[str]) -> DataFrame:
    """One row per key: all different elements of each list column, sorted.

    Elements are reduced to one of each per key before and in the first exchange, which
    deals a key's elements over all tasks. What then comes together for a key are its
    different elements alone, however many rows or different lists it has. A key without
    any element has empty lists; NULL elements are left out.
    """
    elements = F.flatten(
        F.array(
            *[
                F.transform(
                    F.coalesce(F.col(name), F.array().cast(df.schema[name].dataType)),
                    partial(_element, place, df.schema, lists),
                )
                for place, name in enumerate(lists)
            ]
        )
    )
    once = df.select(*keys, F.explode_outer(elements).alias("element")).distinct()
    return once.groupBy(*keys).agg(
        *[
            F.array_sort(
                F.array_compact(F.collect_list(F.col("element")[name]))
            ).alias(name)
            for name in lists
        ]
    )


def _element(place: int, schema: T.StructType, lists: list[str], value: Column) -> Column:
    """A list's element beside NULLs for the other lists, so that all have one type."""
    return F.struct(
        *[
            (value if n == place else F.lit(None).cast(schema[name].dataType.elementType)).alias(name)
            for n, name in enumerate(lists)
        ]
    )


def merged_tokens(lists: Column) -> Column:
    """Aggregate: all different elements, sorted, of the few lists of one key.

    For rows that are one per feed and site already; ``distinct_tokens`` is for any rows.
    """
    return F.array_sort(F.array_distinct(F.flatten(F.collect_list(lists))))


def consolidate(stations: DataFrame, order: list[str]) -> DataFrame:
    """Merge the feeds' site rows, one per feed and site, into the consolidated table.

    Text columns take the first value in feed order that is more than white space.
    Area columns pass over missing markers, too: a failed lookup in one feed does
    not hide the area another feed knows.
    """
    aggregates: dict[str, Column] = {
        "commissioning_date": latest_date(F.col("commissioning_date")),
        "number_of_charging_points": total_points(F.col("number_of_charging_points")),
        "power_connection_capacity": max_capacity(F.col("power_connection_capacity")),
        "plug_types": F.array_join(merged_tokens(F.col("plug_types")), ","),
        "power_capacities_kw": powers_text(merged_tokens(F.col("power_capacities_kw"))),
    }
    areas = set(LEVEL_COLUMNS.values())
    for name in CANONICAL.names:
        if name in SITE_KEY or name in aggregates:
            continue
        if name in areas:
            aggregates[name] = F.coalesce(
                first_non_null(known(stored(F.col(name))), order), F.lit(UNKNOWN)
            )
        else:
            aggregates[name] = first_non_null(stored(F.col(name)), order)
    merged = stations.groupBy(*SITE_KEY).agg(
        *[aggregate.alias(name) for name, aggregate in aggregates.items()]
    )
    return merged.select(*CANONICAL.names)
