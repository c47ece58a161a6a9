"""Bring differently shaped tables to the canonical columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plugsites.schema import CANONICAL, PLACEHOLDER


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """Drop rows in which every column is NULL."""
    return df.na.drop(how="all")


def rename_and_drop(
    df: DataFrame,
    renames: dict[str, str],
    drops: tuple[str, ...] = (),
    placeholders: tuple[str, ...] = (),
) -> DataFrame:
    """Drop, rename and add placeholder columns; names that are absent are ignored."""
    df = df.drop(*drops).withColumnsRenamed(renames)
    if placeholders:
        df = df.withColumns({name: F.lit(PLACEHOLDER) for name in placeholders})
    return df


def align_schema(
    df: DataFrame, schema: T.StructType = CANONICAL, extra: tuple[str, ...] = ()
) -> DataFrame:
    """The schema's columns in its order, typed NULLs where a column is absent."""
    types = {field.name: field.dataType for field in df.schema.fields}

    def aligned(field: T.StructField) -> Column | str:
        if types.get(field.name) == field.dataType:
            return field.name
        value = F.col(field.name) if field.name in types else F.lit(None)
        return value.cast(field.dataType).alias(field.name)

    return df.select(*[aligned(field) for field in schema.fields], *extra)


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by name. One node for all inputs, so each is scanned once."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)
