"""Registered queries over the driver tables, and their independent SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str


def all_queries() -> dict[str, Query]:
    from plugsites.catalog import areas, columns, feeds, files, rows

    return columns.QUERIES | rows.QUERIES | areas.QUERIES | files.QUERIES | feeds.QUERIES
