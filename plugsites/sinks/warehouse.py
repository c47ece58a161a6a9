"""Load exported files into a table, within a budget of unreadable records.

Each load is a version in a folder of its own. Readers see the version that the catalog
names, whole, until one change of the catalog names the next.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plugsites.schema import BAD_RECORD_BUDGET
from plugsites.sinks.stage import folder_names, remove_folder, shared_folder

RAW = "raw_record"


class TooManyBadRecords(ValueError):
    """The load was given up before the table was touched."""


def parse_with_budget(
    spark: SparkSession,
    pattern: str,
    schema: T.StructType,
    budget: int = BAD_RECORD_BUDGET,
    sep: str = ",",
) -> tuple[DataFrame, DataFrame]:
    """Good rows and bad records (``raw, file``) of the files, header lines skipped.

    The text is parsed once, into a stage; the count that decides reads one narrow
    column of it. Unlike a metric of the write it is exact when tasks are rerun.
    """
    marked = T.StructType([*schema.fields, T.StructField(RAW, T.StringType())])
    parsed = spark.read.schema(marked).csv(
        pattern,
        sep=sep,
        header=True,
        enforceSchema=True,
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=RAW,
    )
    stage = shared_folder(spark, "load")
    parsed.select("*", F.col("_metadata.file_path").alias("file")).write.parquet(stage)
    rows = spark.read.parquet(stage)
    bad = rows.where(F.col(RAW).isNotNull()).select(F.col(RAW).alias("raw"), "file")
    found = bad.count()
    if found > budget:
        raise TooManyBadRecords(f"{found} unreadable records, {budget} allowed")
    return rows.where(F.col(RAW).isNull()).select(*schema.names), bad


def load_table(
    spark: SparkSession,
    pattern: str,
    schema: T.StructType,
    table: str,
    budget: int = BAD_RECORD_BUDGET,
) -> DataFrame:
    """Replace ``table`` by the good rows; returns the bad records."""
    good, bad = parse_with_budget(spark, pattern, schema, budget)
    replace_table(good, table)
    return bad


def replace_table(rows: DataFrame, table: str) -> str:
    """Replace the table's rows; returns the folder of the new version.

    The rows are written first. If that fails, the table is as it was and what was written
    is removed. Then one catalog change makes them visible. A reader that has begun keeps
    the version it began with, which stays until the load after the next. A table whose
    columns differ is dropped and made anew, the only case with two catalog changes.
    """
    spark = rows.sparkSession
    versions = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table.lower()}.versions"
    version = f"v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    path = f"{versions}/{version}"
    try:
        rows.write.parquet(path)
    except BaseException:
        remove_folder(spark, path)
        raise
    known = spark.catalog.tableExists(table)
    if known and spark.table(table).schema.simpleString() == rows.schema.simpleString():
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    else:
        if known:
            spark.sql(f"DROP TABLE {table}")
        spark.catalog.createTable(table, path=path, source="parquet", schema=rows.schema)
    spark.catalog.refreshTable(table)
    # The version before this one may still be read; those before it go.
    older = [name for name in folder_names(spark, versions) if name < version]
    for name in older[:-1]:
        remove_folder(spark, f"{versions}/{name}")
    return path
