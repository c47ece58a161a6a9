"""Stage tables between steps, compaction, exports and run metrics.

Errors propagate: a step that could not write must not look finished.
"""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TARGET_FILE_BYTES = 256 * 1024 * 1024

#: The folder that owns the scratch tables made while it is set.
_OWNER: ContextVar[str | None] = ContextVar("owner", default=None)


def _scratch_base(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="plugsites-")
    return f"{base.rstrip('/')}/plugsites"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new, unused folder all executors can reach.

    It lies in the folder the session names in ``spark.checkpoint.dir``. Only a
    local session without that setting gets a temporary folder. Whoever works within
    ``scratch`` owns it; outside, it stays, as a lazy result may still read it.
    """
    return f"{_OWNER.get() or _scratch_base(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Folders that ``shared_folder`` gives within are removed at the end.

    For work whose results are stored elsewhere by then.
    """
    owner = f"{_scratch_base(spark)}/owned-{uuid.uuid4().hex}"
    before = _OWNER.set(owner)
    try:
        yield owner
    finally:
        _OWNER.reset(before)
        remove_folder(spark, owner)


def _file_system(spark: SparkSession, path: str):
    """The path and its file system, whichever kind the session has configured for it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder and what is in it; a missing one is fine."""
    place, files = _file_system(spark, path)
    files.delete(place, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, sorted; none if it is missing."""
    place, files = _file_system(spark, path)
    return sorted(one.getPath().getName() for one in files.listStatus(place)) if files.exists(place) else []


def write_stage(df: DataFrame, path: str, metrics: dict[str, Column] | None = None) -> dict:
    """Write Parquet, replacing what is there. Metrics are aggregates of what was stored.

    They read the columns they name, and counts of rows only the files' footers. Unlike
    numbers gathered while writing, they are exact when tasks fail and run again.
    """
    df.write.mode("overwrite").parquet(path)
    if not metrics:
        return {}
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    return stored.agg(*[metric.alias(name) for name, metric in metrics.items()]).first().asDict()


def write_csv(df: DataFrame, path: str, max_records_per_file: int = 0) -> None:
    """Interchange form of a stage: comma-separated UTF-8, a header in each file."""
    df.write.mode("overwrite").csv(
        path, header=True, encoding="UTF-8", **_records_per_file(max_records_per_file)
    )


def _records_per_file(limit: int) -> dict[str, int]:
    return {"maxRecordsPerFile": limit} if limit else {}


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Interchange form of a stage, every column text."""
    return spark.read.csv(path, header=True, encoding="UTF-8", multiLine=False)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files of a table; their contents are not read."""
    files = spark.read.format("binaryFile").load(path).select("length")
    return int(files.agg(F.sum("length")).first()[0] or 0)


def compact(
    spark: SparkSession, source: str, target: str, file_bytes: int = TARGET_FILE_BYTES
) -> int:
    """Rewrite a stage's fragments as few files; returns how many, 0 for an empty stage.

    One file while the stage is small, then as many as its size asks for, so that
    no task ever writes more than about ``file_bytes``.
    """
    stage = spark.read.parquet(source)
    if stage.isEmpty():
        return 0
    files = max(1, math.ceil(stored_bytes(spark, source) / file_bytes))
    stage.coalesce(files).write.mode("overwrite").parquet(target)
    return files


def export_csv(
    spark: SparkSession, source: str, target: str, file_bytes: int = TARGET_FILE_BYTES
) -> int:
    """As ``compact``, to comma-separated files."""
    stage = spark.read.parquet(source)
    if stage.isEmpty():
        return 0
    files = max(1, math.ceil(stored_bytes(spark, source) / file_bytes))
    write_csv(stage.coalesce(files), target)
    return files
