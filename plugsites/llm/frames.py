"""Small helpers that the corpus operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plugsites.sinks.stage import shared_folder

#: Texts are handled in portions of about this many characters, whatever a batch holds.
PORTION_CHARS = 4_000_000
#: Tables of a few short columns are broadcast up to so many rows.
BROADCAST_ROWS = 100_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def id_and_text(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Only the two columns an operator needs, renamed; a null text is empty.

    Other columns stay behind, so none of them can clash with what is added later.
    """
    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows, written below the shared folder and read again: lineage ends here."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def of_checked_size(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The rows, stored and counted: to be broadcast if there are at most so many, else to
    be joined by a shuffle. For rows of a few short columns."""
    stored = staged(df, "small")
    return F.broadcast(stored) if stored.count() <= rows else stored


def release_memory() -> None:
    """What Arrow keeps for later goes back to the system: a worker outlives its task, and
    other stages need the memory."""
    pa.default_memory_pool().release_unused()


def portions(batch: pa.RecordBatch, chars: int = PORTION_CHARS) -> Iterator[tuple[list, list]]:
    """(ids, texts) of a batch, cut by the size of the texts; a row is never cut."""
    ids, texts, held = [], [], 0
    for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
        if texts and held + len(text) > chars:
            yield ids, texts
            ids, texts, held = [], [], 0
        ids.append(key)
        texts.append(text)
        held += len(text)
    if texts:
        yield ids, texts
