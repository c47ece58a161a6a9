"""Token ids as binary files: segments of range-coded blocks in ascending document order.

The files are a Parquet table below a folder, one row per segment: the shard (a stretch
of the document order), the segment's number in it, an index of its documents and the
coded blocks of their ids. Segments hold whole documents, so any of them can be read
without the others; where its ids start is a running total over two small levels of sums.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plugsites.llm.chunks import chunk_encoder
from plugsites.llm.frames import id_and_text, portions
from plugsites.llm.range_coder import MOST_BLOCK_IDS, decode_blocks, encode_blocks

END_ID = b"\x00\x00\x00\x00"
#: A segment ends with the document that brings it to this many ids.
SEGMENT_IDS = 4_000_000
#: Shards whose totals are summed up together.
SHARD_GROUP = 1024

SEGMENTS = "shard int, segment int, n_ids long, doc_ids array<long>, n_tokens array<long>, blocks binary"
ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"


class _Segment:
    def __init__(self):
        self.doc_ids, self.lengths, self.ids, self.held = [], [], [], 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.doc_ids.append(doc_id)
        self.lengths.append(len(ids) // 4)
        self.ids.append(ids)
        self.held += len(ids) // 4

    def row(self, shard: int, number: int) -> pa.RecordBatch:
        ids = np.frombuffer(b"".join(self.ids), "<u4")
        longs = pa.list_(pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                pa.array([shard], pa.int32()),
                pa.array([number], pa.int32()),
                pa.array([len(ids)], pa.int64()),
                pa.array([self.doc_ids], longs),
                pa.array([self.lengths], longs),
                pa.array([encode_blocks(ids, MOST_BLOCK_IDS)], pa.binary()),
            ],
            ["shard", "segment", "n_ids", "doc_ids", "n_tokens", "blocks"],
        )


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    shards: int | None = None,
    segment_ids: int = SEGMENT_IDS,
) -> None:
    """Encode every whole text, add an end id 0, and write all ids in order of doc_id.

    ``shards`` defaults to the number of the input's partitions. A null text is empty and
    has the end id alone. Rows without an id come first; rows of one id are ordered by
    text. An empty table writes no segments.
    """
    slim = id_and_text(docs, id_column, text_column)
    order = [F.asc_nulls_first("doc_id"), F.asc("text")]
    n = shards or max(1, slim.rdd.getNumPartitions())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, segment = TaskContext.get().partitionId(), 0, _Segment()
        encoder = chunk_encoder(tokenizer_path, spaced=True)
        for batch in batches:
            for ids, texts in portions(batch):
                for doc_id, packed in zip(ids, encoder.encode(texts)):
                    segment.add(doc_id, packed + END_ID)
                    if segment.held >= segment_ids:
                        yield segment.row(shard, number)
                        number, segment = number + 1, _Segment()
        if segment.held:
            yield segment.row(shard, number)

    dealt = slim.repartitionByRange(n, order[0]).sortWithinPartitions(*order)
    dealt.mapInArrow(encode, SEGMENTS).write.parquet(path)


def _starts(segments: DataFrame) -> DataFrame:
    """(shard, segment, first): ids before each segment, by shard, group of shards and all."""
    group = F.floor(F.col("shard") / SHARD_GROUP).alias("group")
    shards = segments.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    shards = shards.select("shard", "n", group)
    groups = shards.groupBy("group").agg(F.sum("n").alias("n"))

    def before(value: str, by: str | None, order: str):
        window = Window.partitionBy(by if by else F.lit(0)).orderBy(order)
        window = window.rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(value).over(window), F.lit(0).cast("long"))

    of_groups = groups.select("group", before("n", None, "group").alias("in_all"))
    of_shards = shards.select("shard", "group", before("n", "group", "shard").alias("in_group"))
    of_shards = of_shards.join(of_groups, "group")
    slim = segments.select("shard", "segment", before("n_ids", "shard", "segment").alias("in_shard"))
    first = (F.col("in_all") + F.col("in_group") + F.col("in_shard")).alias("first")
    return slim.join(of_shards, "shard").select("shard", "segment", first)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Per document, from the files alone: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it; the checksum is that of its ids as
    little-endian unsigned 32-bit integers; ``with_ids`` adds them (array of int). A block
    whose checksum does not fit ends the job.
    """
    segments = spark.read.schema(SEGMENTS).parquet(path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("first", "doc_ids", "n_tokens", "blocks")
        for batch in batches:
            for at, doc_ids, lengths, blocks in zip(*(batch.column(name) for name in names)):
                ids = decode_blocks(blocks.as_py()).astype("<u4")
                lengths = np.array(lengths.as_py(), np.int64)
                ends = np.cumsum(lengths)
                parts = [ids[end - n : end] for end, n in zip(ends, lengths)]
                columns = [
                    pa.array(doc_ids.as_py(), pa.int64()),
                    pa.array(at.as_py() + ends - lengths, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array([zlib.crc32(part.tobytes()) for part in parts], pa.int64()),
                ]
                kept = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(parts, pa.list_(pa.int32())))
                    kept.append("ids")
                yield pa.RecordBatch.from_arrays(columns, kept)

    rows = segments.join(_starts(segments), ["shard", "segment"])
    rows = rows.select("first", "doc_ids", "n_tokens", "blocks")
    return rows.mapInArrow(decode, ROWS + (", ids array<int>" if with_ids else ""))
