"""Token counts: batch encoding in Arrow functions that return lengths only."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from plugsites.llm.chunks import chunk_encoder
from plugsites.llm.frames import id_and_text, portions

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    limit: int,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Bytes (UTF-8) and tokens of every whole text, and whether they exceed ``limit``.

    Counts are those of the tokenizers library with its defaults: special strings inside
    a text count as their token, none is added, nothing is cut or padded. Texts go to the
    library in portions of equal size, cut at safe boundaries, so neither a long text nor
    a batch of long texts makes a large call.

    One row per input row. A null text counts as empty: no bytes, no tokens. Null and
    repeated ids are carried through; an empty table gives no rows.
    """

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chunk_encoder(tokenizer_path, spaced=True)
        for batch in batches:
            for ids, texts in portions(batch):
                counts = encoder.lengths(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array([len(text.encode()) for text in texts], pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array([n > limit for n in counts], pa.bool_()),
                    ],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    return id_and_text(docs, id_column, text_column).mapInArrow(lengths, SCHEMA)
