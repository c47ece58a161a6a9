"""Byte-level BPE as a monoid: texts are encoded in halves and joined up a tree.

An element is (text, ids). The product re-encodes a window around the seam and keeps the
ids outside it. A window is wide enough when both its ends are at safe boundaries: one
space between two characters that are not white space. The split before the merges never
reaches over such a space (the space opens the part that follows, and what stands before
it was decided by characters up to it), so the ids on either side of it do not depend on
the text beyond it. Windows double until they reach one, or the end of the element.
Decoding concatenates bytes up the same tree.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame

from plugsites.llm.frames import id_and_text, portions
from plugsites.llm.vocabularies import rank_encoder

LEAF_CHARS = 4096
FIRST_WINDOW = 32
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _safe(text: str, at: int) -> bool:
    return (
        0 < at < len(text) - 1
        and text[at] == " "
        and not text[at - 1].isspace()
        and not text[at + 1].isspace()
    )


def _last_safe(text: str) -> int:
    """Start of the left part of a window: the last safe boundary, 0 if there is none."""
    low, window = len(text), FIRST_WINDOW
    while low > 0:
        high, low = low, max(0, len(text) - window)
        at = text.rfind(" ", low, high)
        while at >= 0:
            if _safe(text, at):
                return at
            at = text.rfind(" ", low, at)
        window *= 2
    return 0


def _first_safe(text: str) -> int:
    """End of the right part of a window: the first safe boundary, else the text's end."""
    high, window = 0, FIRST_WINDOW
    while high < len(text):
        low, high = high, min(len(text), window)
        at = text.find(" ", low, high)
        while at >= 0:
            if _safe(text, at):
                return at
            at = text.find(" ", at + 1, high)
        window *= 2
    return len(text)


class TreeEncoder:
    """Encodes with a rank encoder at the leaves and seam windows at the joins."""

    def __init__(self, leaf_encode, leaf_decode, leaf_chars: int = LEAF_CHARS):
        self.leaf_encode, self.leaf_decode = leaf_encode, leaf_decode
        self.leaf_chars = leaf_chars

    def encode(self, text: str) -> list[int]:
        if len(text) <= self.leaf_chars:
            return self.leaf_encode(text)
        middle = len(text) // 2
        left, right = text[:middle], text[middle:]
        return self.join(left, self.encode(left), right, self.encode(right))

    def join(self, left: str, left_ids: list[int], right: str, right_ids: list[int]) -> list[int]:
        """The product of two elements; either may be empty."""
        if not left or not right:
            return left_ids + right_ids
        start, end = _last_safe(left), _first_safe(right)
        tail, head = left[start:], right[:end]
        keep = len(left_ids) - len(self.leaf_encode(tail)) if start else 0
        drop = len(self.leaf_encode(head)) if end < len(right) else len(right_ids)
        return left_ids[:keep] + self.leaf_encode(tail + head) + right_ids[drop:]

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= self.leaf_chars:
            return self.leaf_decode(ids)
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


def encode_and_decode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    leaf_chars: int = LEAF_CHARS,
    keep_ids: bool = False,
) -> DataFrame:
    """Ids of every whole text and the digest of their decoding.

    Columns: doc_id, n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256,
    and with ``keep_ids`` also ids (array of int) and decoded (binary).

    One row per input row. A null text is empty: no ids, digests of the empty string.
    Null and repeated ids are carried through; an empty table gives no rows.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = rank_encoder(ranks_path, pattern)
        tree = TreeEncoder(ranks.encode_ordinary, ranks.decode_bytes, leaf_chars)
        for batch in batches:
            for ids, texts in portions(batch):
                tokens = [tree.encode(text) for text in texts]
                decoded = [tree.decode(one) for one in tokens]
                columns = [
                    pa.array(ids, pa.int64()),
                    pa.array(map(len, tokens), pa.int64()),
                    pa.array(
                        sha256(",".join(map(str, one)).encode()).hexdigest() for one in tokens
                    ),
                    pa.array(sha256(one).hexdigest() for one in decoded),
                ]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    columns += [pa.array(tokens, pa.list_(pa.int32())), pa.array(decoded)]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = SCHEMA + (", ids array<int>, decoded binary" if keep_ids else "")
    return id_and_text(docs, id_column, text_column).mapInArrow(encode, schema)
