"""Document fingerprints: a homomorphic multiset hash of paragraphs.

Every paragraph is hashed to a wide vector; a document's fingerprint is the sum of its
paragraphs' vectors, lane by lane modulo a power of two. The order of paragraphs does not
matter, and a paragraph is inserted or deleted by adding or subtracting its vector.

A fingerprint has two parts. Eight lanes modulo 2^64 decide equality. 256 lanes modulo
2^16, each +1 or -1 per paragraph, measure likeness: the mean square of the difference of
two such sums estimates the squared distance of the two multisets.
"""

from __future__ import annotations

import re
from base64 import b64decode, b64encode
from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plugsites.llm.frames import portions

WIDE_LANES = 8
SIGN_LANES = 256
#: A paragraph ends at a line feed or, so that unbroken text has some too, at a sentence end.
PARAGRAPH = re.compile(r"\n|(?<=[.!?]) ")

SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def paragraphs(text: str) -> list[str]:
    return [part for part in PARAGRAPH.split(text) if part]


class Multiset:
    """Lanes of one or many documents (first axis), added and subtracted modulo powers."""

    def __init__(self, wide: np.ndarray, signs: np.ndarray):
        self.wide, self.signs = wide, signs

    def __add__(self, other: Multiset) -> Multiset:
        return Multiset(self.wide + other.wide, self.signs + other.signs)

    def __sub__(self, other: Multiset) -> Multiset:
        return Multiset(self.wide - other.wide, self.signs - other.signs)

    def strings(self) -> list[str]:
        """Equality lanes as hexadecimal, a colon, likeness lanes as base64."""
        return [
            f"{wide.tobytes().hex()}:{b64encode(signs.tobytes()).decode()}"
            for wide, signs in zip(self.wide.astype("<u8"), self.signs.astype("<u2"))
        ]

    @staticmethod
    def read(strings: list[str]) -> Multiset:
        halves = [one.split(":") for one in strings]
        wide = b"".join(bytes.fromhex(one) for one, _ in halves)
        signs = b"".join(b64decode(one) for _, one in halves)
        return Multiset(
            np.frombuffer(wide, "<u8").reshape(-1, WIDE_LANES).astype(np.uint64),
            np.frombuffer(signs, "<u2").reshape(-1, SIGN_LANES).astype(np.uint16),
        )


def multisets(texts: list[str]) -> Multiset:
    """Sums over each text's paragraphs; a text without any has all lanes 0."""
    parts = [paragraphs(text) for text in texts]
    digests = b"".join(
        blake2b(part.encode(), digest_size=8 * WIDE_LANES).digest() for one in parts for part in one
    )
    counts = np.array([len(one) for one in parts], np.int64)
    wide = np.zeros((len(texts), WIDE_LANES), np.uint64)
    signs = np.zeros((len(texts), SIGN_LANES), np.uint16)
    if digests:
        some = np.flatnonzero(counts)
        firsts = (np.cumsum(counts) - counts)[some]
        lanes = np.frombuffer(digests, "<u8").reshape(-1, WIDE_LANES)
        wide[some] = np.add.reduceat(lanes, firsts, axis=0)
        bits = np.frombuffer(digests, np.uint8).reshape(-1, 8 * WIDE_LANES)[:, : SIGN_LANES // 8]
        ones = np.add.reduceat(np.unpackbits(bits, axis=1), firsts, axis=0, dtype=np.int64)
        signs[some] = (2 * ones - counts[some][:, None]).astype(np.uint16)
    return Multiset(wide, signs)


def likeness(a: Multiset, b: Multiset) -> np.ndarray:
    """From 0 to 1, row by row: 1 for equal fingerprints, about 0 for nothing in common.

    Estimates 1 - |A - B|^2 / (|A|^2 + |B|^2) over paragraph counts, for distinct
    paragraphs the share 2 |A and B| / (|A| + |B|), with a standard error below 0.09.
    Sums of more than 32,767 equal paragraphs wrap round: equality stays exact there, the
    likeness of such documents to others is not to be relied on.
    """

    def squares(signs: np.ndarray) -> np.ndarray:
        return (signs.astype(np.uint16).view(np.int16).astype(np.float64) ** 2).sum(axis=1)

    sizes = squares(a.signs) + squares(b.signs)
    apart = squares(a.signs - b.signs)
    near = 1 - np.divide(apart, sizes, out=np.ones_like(apart), where=sizes > 0)
    same = (a.wide == b.wide).all(axis=1) & (a.signs == b.signs).all(axis=1)
    return np.where(same, 1.0, np.clip(near, 0.0, 1.0))


def edited_text(text: str, following: str) -> str:
    """The last half of the code points replaced by as many of the following text's first."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprint_texts(batch: list[tuple[int | None, str, str]]) -> pa.RecordBatch:
    """Rows of (doc_id, text, next text) to rows of SCHEMA."""
    ids, texts, following = (list(column) for column in zip(*batch))
    edited = [edited_text(text, after) for text, after in zip(texts, following)]
    own, changed, after = multisets(texts), multisets(edited), multisets(following)
    columns = [
        pa.array(ids, pa.int64()),
        pa.array([len(text) for text in texts], pa.int64()),
        pa.array([sha256(text.encode()).hexdigest() for text in edited]),
        pa.array(own.strings()),
        pa.array(changed.strings()),
        pa.array(likeness(own, changed), pa.float64()),
        pa.array(likeness(own, after), pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(columns, [part.split()[0] for part in SCHEMA.split(", ")])


def with_next(docs: DataFrame, buckets: int) -> tuple[DataFrame, int]:
    """Rows (bucket, guest, doc_id, text) in which each bucket is a stretch of the order.

    The order is doc_id descending, rows without an id last, ties by text. Buckets are cut
    at ids of the table, so each one's first rows are known by their id alone; they are
    also sent, as guests, to the bucket before. The last bucket's guests are the first rows
    of all. Only the cuts, one per bucket, pass through the driver.
    """
    key = F.coalesce("doc_id", F.lit(-(2**63)).cast("long"))
    keyed = docs.select("doc_id", "text", key.alias("key"))
    shares = [k / buckets for k in range(1, buckets + 1)]
    cuts = keyed.agg(F.percentile_approx("key", shares, max(10_000, 20 * buckets))).head()[0]
    starts = np.unique(np.array(cuts or [], np.int64))  # the largest ids of the buckets
    n = max(1, len(starts))

    # The cuts travel with the function; the plan is of one size for any number of buckets.
    @F.pandas_udf("bucket int, start boolean")
    def place_of(keys: pd.Series) -> pd.DataFrame:
        values = keys.to_numpy(np.int64)
        above = np.searchsorted(starts, values)
        at = np.minimum(above, max(len(starts) - 1, 0))
        is_start = starts[at] == values if len(starts) else np.zeros(len(values), bool)
        return pd.DataFrame({"bucket": (n - 1 - above).astype(np.int32), "start": is_start})

    dealt = keyed.select("*", place_of("key").alias("at")).select("*", "at.bucket", "at.start")
    guest = F.when(F.col("start"), F.pmod(F.col("bucket") - 1, F.lit(n)))
    places = F.array(
        F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("guest")),
        F.struct(guest.cast("int").alias("bucket"), F.lit(True).alias("guest")),
    )
    rows = dealt.select("doc_id", "text", "key", F.explode(places).alias("place"))
    rows = rows.where("place.bucket is not null")
    return rows.select("place.bucket", "place.guest", "key", "doc_id", "text"), n


def fingerprint_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    buckets: int | None = None,
) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and their likeness.

    The edited text takes its end from the next document in descending doc_id (after the
    last: the first). Columns: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    One row per input row. A null text is empty; rows without an id come last in the order,
    rows of one id are ordered by text. An empty text's fingerprint is all zeros. A single
    row is its own next. An empty table gives no rows. ``buckets`` defaults to the number
    of the input's partitions.
    """
    slim = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    rows, n = with_next(slim, buckets or max(1, slim.rdd.getNumPartitions()))
    order = ["bucket", "guest", F.desc("key"), "text"]
    dealt = rows.repartition(n, "bucket").sortWithinPartitions(*order)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row waits for the one after it; of a bucket's guests only the first counts."""
        waiting, bucket, out, held = None, None, [], 0
        for batch in batches:
            flags = zip(batch.column("bucket").to_pylist(), batch.column("guest").to_pylist())
            flags = list(flags)
            at = 0
            for ids, texts in portions(batch):
                for key, text in zip(ids, texts):
                    place, guest = flags[at]
                    at += 1
                    if waiting is not None and place == bucket:
                        out.append((*waiting, text))
                        held += len(waiting[1]) + len(text)
                    waiting = None if guest else (key, text)
                    bucket = place
                    if held > 4_000_000:
                        yield fingerprint_texts(out)
                        out, held = [], 0
        if out:
            yield fingerprint_texts(out)

    return dealt.select("bucket", "guest", "doc_id", "text").mapInArrow(walk, SCHEMA)
