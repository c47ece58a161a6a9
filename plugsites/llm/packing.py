"""Best-fit packing of token sequences, large items matched first.

What a packing plan needs to know is how many pieces there are of each length. There are
at most as many lengths as a sequence has tokens, so the plan is made from that bounded
histogram, for all pieces of the corpus at once, while the pieces themselves stay
distributed: a piece finds its sequence and offset from its rank among the pieces of its
length. No piece, document or sequence passes through the driver or a single task.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plugsites.llm.chunks import chunk_encoder
from plugsites.llm.frames import id_and_text, portions, release_memory, staged

END_ID = b"\x00\x00\x00\x00"
PIECES = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, task int, place long"
)


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Each document's ids and an end id 0, cut only where they exceed ``capacity``.

    ``task`` and ``place`` number the pieces of one length within the task that made them;
    write the rows before use, so that the numbers are settled.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        encoder = chunk_encoder(tokenizer_path, spaced=False)
        seen = np.zeros(capacity + 1, np.int64)
        kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int64()]
        names = [part.split()[0] for part in PIECES.split(", ")]
        for batch in batches:
            for ids, texts in portions(batch):
                rows = []
                for key, packed in zip(ids, encoder.encode(texts)):
                    packed += END_ID
                    for piece, at in enumerate(range(0, len(packed), 4 * capacity)):
                        part = packed[at : at + 4 * capacity]
                        length = len(part) // 4
                        row = (key, piece, at // 4, length, zlib.crc32(part), task)
                        rows.append((*row, int(seen[length])))
                        seen[length] += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], names
                )
        release_memory()

    return id_and_text(docs, id_column, text_column).mapInArrow(encode, PIECES)


class _Bins:
    """Groups of equal bins by remaining gap: (number of bins, contents)."""

    def __init__(self):
        self.gaps: list[int] = []
        self.groups: dict[int, list[tuple[int, tuple]]] = {}

    def add(self, gap: int, count: int, contents: tuple) -> None:
        if count:
            if gap not in self.groups:
                insort(self.gaps, gap)
                self.groups[gap] = []
            self.groups[gap].append((count, contents))

    def take_tightest(self, size: int) -> tuple[int, int, tuple] | None:
        at = bisect_left(self.gaps, size)
        if at == len(self.gaps):
            return None
        gap = self.gaps[at]
        count, contents = self.groups[gap].pop()
        if not self.groups[gap]:
            del self.groups[gap], self.gaps[at]
        return gap, count, contents


def pack_counts(counts: dict[int, int], capacity: int) -> list[tuple[int, tuple]]:
    """Groups of equal bins: (number of bins, contents), contents a tuple of (length, copies).

    Pieces above a third of the capacity go at most two to a bin: from the longest down,
    each is matched with the longest other that fits beside it. Shorter pieces, from the
    longest down, go where the gap is tightest, into a new bin only if none fits.
    """
    left = {length: n for length, n in counts.items() if n and 3 * length > capacity}
    bins = _Bins()
    large = sorted(left)
    while large:
        length = large[-1]
        at = bisect_left(large, capacity - length + 1) - 1
        if at < 0:
            bins.add(capacity - length, left.pop(length), ((length, 1),))
            large.pop()
            continue
        partner = large[at]
        if partner == length:
            bins.add(capacity - 2 * length, left[length] // 2, ((length, 2),))
            left[length] %= 2
            if left[length]:  # nothing as long is left; match it once more below itself
                at -= 1
                if at < 0:
                    bins.add(capacity - length, 1, ((length, 1),))
                else:
                    partner = large[at]
                    bins.add(capacity - length - partner, 1, ((length, 1), (partner, 1)))
                    left[partner] -= 1
                    if not left[partner]:
                        large.pop(at)
                        del left[partner]
            large.pop()
            del left[length]
            continue
        both = min(left[length], left[partner])
        bins.add(capacity - length - partner, both, ((length, 1), (partner, 1)))
        for one in (length, partner):
            left[one] -= both
            if not left[one]:
                large.remove(one)
                del left[one]
    for length in sorted((k for k, n in counts.items() if n and 3 * k <= capacity), reverse=True):
        todo = counts[length]
        while todo:
            gap, count, contents = bins.take_tightest(length) or (capacity, todo, ())
            fit = gap // length
            full = min(count, todo // fit)
            rest = todo - full * fit if full < count else 0
            bins.add(gap - fit * length, full, (*contents, (length, fit)))
            if rest:
                bins.add(gap - rest * length, 1, (*contents, (length, rest)))
            if contents:
                bins.add(gap, count - full - bool(rest), contents)
            todo -= full * fit + rest
    return [group for groups in bins.groups.values() for group in groups]


RUNS = ["length", "first", "copies", "bin", "offset"]


def plan_runs(groups: list[tuple[int, tuple]]) -> np.ndarray:
    """Where pieces go, by length and rank; columns RUNS, sorted by length, then first.

    The piece of rank r in a run is copy (r - first) % copies of bin + (r - first) // copies.
    """
    used: dict[int, int] = {}
    rows, bin_ = [], 0
    for count, contents in groups:
        offset = 0
        for length, copies in contents:
            first = used.get(length, 0)
            rows.append((length, first, copies, bin_, offset))
            used[length] = first + count * copies
            offset += length * copies
        bin_ += count
    return np.array(sorted(rows), np.int64).reshape(-1, len(RUNS))


def place_pieces(pieces: DataFrame, capacity: int) -> DataFrame:
    """Adds sequence_id and offset to staged pieces (see ``token_pieces``)."""
    per_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    earlier = per_task.select(
        "length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier")
    )
    counts = {
        row.length: row.n
        for row in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()
    }  # at most ``capacity`` rows
    runs = plan_runs(pack_counts(counts, capacity))
    shared = pieces.sparkSession.sparkContext.broadcast(runs)

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        table = shared.value
        sizes, ranks = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        order = np.lexsort((ranks, sizes))
        # Runs and pieces merged in order of (length, rank): a piece's run is the last before it.
        keys = np.concatenate([table[:, 0], sizes[order]])
        ranks_ = np.concatenate([table[:, 1], ranks[order]])
        of_piece = np.repeat([0, 1], [len(table), len(order)])
        merged = np.lexsort((of_piece, ranks_, keys))
        run = np.empty(len(order), np.int64)
        run[order] = (np.cumsum(of_piece[merged] == 0) - 1)[of_piece[merged] == 1]
        _, first, copies, bin_, offset = table[run].T
        nth = ranks - first
        return pd.DataFrame(
            {"sequence_id": bin_ + nth // copies, "offset": offset + nth % copies * sizes}
        )

    ranked = pieces.join(earlier, ["length", "task"]).withColumn(
        "placed", place("length", F.col("place") + F.col("earlier"))
    )
    return ranked.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "placed.sequence_id", "placed.offset"
    )


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Only documents longer than ``capacity`` (with their end id) are cut, into pieces of
    that length; the last may be shorter. Sequences are filled without gaps from offset 0.

    A null or empty text is one piece of the end id alone. Null and repeated ids are
    documents of their own each; an empty table gives no rows.
    """
    pieces = token_pieces(docs, tokenizer_path, capacity, id_column, text_column)
    return place_pieces(staged(pieces, "pieces"), capacity)
