"""Ranked lexical search over bit-sliced Bloom signatures.

A block is a few hundred documents with about as many different terms each. Every
document has a Bloom signature of as many bits as its block's documents need, and the
block keeps them sliced: slice ``b`` is a bitmap with bit ``b`` of every document. A term
is looked up in the AND of a few slices, a bitmap of the documents that may hold it. The
same is done for "at least 2, 4, 8 times", so the bitmaps, weighted and summed, bound each
document's score from above. Beside the slices a block has its terms, their numbers of
documents, and each document's own terms and counts.

A task goes through its blocks with the best scores found so far. A document whose bound
does not reach an item's last one is provably not among its best; all others are scored
exactly from their own counts. The best of every task are then merged.

An index is a table: made once, in one pass over the texts, whatever is asked of it.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plugsites.llm.frames import id_and_text, staged

# Terms are runs of ASCII letters and digits and of all that is not ASCII.
_KEPT = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
TO_TERMS = bytes(
    32 if byte < 128 and byte not in _KEPT else byte + 32 if 65 <= byte <= 90 else byte
    for byte in range(256)
)
# Fixed values of the score.
SCALE, UNIT, SATURATION, LENGTH_SHARE = 1000, 1_000_000_000, 8, 75

#: A signature tells apart terms that occur at least so many times.
TIERS = np.array([1, 2, 4, 8])
HASHES = 4
#: Signature bits for each entry (a term at a tier), at least.
BITS_PER_ENTRY = 8
#: A block has at most so many documents and, of more than eight, so many signature bits.
BLOCK_ROWS = 1024
BLOCK_BITS = 1 << 23
#: Texts are gathered up to so many characters before they are cut into blocks.
GATHERED_CHARS = 16_000_000
#: Items are searched for in rounds of about so many bytes of text.
ROUND_BYTES = 4 << 20

INDEX = """doc_ids array<long>, lengths array<long>, peaks array<long>, bits long,
    with_terms long, total long, slices binary, terms binary, document_counts binary,
    starts binary, numbers binary, counts binary"""
HITS = "item int, doc_id long, score long"


def terms_of(text: str) -> list[bytes]:
    """Terms in UTF-8, A-Z in lower case."""
    return text.encode("utf-8", "replace").translate(TO_TERMS).split()


def _hashes(terms: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    first = np.fromiter(map(zlib.crc32, terms), np.uint64, len(terms))
    second = np.fromiter((zlib.adler32(term[::-1], 40503) for term in terms), np.uint64, len(terms))
    # The second hash is spread over all bits and odd, so that all steps differ.
    spread = (second * np.uint64(0x9E3779B97F4A7C15)) ^ (first << np.uint64(29))
    return first, (spread >> np.uint64(17)) | np.uint64(1)


def _positions(hashes: tuple[np.ndarray, np.ndarray], tier: np.ndarray, bits: int) -> np.ndarray:
    """Signature bits of terms at tiers: shape of ``tier`` and one axis more."""
    first, second = hashes
    step = tier[..., None].astype(np.uint64) * np.uint64(HASHES) + np.arange(HASHES, dtype=np.uint64)
    return ((first[..., None] + step * second[..., None]) & np.uint64(bits - 1)).astype(np.int64)


def _bits_for(entries: int) -> int:
    """A power of two."""
    return 1 << max(6, (BITS_PER_ENTRY * entries - 1).bit_length())


class _Gathered:
    """Documents of a task that wait to be cut into blocks."""

    def __init__(self):
        self.numbers: dict[bytes, int] = {}
        self.documents: dict[int, list[tuple]] = {}
        self.chars = 0

    def add(self, doc_id: int | None, text: str) -> None:
        self.chars += len(text)
        found = Counter(terms_of(text))
        if not found:
            return
        number = self.numbers
        own = np.fromiter((number.setdefault(term, len(number)) for term in found), np.int64, len(found))
        counts = np.fromiter(found.values(), np.int64, len(found))
        bits = _bits_for(int((counts[:, None] >= TIERS).sum()))
        self.documents.setdefault(bits, []).append((doc_id, own, counts))

    def blocks(self) -> Iterator[pa.RecordBatch]:
        terms = list(self.numbers)
        hashes = _hashes(terms)
        for bits, documents in sorted(self.documents.items()):
            rows = min(BLOCK_ROWS, max(8, BLOCK_BITS // bits))
            for at in range(0, len(documents), rows):
                yield _block(documents[at : at + rows], bits, terms, hashes)


def _block(documents: list[tuple], bits: int, terms: list[bytes], hashes: tuple) -> pa.RecordBatch:
    sizes = [len(own) for _, own, _ in documents]
    counts = np.concatenate([counts for _, _, counts in documents])
    used, numbers, held_by = np.unique(
        np.concatenate([own for _, own, _ in documents]), return_inverse=True, return_counts=True
    )
    of_document = np.repeat(np.arange(len(documents)), sizes)
    matrix = np.zeros((bits, -(-len(documents) // 8) * 8), np.uint8)
    first, second = hashes[0][used], hashes[1][used]
    for tier, least in enumerate(TIERS):
        entry = counts >= least
        own = numbers[entry]
        places = _positions((first[own], second[own]), np.full(len(own), tier), bits)
        matrix[places, of_document[entry][:, None]] = 1
    starts = np.concatenate([[0], np.cumsum(sizes)])
    lengths = np.add.reduceat(counts, starts[:-1])
    row = [
        [doc_id for doc_id, _, _ in documents],
        lengths.tolist(),
        np.maximum.reduceat(counts, starts[:-1]).tolist(),
        bits,
        len(documents),
        int(lengths.sum()),
        np.packbits(matrix, axis=1).tobytes(),
        b" ".join(terms[one] for one in used),
        held_by.astype("<i4").tobytes(),
        starts.astype("<i8").tobytes(),
        numbers.astype("<i4").tobytes(),
        counts.astype("<i4").tobytes(),
    ]
    kinds = [pa.list_(pa.int64())] * 3 + [pa.int64()] * 3 + [pa.binary()] * 6
    names = [part.split()[0] for part in INDEX.split(",")]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)


def build_index(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Blocks of signatures, as written below the shared folder; one pass over whole texts.

    A null text has no terms; documents without terms are in no block. Repeated rows are
    documents of their own each. An empty table gives an empty index.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered = _Gathered()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                gathered.add(doc_id, text.as_py())
                if gathered.chars > GATHERED_CHARS:
                    yield from gathered.blocks()
                    gathered = _Gathered()
        yield from gathered.blocks()

    return staged(id_and_text(docs, id_column, text_column).mapInArrow(blocks, INDEX), "signatures")


@dataclass(frozen=True)
class _Round:
    """Items that are searched for together, and their terms' weights."""

    terms: list[bytes]
    weights: np.ndarray
    """For each item term: weight times repeats."""
    wanted: np.ndarray
    """For each item term: its number in ``terms``."""
    starts: np.ndarray
    """Where an item's terms begin, and the end."""
    documents: int
    total: int

    def parts(self, counts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """What a term of weight 1 that occurs so often gives to a document's score."""
        m = 100 - LENGTH_SHARE + (LENGTH_SHARE * lengths * self.documents) // self.total
        return (UNIT * counts) // (SCALE * counts + SATURATION * m)


class _Search:
    """The best documents of each item over the blocks of a task."""

    def __init__(self, asked: _Round, k: int):
        self.asked, self.k = asked, k
        self.hashes = _hashes(asked.terms)
        self.best: list[list[tuple[int, int]]] = [[] for _ in asked.starts[1:]]
        self.bounded = self.scored = 0

    def _reach(self, item: int) -> int:
        """The least score that can still count."""
        best = self.best[item]
        return best[0][0] if len(best) == self.k else 1

    def block(self, row: dict) -> None:
        asked = self.asked
        local = {term: n for n, term in enumerate(row["terms"].split(b" "))}
        asked_of = np.full(len(local), -1)
        present = [(local[term], n) for n, term in enumerate(asked.terms) if term in local]
        if not present:
            return
        in_block = np.full(len(asked.terms), -1)
        for n, (number, term) in enumerate(present):
            asked_of[number] = n
            in_block[term] = n
        here = np.array([term for _, term in present])
        lengths, peaks = np.array(row["lengths"]), np.array(row["peaks"])
        maps = self._bitmaps(here, row, len(lengths))
        # What each tier adds at most: the score at its largest count over that of the last.
        caps = np.minimum(np.append(TIERS[1:] - 1, np.iinfo(np.int64).max)[:, None], peaks)
        steps = np.diff(asked.parts(caps, lengths), axis=0, prepend=0)
        documents = _Documents(row, asked_of, len(here))
        for item, (a, b) in enumerate(zip(asked.starts, asked.starts[1:])):
            own = in_block[asked.wanted[a:b]]
            weights, own = asked.weights[a:b][own >= 0], own[own >= 0]
            if len(own):
                bounds = (np.tensordot(weights, maps[own], 1) * steps).sum(0)
                self._rescore(item, bounds, documents, weights, own, lengths)

    def _bitmaps(self, here: np.ndarray, row: dict, rows: int) -> np.ndarray:
        """For each term and tier, the documents that may hold it so often."""
        slices = np.frombuffer(row["slices"], np.uint8).reshape(row["bits"], -1)
        hashes = tuple(np.broadcast_to(part[here, None], (len(here), len(TIERS))) for part in self.hashes)
        tiers = np.broadcast_to(np.arange(len(TIERS)), (len(here), len(TIERS)))
        places = _positions(hashes, tiers, row["bits"])
        found = np.bitwise_and.reduce(slices[places], axis=2)
        found = np.bitwise_and.accumulate(found, axis=1)
        return np.unpackbits(found, axis=2)[..., :rows].astype(np.int64)

    def _rescore(self, item, bounds, documents, weights, own, lengths) -> None:
        best, self.bounded = self.best[item], self.bounded + len(bounds)
        able = np.flatnonzero(bounds >= self._reach(item))
        for row in able[np.argsort(-bounds[able], kind="stable")].tolist():
            if bounds[row] < self._reach(item):
                break
            self.scored += 1
            doc_id = documents.ids[row]
            score = int(weights @ self.asked.parts(documents.counts_of(row)[own], lengths[row]))
            if score > 0 and doc_id is not None:
                if len(best) < self.k:
                    heapq.heappush(best, (score, -doc_id))
                else:
                    heapq.heappushpop(best, (score, -doc_id))

    def hits(self) -> list[tuple[int, int, int]]:
        return [(item, -key, score) for item, best in enumerate(self.best) for score, key in best]


class _Documents:
    """The exact counts of a block, unpacked for the documents that are scored."""

    def __init__(self, row: dict, asked_of: np.ndarray, asked: int):
        self.ids = row["doc_ids"]
        self.starts = np.frombuffer(row["starts"], "<i8")
        self.numbers = np.frombuffer(row["numbers"], "<i4")
        self.counts = np.frombuffer(row["counts"], "<i4")
        self.asked_of, self.asked = asked_of, asked
        self.known: dict[int, np.ndarray] = {}

    def counts_of(self, row: int) -> np.ndarray:
        if row not in self.known:
            span = slice(self.starts[row], self.starts[row + 1])
            places = self.asked_of[self.numbers[span]]
            counts = np.zeros(self.asked, np.int64)
            counts[places[places >= 0]] = self.counts[span][places >= 0]
            self.known[row] = counts
        return self.known[row]


def _document_counts(index: DataFrame, terms: list[bytes]) -> np.ndarray:
    """In how many documents each term occurs; a row per term and task at most."""
    shared = index.sparkSession.sparkContext.broadcast(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {term: n for n, term in enumerate(shared.value)}
        held = np.zeros(len(number), np.int64)
        for batch in batches:
            for words, counts in zip(batch.column("terms"), batch.column("document_counts")):
                counts = np.frombuffer(counts.as_py(), "<i4")
                for place, term in enumerate(words.as_py().split(b" ")):
                    if term in number:
                        held[number[term]] += counts[place]
        found = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(held[found])], ["term", "n"])

    parts = index.select("terms", "document_counts").mapInArrow(count, "term long, n long")
    out = np.zeros(len(terms), np.int64)
    for row in parts.groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[row.term] = row.n
    return out


def _rounds(items: DataFrame) -> Iterator[list[tuple]]:
    """Distinct (item_id, text) in rounds of bounded size, dealt by hash."""
    items = items.where("text is not null").dropDuplicates(["item_id", "text"])
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rounds = -(-size // ROUND_BYTES)
    deal = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(rounds, 1)))
    for one in range(rounds):
        yield [(row.item_id, row.text) for row in items.where(deal == one).collect()]


def _asked(index: DataFrame, texts: list[str], documents: int, total: int) -> _Round:
    found = [Counter(terms_of(text)) for text in texts]
    terms = sorted(set().union(*found))
    number = {term: n for n, term in enumerate(terms)}
    held = _document_counts(index, terms)
    weight = [math.floor(SCALE * math.log((2 * documents + 2) / (2 * df + 1))) for df in held.tolist()]
    weights = [weight[number[term]] * times for one in found for term, times in one.items()]
    return _Round(
        terms,
        np.array(weights, np.int64),
        np.array([number[term] for one in found for term in one], np.int64),
        np.concatenate([[0], np.cumsum([len(one) for one in found])]).astype(np.int64),
        documents,
        total,
    )


def task_hits(index: DataFrame, asked: _Round, k: int) -> DataFrame:
    """The best documents of each task: item (its place in the round), doc_id, score."""
    shared = index.sparkSession.sparkContext.broadcast(asked)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _Search(shared.value, k)
        for batch in batches:
            for place in range(batch.num_rows):
                found.block(batch.slice(place, 1).to_pylist()[0])
        columns = zip(*found.hits()) if any(found.best) else ([], [], [])
        kinds = (pa.int32(), pa.int64(), pa.int64())
        arrays = [pa.array(list(column), kind) for column, kind in zip(columns, kinds)]
        yield pa.RecordBatch.from_arrays(arrays, ["item", "doc_id", "score"])

    return index.drop("document_counts", "with_terms", "total").mapInArrow(search, HITS)


def ranked_search(
    index: DataFrame,
    items: DataFrame,
    k: int,
    id_column: str = "item_id",
    text_column: str = "text",
) -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank, doc_id, score.

    Only scores above 0 count; equal ones rank by ascending doc_id. An item without text
    or terms has no rows, a repeated one counts once, a null item_id is an item like any
    other. Documents without an id count in all statistics but are not returned; rows that
    repeat an id rank each on their own. An empty index or table of items gives no rows.
    """
    spark = index.sparkSession
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    sums = index.agg(F.sum("with_terms").alias("documents"), F.sum("total").alias("total")).first()
    if not sums["total"]:
        return out
    wanted = items.select(
        F.col(id_column).cast("long").alias("item_id"), F.col(text_column).alias("text")
    )
    best = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    for texts in _rounds(wanted):
        asked = _asked(index, [text for _, text in texts], sums["documents"], sums["total"])
        names = spark.createDataFrame(
            [(place, item_id) for place, (item_id, _) in enumerate(texts)], "item int, item_id long"
        )
        hits = task_hits(index, asked, k).withColumn("rank", F.row_number().over(best))
        ranked = hits.where(F.col("rank") <= k).join(F.broadcast(names), "item")
        out = out.unionByName(ranked.select("item_id", "rank", "doc_id", "score"))
    return out
