"""Encoding of texts chunk by chunk, each different chunk once.

A safe boundary is one space between two characters that are not white space. Both
families of vocabulary used here split text before their merges, and no part of that
split reaches over a safe boundary: either white space is dropped, or the space opens
the part that follows. Encoding the chunks between safe boundaries and joining the ids
therefore gives what encoding the whole text gives. White space means Python's, which
contains the tokenizers' own, so doubtful cases are never boundaries.

One line feed between two such characters is a boundary too: dropped like a space, or a
part of its own, and the part that follows is then without a space.

Texts are split, and their chunks told apart, looked up and replaced by ids, in Arrow and
numpy; only chunks that are not remembered become Python strings.
"""

from __future__ import annotations

import re
import sys
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers.pre_tokenizers import ByteLevel

from plugsites.llm.vocabularies import json_tokenizer

SAFE = re.compile(r"(?<=\S) (?=\S)")
#: Chunks remembered by a worker, twice over (a younger and an older generation).
REMEMBERED = 500_000
#: Longer chunks are rare and large; they are encoded again where they recur.
LONGEST_REMEMBERED = 64
#: At most this many characters are handed to the library at once.
CALL_CHARS = 1_000_000
#: Words of these letters are one part in either family, and change case letter by letter.
PLAIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+")
#: How byte-level vocabularies write a space.
SPACE = "\u0120"
#: Marks that no contraction and no special string begins or ends with.
PUNCTUATION = ".,;:!?*#$%&)]"
LETTERS = "".join(filter(PLAIN.fullmatch, map(chr, range(0x180))))


def safe_chunks(text: str) -> list[str]:
    """The text between safe boundaries, without the boundary's space."""
    return SAFE.split(text)


#: Ids as they are stored and checked, whatever the machine.
ID = np.dtype("<u4")


def _gathered(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``ids`` with these starts and sizes, one after another."""
    ends = np.cumsum(sizes)
    at = np.repeat(starts - ends + sizes, sizes)
    at += np.arange(len(at))
    return ids[at]


def _numbered(values: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The different values below ``limit``, ascending, and for each value its number there."""
    seen = np.zeros(limit, bool)
    seen[values] = True
    numbers = np.cumsum(seen)
    numbers -= 1
    return np.flatnonzero(seen), numbers[values]


class _Remembered:
    """Different chunks and their ids; some 30 bytes a chunk, as Python strings about 200."""

    def __init__(self, chunks: pa.Array | None = None, ids=(), sizes=()):
        self.chunks = pa.array([], pa.large_string()) if chunks is None else chunks
        self.ids = np.asarray(ids, ID)
        self.sizes = np.asarray(sizes, np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def __len__(self) -> int:
        return len(self.chunks)

    def places(self, chunks: pa.Array) -> np.ndarray:
        """Where these different chunks stand; -1 for others."""
        out = np.full(len(chunks), -1, np.int64)
        if len(self) and len(chunks):
            found = pc.fill_null(pc.index_in(self.chunks, value_set=chunks), -1).to_numpy()
            here = np.flatnonzero(found >= 0)
            out[found[here]] = here
        return out

    def of(self, places: np.ndarray) -> _Remembered:
        sizes = self.sizes[places]
        ids = _gathered(self.ids, self.starts[places], sizes)
        return _Remembered(self.chunks.take(pa.array(places)), ids, sizes)

    def and_(self, *others: _Remembered) -> _Remembered:
        parts = [one for one in (self, *others) if len(one)]
        if len(parts) < 2:
            return parts[0] if parts else self
        return _Remembered(
            pa.concat_arrays([one.chunks for one in parts]),
            np.concatenate([one.ids for one in parts]),
            np.concatenate([one.sizes for one in parts]),
        )


class ChunkEncoder:
    """Ids of texts as little-endian unsigned 32-bit integers.

    ``spaced``: chunks after the first are encoded with the space before them, for
    vocabularies that keep white space. The memory of chunks is bounded; what falls
    out of it is encoded again.

    A chunk that is a plain word needs no splitting: the library's normaliser and byte
    alphabet are applied to the letters once, and its model to each chunk. This costs less
    than half of a whole encoding.

    A run of punctuation after a plain word is a part of its own in either family, so such a
    chunk is looked up without the one at its end, and the run's ids are added.
    """

    def __init__(self, path: str, spaced: bool):
        self.tokenizer = json_tokenizer(path)
        self.lead = " " if spaced else ""
        self.bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        added = self.tokenizer.get_added_tokens_decoder().values()
        #: A letter may be part of an added token: then no word is plain.
        self.plain = not any(PLAIN.fullmatch(token.content.strip()) for token in added)
        #: A plain word as a chunk; nothing matches where no word is plain.
        self.plain_chunk = rf"\A{'[ \n]?' if spaced else ''}{PLAIN.pattern}\z"
        if not self.plain:
            self.plain_chunk = r"\z\A."
        self.spelling = dict(zip(map(ord, LETTERS), self._spelled(list(LETTERS))))
        (self.line_feed,) = self._library(["\n"])
        self.young, self.old = _Remembered(), _Remembered()

    def encode(self, texts: list[str]) -> list[bytes]:
        """One byte string per text; an empty text has no ids."""
        ids, counts = self.encode_flat(texts)
        packed = ids.tobytes()
        ends = (4 * np.cumsum(counts)).tolist()
        return [packed[start:end] for start, end in zip([0, *ends], ends)]

    def lengths(self, texts: list[str]) -> list[int]:
        """Number of ids per text."""
        return self.encode_flat(texts)[1].tolist()

    def encode_flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and their number by text."""
        if not texts:
            return np.empty(0, ID), np.empty(0, np.int64)
        marked = pc.replace_substring(
            pa.array(texts, pa.large_string()), "\n", " \n" if self.lead else " "
        )
        split = pc.split_pattern(marked, " ")
        coded = split.flatten().dictionary_encode()
        pieces, which = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        counts = np.diff(split.offsets.to_numpy())
        del marked, split, coded
        doubtful = self._doubtful(pieces)
        if not doubtful.any():
            return self._of_pieces(pieces, which, counts)
        starts = np.cumsum(counts) - counts
        again = np.zeros(len(texts), bool)
        again[np.searchsorted(starts, np.flatnonzero(doubtful[which]), side="right") - 1] = True
        first = self._of_pieces(pieces, which[np.repeat(~again, counts)], counts[~again])
        chunks = [safe_chunks(texts[k]) for k in np.flatnonzero(again)]
        coded = pa.array([one for of in chunks for one in of], pa.large_string()).dictionary_encode()
        second = self._of_pieces(
            coded.dictionary,
            coded.indices.to_numpy(zero_copy_only=False),
            np.array([len(of) for of in chunks], np.int64),
        )
        sizes = np.concatenate([first[1], second[1]])
        order = np.argsort(np.concatenate([np.flatnonzero(~again), np.flatnonzero(again)]))
        ids = _gathered(
            np.concatenate([first[0], second[0]]), (np.cumsum(sizes) - sizes)[order], sizes[order]
        )
        return ids, sizes[order]

    def _doubtful(self, pieces: pa.Array) -> np.ndarray:
        """Pieces of a split at every boundary's character whose ends show that one was not safe.

        Where white space is dropped, nothing between two of them does no harm.
        """
        bare = pieces
        if self.lead:
            bare = pc.if_else(
                pc.starts_with(pieces, "\n"), pc.utf8_slice_codeunits(pieces, 1), pieces
            )
        found = pc.not_equal(pc.utf8_trim_whitespace(bare), bare)
        if self.lead:
            found = pc.or_(found, pc.equal(bare, ""))
        return found.to_numpy(zero_copy_only=False)

    def _of_pieces(
        self, pieces: pa.Array, which: np.ndarray, counts: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts given as the numbers of their pieces, ``counts`` of them a text."""
        if not len(counts):
            return np.empty(0, ID), np.empty(0, np.int64)
        starts = np.cumsum(counts) - counts
        used, which = _numbered(which, len(pieces))
        pieces = pieces.take(pa.array(used))
        if self.lead:
            # A text's first chunk has no space before it, nor has one after a line feed.
            heads, nth = _numbered(which[starts], len(pieces))
            which[starts] = len(pieces) + nth
            text = pa.large_string()
            led = pc.binary_join_element_wise(
                pa.scalar(self.lead, text), pieces, pa.scalar("", text)
            )
            led = pc.if_else(pc.starts_with(pieces, "\n"), pieces, led)
            pieces = pa.concat_arrays([led, pieces.take(pa.array(heads))])
            coded = pieces.dictionary_encode()  # a head may be the same as another chunk
            which = coded.indices.to_numpy(zero_copy_only=False)[which]
            pieces = coded.dictionary
        table, sizes = self._of_different(pieces)
        sizes_of = sizes[which]
        ids = _gathered(table, (np.cumsum(sizes) - sizes)[which], sizes_of)
        return ids, np.add.reduceat(sizes_of, starts)

    def _of_different(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these pieces, one after another, and their number by piece."""
        nothing = pa.scalar("", pa.large_string())
        stems = pc.utf8_rtrim(pieces, characters=PUNCTUATION)
        plain = pc.match_substring_regex(stems, self.plain_chunk)
        bodies = pc.if_else(plain, stems, pieces).dictionary_encode()
        tails = pc.if_else(plain, pc.utf8_ltrim(pieces, characters=LETTERS + " \n"), nothing)
        tails = tails.dictionary_encode()
        known, places = self._known(bodies.dictionary)
        ends = self._library(tails.dictionary.to_pylist())
        tail_sizes = np.array([len(one) // 4 for one in ends], np.int64)
        tail_starts = len(known.ids) + np.cumsum(tail_sizes) - tail_sizes
        body = places[bodies.indices.to_numpy(zero_copy_only=False)]
        tail = tails.indices.to_numpy(zero_copy_only=False)
        sizes = np.stack([known.sizes[body], tail_sizes[tail]], axis=1)
        starts = np.stack([known.starts[body], tail_starts[tail]], axis=1)
        all_ids = np.concatenate([known.ids, np.frombuffer(b"".join(ends), ID)])
        return _gathered(all_ids, starts.reshape(-1), sizes.reshape(-1)), sizes.sum(axis=1)

    def _known(self, chunks: pa.Array) -> tuple[_Remembered, np.ndarray]:
        """A memory that has all of these chunks, and their places in it."""
        places = self.young.places(chunks)
        missing = np.flatnonzero(places < 0)
        if not len(missing):
            return self.young, places
        wanted = chunks.take(pa.array(missing))
        older = self.old.places(wanted)
        n = len(self.young)
        places[missing[older >= 0]] = n + np.arange(np.count_nonzero(older >= 0))
        known = self.young.and_(self.old.of(older[older >= 0]))
        n = len(known)
        places[missing[older < 0]] = n + np.arange(np.count_nonzero(older < 0))
        self.young = known = known.and_(self._learned(wanted.filter(pa.array(older < 0))))
        self._forget()
        return known, places

    def _learned(self, chunks: pa.Array) -> _Remembered:
        plain = pc.match_substring_regex(chunks, self.plain_chunk)
        leads = [pc.and_(plain, pc.starts_with(chunks, lead)) for lead in (" ", "\n")]
        kind = pc.case_when(pc.make_struct(*leads, plain), 1, 2, 0, 3)
        kind = kind.to_numpy(zero_copy_only=False)
        found: list[bytes] = []
        places = [np.flatnonzero(kind == one) for one in range(4)]
        for one, at in enumerate(places):
            own = chunks.take(pa.array(at))
            if one in (1, 2):
                own = pc.utf8_slice_codeunits(own, 1)
            own = own.to_pylist()
            if one == 3:
                found += self._library(own)
            elif one == 2:
                found += [self.line_feed + ids for ids in self._words(own, "")]
            else:
                found += self._words(own, SPACE if one else "")
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        back = np.argsort(np.concatenate(places))
        starts = (np.cumsum(sizes) - sizes)[back]
        sizes = sizes[back]
        return _Remembered(chunks, _gathered(np.frombuffer(b"".join(found), ID), starts, sizes), sizes)

    def _forget(self) -> None:
        long = pc.greater(pc.utf8_length(self.young.chunks), LONGEST_REMEMBERED)
        long = long.to_numpy(zero_copy_only=False)
        if long.any():
            self.young = self.young.of(np.flatnonzero(~long))
        if len(self.young) > REMEMBERED:
            self.old, self.young = self.young, _Remembered()

    def _words(self, words: list[str], lead: str | None = None) -> list[bytes]:
        """Ids of plain words, each with the space before it if chunks have one, or with
        another ``lead`` in the byte alphabet."""
        if lead is None:
            lead = SPACE if self.lead else ""
        if not words:
            return []
        tokenize = self.tokenizer.model.tokenize
        ids, ends = array("I"), [0]
        # The words are spelled together; none has a line feed, nor has its spelling.
        for word in "\n".join(words).translate(self.spelling).split("\n"):
            ids.extend([token.id for token in tokenize(lead + word)])
            ends.append(len(ids))
        packed = _little_endian(ids)
        return [packed[4 * start : 4 * end] for start, end in zip(ends, ends[1:])]

    def _spelled(self, words: list[str]) -> list[str]:
        """Words as the model reads them; those of small ASCII letters are so already."""
        joined = " ".join(words)
        if self.tokenizer.normalizer:
            joined = self.tokenizer.normalizer.normalize_str(joined)
        ((mapped, _),) = self.bytes.pre_tokenize_str(joined)
        return mapped.split(SPACE)

    def _library(self, chunks: list[str]) -> list[bytes]:
        out: list[bytes] = []
        call, held = [], 0
        for chunk in chunks:
            if call and held + len(chunk) > CALL_CHARS:
                out += self._call(call)
                call, held = [], 0
            call.append(chunk)
            held += len(chunk) + 50
        return out + self._call(call)

    def _call(self, chunks: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)
        return [_little_endian(one.ids) for one in encoded]


def _little_endian(ids: list[int] | array) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


@lru_cache(maxsize=4)
def chunk_encoder(path: str, spaced: bool) -> ChunkEncoder:
    """One per worker and vocabulary, so that its memory lasts over batches and tasks."""
    return ChunkEncoder(path, spaced)
