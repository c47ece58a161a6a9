"""Context-mixing entropy coder for token ids, many blocks in step.

A block is coded on its own: models, coder states and checksum start afresh with it. Its
ids lie in streams of consecutive ids, coded side by side with those of all blocks of a
segment: a step is a few dozen numpy operations over all streams, whatever their number.

Each different id of a block has a slot, and each id's interval is a mixture of three
predictions. Order 2: the slot that last followed the two ids before it, in any of the
block's streams. Order 1: the slot that last followed the one before. Order 0: every slot
by how often these two miss it. The shares of orders 2 and 1 are how often each is right in
the block, by whether they have a prediction and agree. The block begins with these shares
and with its ids, ascending, and their counts. An id may have 32 bits.

The encoder finds what each prediction says by sorting places by context, all at once, and
codes from a stream's end to its begin; the decoder follows step by step. A coder state is
below 2^63 and moves 32 bits at a time (asymmetric numerals with the counts as they are).
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK_IDS = 2048
#: A block of more ids has several streams, each of at least this many.
STREAM_IDS = 2048
#: Places are sorted as 32 bits with their context.
MOST_BLOCK_IDS = 1 << 14
ID_BITS = 32
#: Shares are parts of 2^12; what both orders miss keeps at least these.
SHARE_BITS, LEAST_MISS = 12, 6
ONE = 1 << SHARE_BITS
#: States are at least this, a multiple of all intervals there are, and below 2^32 times that.
LEAST = 1 << 31
#: A class tells whether order 1 (1) and order 2 (2) have a prediction, and the same (4).
CLASSES, ONLY_1, ONLY_2, DIFFERENT, SAME = 8, 1, 2, 3, 7
SHARES = 5
MAGIC = b"IDR3"
#: magic, ids, crc32 of the ids as 32 bits, units of 16 bits that follow, ids of a stream,
#: streams, different ids
HEADER = struct.Struct("<4sIIIHHH")

_U = np.uint64
_WORD, _UNIT, _SHARE = _U(32), _U(16), _U(SHARE_BITS)
_LOW16 = _U(0xFFFF)


class BlockError(ValueError):
    """A block is damaged: its header, length or checksum is wrong."""


def _place_bits(places: int) -> int:
    """Bits of the sum of a block's counts, and of its pairs of slots."""
    return max(4, (places - 1).bit_length())


def _hashes(n: int, bits: int) -> np.ndarray:
    """For the slots below ``n``, numbers below 2^bits by which pairs of them are told apart."""
    return (np.arange(n, dtype=np.uint64) * _U(0x9E3779B97F4A7C15) >> _U(64 - bits)).astype(np.int64)


def _put_numbers(values: np.ndarray) -> bytes:
    """Numbers from 1 on. Classes double in size and are told in unary, the most frequent one
    by the fewest bits; then come the places within the classes."""
    kind = np.frexp(values.astype(np.float64))[1] - 1
    often = np.bincount(kind, minlength=ID_BITS + 1)
    listed = np.argsort(-often, kind="stable")[: np.count_nonzero(often)]
    rank = np.empty(ID_BITS + 1, np.int64)
    rank[listed] = np.arange(len(listed))
    ones = np.cumsum(rank[kind] + 1) - 1
    unary = np.zeros(int(ones[-1]) + 1, bool)
    unary[ones] = True
    width = int(kind.max())
    within = np.unpackbits(values.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)[:, 64 - width :]
    wanted = np.arange(width, 0, -1, dtype=np.uint8) <= kind.astype(np.uint8)[:, None]
    packed = np.packbits(np.concatenate([unary, within[wanted].view(bool)])).tobytes()
    return bytes([len(listed)]) + listed.astype(np.uint8).tobytes() + struct.pack("<I", len(packed)) + packed


def _get_numbers(data: bytes, at: int, n: int) -> tuple[np.ndarray, int]:
    """The numbers put at ``at``, and where they end."""
    body = at + 1 + data[at]
    listed = np.frombuffer(data, np.uint8, data[at], at + 1).astype(np.int64)
    (size,) = struct.unpack_from("<I", data, body)
    end = body + 4 + size
    if end > len(data) or listed.max(initial=0) > ID_BITS:
        raise BlockError("wrong list")
    bits = np.unpackbits(np.frombuffer(data, np.uint8, size, body + 4))
    ones = np.flatnonzero(bits)[:n]
    rank = np.diff(ones, prepend=-1) - 1
    if len(ones) < n or rank.max() >= len(listed):
        raise BlockError("wrong list")
    kind = listed[rank]
    until = np.cumsum(kind) + (int(ones[-1]) + 1)
    if until[-1] > len(bits):
        raise BlockError("wrong list")
    # The bits of a number lie in the five bytes that end with the one of its last bit.
    octets = np.frombuffer(b"\0" * 4 + data[body + 4 : end], np.uint8).astype(np.int64)
    last = until - 1
    last >>= 3
    near = octets.take(last + 4, mode="clip")
    for back in range(1, 5):
        near |= octets.take(last + (4 - back), mode="clip") << 8 * back
    near >>= -until & 7
    return near & ((1 << kind) - 1) | 1 << kind, end


def _shares(seen: np.ndarray) -> np.ndarray:
    """From counts by class and outcome (miss, order 1, order 2, none): the block's shares."""
    parts = seen * (ONE - LEAST_MISS - 2) // np.maximum(seen.sum(axis=1, keepdims=True), 1)
    parts = np.maximum(parts, seen > 0)
    return np.array(
        [parts[ONLY_1, 1], parts[ONLY_2, 2], parts[DIFFERENT, 2], parts[DIFFERENT, 1], parts[SAME, 2]]
    )


def _intervals(shares: np.ndarray) -> np.ndarray:
    """By class and outcome (miss, order 1, order 2, none): where the interval begins (low 16
    bits) and its size; with the outcome none, the share of order 2 and that of both orders."""
    second, both = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    second[[ONLY_2, DIFFERENT, SAME]] = shares[[1, 2, 4]]
    both[[ONLY_1, ONLY_2, DIFFERENT, SAME]] = shares[[0, 1, 2, 4]]
    both[DIFFERENT] += shares[3]
    rows = [both | (ONE - both) << 16, second | (both - second) << 16, second << 16, second | both << 16]
    return np.stack(rows, axis=1).reshape(-1)


def _last_followers(contexts: np.ndarray, slots: np.ndarray, streams: int, bits: int) -> np.ndarray:
    """For each place: the slot at the last place of the same context that an earlier step has
    (of several streams, the last), 0 if none has. Places go by step, then stream; their
    numbers have ``bits`` bits."""
    key = contexts.astype(np.uint32) << np.uint32(bits)
    key |= np.arange(len(key), dtype=np.uint32)
    key.sort()
    at = (key & np.uint32((1 << bits) - 1)).astype(np.int64)
    follower = np.zeros_like(slots)
    change = key[1:] ^ key[:-1]
    np.multiply(slots.take(at[:-1], mode="clip"), change >> np.uint32(bits) == 0, out=follower[1:])
    if streams > 1:
        # All of one context and step see what the first of them sees.
        again = np.zeros(len(key), bool)
        np.equal(change >> np.uint32(streams.bit_length() - 1), 0, out=again[1:])
        late, back = np.flatnonzero(again), 1
        while len(late):
            follower[late] = follower[late - 1]
            late, back = late[again[late - back]], back + 1
    out = np.empty_like(slots)
    out[at] = follower
    return out


class _Plan:
    """What the coder needs of all ids of a segment, by step and stream, and what a block
    begins with."""

    def __init__(self, steps: int, lanes: int):
        #: Starts (above 16 bits) and sizes of intervals, of slots and of outcomes.
        self.counted = np.zeros((steps, lanes), np.uint32)
        self.shared = np.zeros((steps, lanes), np.uint32)
        self.heads: list[tuple[bytes, int]] = []

    def add(self, ids: np.ndarray, steps: int, streams: int) -> None:
        """A block; the last of a segment may be shorter than its streams."""
        n, held = steps * streams, len(ids)
        bits, place_bits = (n - 1).bit_length(), _place_bits(n)
        place = np.arange(n, dtype=np.uint32)
        top = int(ids.max()) + 1
        wide = np.uint32 if top.bit_length() + bits <= 32 else _U
        rows = np.full(n, top, wide)  # what is missing is one more id, behind all others
        rows[:held] = ids
        key = rows.reshape(streams, steps).T.reshape(-1) << wide(bits)
        key |= place
        key.sort()
        opens = np.ones(n, bool)
        np.not_equal((key[1:] ^ key[:-1]) >> wide(bits), 0, out=opens[1:])
        at = (key & wide((1 << bits) - 1)).astype(np.int64)
        slots = np.empty(n, np.int64)
        slots[at] = np.cumsum(opens)
        different = (key[:held][opens[:held]] >> wide(bits)).astype(np.int64)
        before = np.zeros(n, np.int64)
        before[streams:] = slots[:-streams]
        hashes = _hashes(n + 2, place_bits)
        by_slot = hashes.take(slots, mode="clip")
        pair = np.full(n, hashes[0])
        pair[streams:] = by_slot[:-streams]
        pair[: 2 * streams] ^= hashes[0] >> 1
        pair[2 * streams :] ^= by_slot[: -2 * streams] >> 1
        there = None
        if held < n:
            there = (place % streams) * steps + place // streams < held
            before[~there], pair[~there] = n + 2, 1 << place_bits  # no other place's contexts
        slot1 = _last_followers(before, slots, streams, bits)
        slot2 = _last_followers(pair, slots, streams, bits)
        kind = (slot1 > 0).view(np.uint8) | (slot2 > 0).view(np.uint8) << 1
        kind |= (slot1 == slot2).view(np.uint8) << 2
        hit2 = slot2 == slots
        hit = hit2 | (slot1 == slots)
        outcome = hit.view(np.uint8) + hit2.view(np.uint8)
        case = (kind << 2 | outcome).astype(np.int64)
        hits = np.flatnonzero(hit)
        counts = np.bincount(slots, minlength=len(different) + 2)
        counts -= np.bincount(slots.take(hits), minlength=len(counts))
        cases = case
        if there is not None:
            counts[len(different) + 1], cases = 0, case[there]
        shares = _shares(np.bincount(cases, minlength=4 * CLASSES).reshape(CLASSES, 4))
        ends = _scaled_ends(counts, place_bits)
        sizes = np.diff(ends, prepend=0)
        sizes |= (ends - sizes) << 16
        counted = sizes.astype(np.uint32).take(slots, mode="clip")
        counted[hits] = 1 << place_bits
        lane = len(self.heads) * streams
        here = slice(lane, lane + streams)
        self.counted[:, here] = counted.reshape(steps, streams)
        self.shared[:, here] = _intervals(shares).astype(np.uint32).take(case, mode="clip").reshape(steps, streams)
        lists = _put_numbers(np.diff(different, prepend=-1)) + _put_numbers(counts[1:-1])
        self.heads.append((shares.astype("<u2").tobytes() + lists, len(different)))


def _scaled_ends(counts: np.ndarray, bits: int) -> np.ndarray:
    """Running totals of the counts, stretched to 2^bits, which is at least their sum."""
    ends = np.cumsum(counts)
    return (ends << bits) // ends[-1]


def _active(lanes: int, step: int, part: int) -> int:
    """Streams that have an id at this step; the last one ends before step ``part``."""
    return lanes if step < part else lanes - 1


def _layout(count: int, steps: int, streams: int, last: int) -> tuple[int, int]:
    """Streams in use of ``count`` blocks whose last has ``last`` ids; ids of the last stream."""
    used = -(-last // steps)
    return (count - 1) * streams + used, last - (used - 1) * steps


def encode_blocks(ids: np.ndarray, block_ids: int = BLOCK_IDS) -> bytes:
    """Ids (below 2^32) as blocks of ``block_ids`` (at most MOST_BLOCK_IDS), one after another."""
    if not len(ids):
        return b""
    if int(ids.min()) < 0 or int(ids.max()) >> ID_BITS or not 0 < block_ids <= MOST_BLOCK_IDS:
        raise ValueError(f"ids of {ID_BITS} bits in blocks of at most {MOST_BLOCK_IDS}")
    size = min(block_ids, len(ids))
    streams = 1 << max(0, (size // STREAM_IDS).bit_length() - 1)
    if size % streams:
        streams = 1
    steps, count = size // streams, -(-len(ids) // size)
    last = len(ids) - (count - 1) * size
    plan = _Plan(steps, count * streams)
    for k in range(0, len(ids), size):
        plan.add(ids[k : k + size], steps, streams)
    lanes, short = _layout(count, steps, streams, last)
    total = _U(1 << _place_bits(size))
    state, times = np.full(count * streams, LEAST, _U), _U(LEAST) // (total << _SHARE)
    width = steps + 2
    words = np.zeros(count * streams * width, np.uint32)
    place = np.arange(1, count * streams + 1, dtype=np.int64) * width
    for step in range(steps - 1, -1, -1):
        n = _active(lanes, step, short)
        counted, shared = plan.counted[step, :n].astype(_U), plan.shared[step, :n].astype(_U)
        freq, size_of = counted & _LOW16, shared >> _UNIT
        x = state[:n]
        full = np.flatnonzero(x >> _WORD >= size_of * (freq * times))
        if len(full):
            at = place[full] - 1
            place[full] = at
            much = x[full]
            words[at] = much
            x[full] = much >> _WORD
        # The id's place among the counts, then that among the shares.
        whole = x // freq
        x += whole * (total - freq)
        x += counted >> _UNIT
        whole = x // size_of
        x += whole * (_U(ONE) - size_of)
        x += shared & _LOW16
    place -= 2
    words[place], words[place + 1] = state >> _WORD, state.astype(np.uint32)
    ends = np.arange(1, len(place) + 1) * width
    pieces = []
    for k, (head, different) in enumerate(plan.heads):
        own = ids[k * size : (k + 1) * size]
        check = zlib.crc32(own.astype("<u4").tobytes())
        here = slice(k * streams, (k + 1) * streams)
        sizes = (ends[here] - place[here]).astype("<u2").tobytes()
        body = [sizes, head, b"\0" * (len(head) % 2)]
        body += [words[a:b].astype("<u4").tobytes() for a, b in zip(place[here], ends[here])]
        body = b"".join(body)
        pieces.append(HEADER.pack(MAGIC, len(own), check, len(body) // 2, steps, streams, different))
        pieces.append(body)
    return b"".join(pieces)


class _Tables:
    """The models of all blocks of a segment, slots numbered through, as the decoder reads them."""

    def __init__(self):
        self.ids, self.packed, self.of_place, self.intervals = [], [], [], []
        self.words, self.sizes = [], []
        self.slots = [0]

    def add(self, body: bytes, streams: int, bits: int, different: int) -> None:
        at = 2 * streams
        sizes = np.frombuffer(body, "<u2", streams, 0).astype(np.int64)
        shares = np.frombuffer(body, "<u2", SHARES, at).astype(np.int64)
        at += 2 * SHARES
        gaps, at = _get_numbers(body, at, different)
        counts, at = _get_numbers(body, at, different)
        at += at % 2
        ids = np.cumsum(gaps) - 1
        if ids[-1] >> ID_BITS or counts.sum() > 1 << bits or max(shares.max(), shares[2] + shares[3]) >= ONE:
            raise BlockError("wrong models")
        if (sizes < 2).any() or at + 4 * int(sizes.sum()) != len(body):
            raise BlockError("wrong lengths")
        ends = _scaled_ends(counts, bits)
        sizes_of = np.diff(ends, prepend=0)
        packed = _hashes(different + 1, bits) << 32
        packed[1:] |= (ends - sizes_of) | sizes_of << 16
        self.packed.append(packed)
        self.ids.append(np.concatenate([[0], ids]))
        self.of_place.append(np.repeat(np.arange(1, different + 1, dtype=np.uint16), sizes_of))
        self.intervals.append(_intervals(shares))
        self.words.append(np.frombuffer(body, "<u4", int(sizes.sum()), at))
        self.sizes.append(sizes)
        self.slots.append(self.slots[-1] + different + 1)


def _parsed(data: bytes) -> tuple[_Tables, list[int], list[int], int, int]:
    """The blocks' models, lengths and checksums; ids of a stream, and streams."""
    tables, counts, checks, shapes, at = _Tables(), [], [], set(), 0
    while at < len(data):
        if len(data) - at < HEADER.size:
            raise BlockError("cut header")
        magic, count, check, length, steps, streams, different = HEADER.unpack_from(data, at)
        at += HEADER.size
        if magic != MAGIC or len(data) - at < 2 * length or not 0 < different <= count:
            raise BlockError("wrong header or length")
        if length < streams + SHARES + 4 or not 0 < count <= steps * streams <= MOST_BLOCK_IDS:
            raise BlockError("wrong header or length")
        counts.append(count)
        checks.append(check)
        shapes.add((steps, streams))
        bits = _place_bits(steps * streams)
        tables.add(data[at : at + 2 * length], streams, bits, different)
        at += 2 * length
    if len(shapes) > 1 or any(one != steps * streams for one in counts[:-1]) or streams & (streams - 1):
        raise BlockError("blocks of different lengths")
    return tables, counts, checks, steps, streams


def decode_blocks(data: bytes) -> np.ndarray:
    """The ids of consecutive blocks; BlockError if any is damaged."""
    if not len(data):
        return np.empty(0, np.int64)
    try:
        tables, counts, checks, steps, streams = _parsed(data)
    except BlockError:
        raise
    except (struct.error, IndexError, ValueError) as error:
        raise BlockError("cut block") from error
    blocks = len(counts)
    lanes, short = _layout(blocks, steps, streams, counts[-1])
    block = np.arange(lanes, dtype=np.int64) // streams
    packed, of_place = np.concatenate(tables.packed), np.concatenate(tables.of_place)
    intervals = np.concatenate(tables.intervals)
    sizes = np.concatenate(tables.sizes)
    words = np.concatenate([*tables.words, np.zeros(steps + 4, np.uint32)]).astype(np.int64)
    place = (np.cumsum(sizes) - sizes)[:lanes]
    first_slot, first_case = np.array(tables.slots)[block], block * (4 * CLASSES)
    place_bits = _place_bits(steps * streams)
    first_place = block << place_bits
    x = words[place] << 32 | words[place + 1]
    place += 2
    if (x < LEAST).any():
        raise BlockError("impossible state")
    last1 = np.zeros(len(packed), np.uint16)
    last2 = np.zeros(blocks << place_bits, np.uint16)
    before = first_slot
    hash1 = packed.take(before) >> 32
    hash2 = hash1.copy()
    out = np.zeros((steps, blocks * streams), np.uint16)
    n = lanes
    for step in range(steps):
        if n != _active(lanes, step, short):
            n -= 1
            if not n:
                break
            x, place, before = x[:n], place[:n], before[:n]
            first_place, first_slot, hash1 = first_place[:n], first_slot[:n], hash1[:n]
            first_case, hash2 = first_case[:n], hash2[:n]
        hash2 >>= 1
        hash2 ^= hash1
        hash2 += first_place
        pair = hash2
        slot1, slot2 = last1.take(before, mode="clip"), last2.take(pair, mode="clip")
        kind = (slot1 == slot2).view(np.uint8)
        kind <<= 1
        kind |= (slot2 > 0).view(np.uint8)
        kind <<= 1
        kind |= (slot1 > 0).view(np.uint8)
        kind <<= 2
        case = first_case + kind
        share = intervals.take(case + 3, mode="clip")
        inside = x & (ONE - 1)
        hit2, hit = inside < (share & 0xFFFF), inside < share >> 16
        case += hit.view(np.uint8) + hit2.view(np.uint8)
        share = intervals.take(case, mode="clip")
        # Undo the place among the shares, then that among the counts where both orders miss.
        x >>= SHARE_BITS
        x *= share >> 16
        x += inside
        x -= share & 0xFFFF
        whole, rest = x >> place_bits, x & ((1 << place_bits) - 1)
        slot = of_place.take(first_place + rest, mode="clip")
        np.copyto(slot, slot1, where=hit)
        np.copyto(slot, slot2, where=hit2)
        last1[before] = slot
        last2[pair] = slot
        out[step, :n] = slot
        before = first_slot + slot
        about = packed.take(before, mode="clip")
        rest -= about & 0xFFFF
        whole *= about >> 16 & 0xFFFF
        whole += rest
        np.copyto(whole, x, where=hit)
        x = whole
        low = np.flatnonzero(x < LEAST)
        at = place.take(low, mode="clip")
        x[low] = x.take(low, mode="clip") << 32 | words.take(at, mode="clip")
        place[low] = at + 1
        about >>= 32
        hash2, hash1 = hash1, about
    parts = []
    for k, (count, check) in enumerate(zip(counts, checks)):
        slots = out[:, k * streams : (k + 1) * streams].T.reshape(-1)[:count]
        part = tables.ids[k].take(slots)
        if zlib.crc32(part.astype("<u4").tobytes()) != check:
            raise BlockError("wrong checksum")
        parts.append(part)
    return np.concatenate(parts)
