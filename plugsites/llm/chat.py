"""Chat formatting: records of any known layout become canonical turns, turns become text.

A record's layout is told by a fingerprint: a hash of the sorted paths of all its nested
fields. The fingerprint selects a declarative mapping, a list of where each turn's role
and text are found. Records of unknown layout are kept apart, never guessed.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Markers of this template, which all begin with "<|" as those of many others
#: do, and the control strings of another common template.
TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
CONTROL = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
ESCAPE = "\\"
LEARNED_ROLE = "assistant"

TURNS = "key long, position long, part int, role string, text string, layout string"


@dataclass(frozen=True)
class Turn:
    """One turn (or, below a list, one per element). ``role`` is a path or ``=constant``;
    ``names`` are what a layout calls the canonical roles, others stay as they are."""

    role: str
    text: str
    each: str = ""
    optional: bool = False
    names: tuple[tuple[str, str], ...] = ()


#: Role names of the layout that says who a turn is from.
SPEAKERS = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"))


#: Layouts by their fields; a field below a list is written ``list[].field``.
LAYOUTS: dict[tuple[str, ...], tuple[Turn, ...]] = {
    ("role", "text"): (Turn("role", "text"),),
    ("role", "content"): (Turn("role", "content"),),
    ("messages[].content", "messages[].role"): (Turn("role", "content", each="messages"),),
    ("conversations[].from", "conversations[].value"): (
        Turn("from", "value", each="conversations", names=SPEAKERS),
    ),
    ("prompt", "response"): (Turn("=user", "prompt"), Turn("=assistant", "response")),
    ("completion", "prompt"): (Turn("=user", "prompt"), Turn("=assistant", "completion")),
    ("prompt", "response", "system"): (
        Turn("=system", "system", optional=True),
        Turn("=user", "prompt"),
        Turn("=assistant", "response"),
    ),
    ("instruction", "output"): (Turn("=user", "instruction"), Turn("=assistant", "output")),
    ("input", "instruction", "output"): (
        Turn("=user", "instruction"),
        Turn("=user", "input", optional=True),
        Turn("=assistant", "output"),
    ),
    ("data.answer", "data.question"): (
        Turn("=user", "data.question"),
        Turn("=assistant", "data.answer"),
    ),
}


def field_paths(value, prefix: str = "") -> set[str]:
    """Paths of all leaves; elements of a list share one path."""
    if isinstance(value, dict) and value:
        below = ((v, f"{prefix}.{k}" if prefix else k) for k, v in value.items())
        return set().union(*(field_paths(v, path) for v, path in below))
    if isinstance(value, list) and value:
        return set().union(*(field_paths(v, f"{prefix}[]") for v in value))
    return {prefix}


def fingerprint(paths: Iterable[str]) -> str:
    return sha256("\n".join(sorted(paths)).encode()).hexdigest()


MAPPINGS = {fingerprint(paths): turns for paths, turns in LAYOUTS.items()}


def _at(value, path: str):
    for name in path.split("."):
        value = value.get(name) if isinstance(value, dict) else None
    return value


def _text(value) -> str:
    if value is None:
        return ""
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def canonical_turns(record) -> tuple[str, list[tuple[str, str]]]:
    """The record's fingerprint and its (role, text) turns; none for unknown layouts."""
    print_ = fingerprint(field_paths(record))
    turns = []
    for turn in MAPPINGS.get(print_, ()):
        for one in _at(record, turn.each) if turn.each else [record]:
            text = _text(_at(one, turn.text))
            if text or not turn.optional:
                role = turn.role[1:] if turn.role[0] == "=" else _text(_at(one, turn.role))
                turns.append((dict(turn.names).get(role, role), text))
    return print_, turns


def turns_of(records: DataFrame) -> DataFrame:
    """Canonical turns of records (key long, position long, record string as JSON).

    Columns key, position, part (number within the record), role, text and layout, the
    fingerprint. A record of unknown layout, or that is no JSON object, gives one row of
    part -1 with a null role and the record as its text. A null record gives no row, a
    null text or role is empty. An empty table gives no rows.
    """

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            columns = (batch.column(name).to_pylist() for name in ("key", "position", "record"))
            for key, position, body in zip(*columns):
                if body is None:
                    continue
                try:
                    record = json.loads(body)
                except ValueError:
                    record = None
                layout, turns = canonical_turns(record) if isinstance(record, dict) else ("", [])
                if layout not in MAPPINGS:
                    rows.append((key, position, -1, None, body, layout))
                rows += [(key, position, n, *turn, layout) for n, turn in enumerate(turns)]
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)],
                    ["key", "position", "part", "role", "text", "layout"],
                )

    return records.select("key", "position", "record").mapInArrow(convert, TURNS)


_CONTROLS = re.compile("|".join(map(re.escape, sorted(CONTROL, key=len, reverse=True))))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    """No control string is left: a backslash goes after its first character."""
    doubled = text.replace(ESCAPE, ESCAPE * 2)
    return _CONTROLS.sub(lambda m: m[0][0] + ESCAPE + m[0][1:], doubled)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def _escaped(column: str) -> Column:
    """``escape`` as built-in functions."""
    doubled = F.replace(F.col(column), F.lit(ESCAPE), F.lit(ESCAPE * 2))
    longest_first = sorted(CONTROL, key=len, reverse=True)
    pattern = "|".join(f"({re.escape(c[0])})({re.escape(c[1:])})" for c in longest_first)
    groups = range(1, 2 * len(CONTROL), 2)  # of these pairs only the matching one has text
    firsts = "".join(f"${n}" for n in groups)
    rests = "".join(f"${n + 1}" for n in groups)
    return F.regexp_replace(doubled, F.lit(pattern), F.lit(f"{firsts}{ESCAPE * 2}{rests}"))


def formatted_turns(turns: DataFrame) -> DataFrame:
    """Each turn in the template's form, and its loss mask.

    Adds ``formatted`` (marker, escaped role, marker, escaped text, marker) and ``mask``, the
    stretches of it that are learned: first code point and number, from 0; the bodies of
    ``LEARNED_ROLE``. A conversation's text is its turns' forms in order of (position, part),
    joined by nothing; ``read_back`` undoes it. Rows of unknown layout are left out.
    """
    role, text = (F.coalesce(name, F.lit("")) for name in ("role", "text"))
    known = turns.where("part >= 0").withColumns({"role": role, "text": text})
    known = known.withColumns(
        {
            "head": F.concat(F.lit(TURN), _escaped("role"), F.lit(BODY)),
            "body": _escaped("text"),
        }
    )
    stretch = F.struct(
        F.char_length("head").alias("start"), F.char_length("body").alias("length")
    )
    learned = F.when(F.col("role") == LEARNED_ROLE, F.array(stretch))
    return known.select(
        "key",
        "position",
        "part",
        F.concat("head", "body", F.lit(END)).alias("formatted"),
        F.coalesce(learned, F.array().cast("array<struct<start:int,length:int>>")).alias("mask"),
    )


DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
    "loss_sha256 string, formatted_chars long"
)


class _Conversation:
    """Running digests of one conversation's formatted text."""

    def __init__(self, key):
        self.key, self.turns, self.loss_chars, self.chars = key, 0, 0, 0
        self.all, self.loss = sha256(), sha256()

    def add(self, formatted: str, mask: list[dict]) -> None:
        for role, text in parse(formatted):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
        for stretch in mask:
            text = unescape(formatted[stretch["start"] : stretch["start"] + stretch["length"]])
            self.loss_chars += len(text)
            self.loss.update(text.encode())
        self.chars += len(formatted)

    def row(self) -> tuple:
        return (
            self.key,
            self.turns,
            self.all.hexdigest(),
            self.loss_chars,
            self.loss.hexdigest(),
            self.chars,
        )


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn in a formatted text."""
    turns = []
    for piece in formatted.split(TURN)[1:]:
        role, _, rest = piece.partition(BODY)
        turns.append((unescape(role), unescape(rest.removesuffix(END))))
    return turns


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation, read from its formatted text and its loss mask alone.

    Turns are sorted within partitions and streamed, so a conversation of any length
    needs the memory of one batch. Rows without a key are one conversation; repeated
    turns count each time, ties in order of their text.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in DIGESTS.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

        def ended(rows: list[tuple]) -> pa.RecordBatch:
            arrays = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
            return pa.RecordBatch.from_arrays(arrays, names)

        current = None
        for batch in batches:
            rows = []
            columns = (batch.column(name).to_pylist() for name in ("key", "formatted", "mask"))
            for key, formatted, mask in zip(*columns):
                if current is None or current.key != key:
                    if current is not None:
                        rows.append(current.row())
                    current = _Conversation(key)
                current.add(formatted, mask)
            if rows:
                yield ended(rows)
        if current is not None:
            yield ended([current.row()])

    order = [F.asc_nulls_first(c) for c in ("key", "position", "part", "formatted")]
    return (
        formatted.repartition("key")
        .sortWithinPartitions(*order)
        .select("key", "formatted", "mask")
        .mapInArrow(digest, DIGESTS)
    )
