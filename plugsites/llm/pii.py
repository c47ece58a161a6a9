"""Personal data in texts: base rules, and a chain field that adds what rules miss."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plugsites.llm import crf
from plugsites.llm.frames import PORTION_CHARS, id_and_text, portions
from plugsites.llm.labelled_forms import labelled_forms
from plugsites.llm.pii_rules import KINDS, base_spans

#: Bounds of the labelled table that the field is trained on.
LABELLED_CHAINS = 3000
LONGEST_LABELLED_CHAIN = 32
DRAWS = 1 << 32

SPAN = "array<struct<kind:string,start:int,end:int>>"
SPAN_TYPE = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
)


def labelled_chains(
    docs: DataFrame,
    at_most: int = LABELLED_CHAINS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """A small labelled table: (features, labels) of chains, labelled by the base rules.

    All texts are searched twice: once for the number of chains, and again for those whose
    hash lies below the share that is needed, twice over. Of these the ``at_most`` with the
    smallest hash are kept. So what leaves the tasks is of one size for any corpus. That
    bound, and ``LONGEST_LABELLED_CHAIN`` words to a chain, keep training small.
    """
    slim = id_and_text(docs, id_column, text_column)

    def usable(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for ids, texts in portions(batch):
                for key, text in zip(ids, texts):
                    short = (c for c in crf.chains(text) if len(c) <= LONGEST_LABELLED_CHAIN)
                    yield key, text, [(_draw(key, c[0][0]), c) for c in short]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = sum(len(found) for _, _, found in usable(batches))
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    n = slim.mapInArrow(count, "n long").agg(F.sum("n")).first()[0] or 0
    limit = DRAWS if n <= 2 * at_most else 2 * at_most * DRAWS // n

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, text, found in usable(batches):
            drawn = [(place, chain) for place, chain in found if place < limit]
            if drawn:
                spans = base_spans(text)
                bodies = [json.dumps([crf.features(text, c), crf.gold(c, spans)]) for _, c in drawn]
                places = pa.array([place for place, _ in drawn], pa.int64())
                yield pa.RecordBatch.from_arrays([places, pa.array(bodies)], ["place", "body"])

    found = slim.mapInArrow(label, "place long, body string")
    return found.orderBy("place", "body").limit(at_most)


def _draw(key: int | None, start: int) -> int:
    """A number below DRAWS that follows from a chain's place."""
    return zlib.crc32(f"{key}:{start}".encode())


def train_field(
    labelled: DataFrame, forms: Sequence[tuple[str, list]] | None = None
) -> crf.ChainField | None:
    """Train on a labelled table of bounded size and on ``forms``, (text, spans) rows with
    what the base rules do not find, by default ``labelled_forms()``; None if the table is
    empty."""
    rows = [json.loads(row.body) for row in labelled.select("body").collect()]
    if not rows:
        return None
    for text, spans in labelled_forms() if forms is None else forms:
        for chain in crf.chains(text):
            rows.append([crf.features(text, chain), crf.gold(chain, spans)])
    return crf.train([row[0] for row in rows], [row[1] for row in rows])


def _added(
    texts: list[str], base: list[list[tuple[int, int, int]]], field: crf.ChainField | None
) -> list[list[tuple[int, int, int]]]:
    """The field's spans that overlap no base span, by text."""
    added: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if field is None:
        return added
    runs = [(k, chain) for k, text in enumerate(texts) for chain in crf.chains(text)]
    labels = field.decode([crf.features(texts[k], chain) for k, chain in runs])
    for (k, chain), path in zip(runs, labels):
        for start, kind, end in crf.predicted_spans(texts[k], chain, path):
            if not any(start < b and a < end for a, _, b in base[k]):
                added[k].append((start, kind, end))
    return added


def _structs(spans: list[tuple[int, int, int]]) -> list[dict]:
    return [{"kind": KINDS[kind], "start": start, "end": end} for start, kind, end in spans]


def _mapper(field: crf.ChainField | None, masked: bool):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in portions(batch):
                base = [base_spans(text) for text in texts]
                spans = [sorted(b + a) for b, a in zip(base, _added(texts, base, field))]
                columns = [
                    pa.array(ids, pa.int64()),
                    pa.array([_structs(one) for one in base], SPAN_TYPE),
                    pa.array([_structs(one) for one in spans], SPAN_TYPE),
                ]
                names = ["doc_id", "base", "spans"]
                if masked:
                    texts = [mask(text, one) for text, one in zip(texts, spans)]
                    columns.append(pa.array(texts, pa.string()))
                    names.append("masked")
                yield pa.RecordBatch.from_arrays(columns, names)

    return find


def _rows_in_portions(texts: list[str | None]) -> Iterator[list[int]]:
    rows, held = [], 0
    for k, text in enumerate(texts):
        if rows and held + len(text or "") > PORTION_CHARS:
            yield rows
            rows, held = [], 0
        rows.append(k)
        held += len(text or "")
    if rows:
        yield rows


def mask_documents(
    docs: DataFrame,
    field: crf.ChainField | None,
    text_column: str = "text",
    length_column: str | None = "n_chars",
) -> DataFrame:
    """All columns of the rows, each span of the text replaced by its kind in brackets.

    ``length_column``, if the rows have it, is set to the new text's code points where a
    text changed. A null text stays null, repeated rows are changed alike. An empty table
    gives no rows.
    """

    def new_texts(texts: list[str | None]) -> Iterator[tuple[int, str]]:
        """(row, text) of those that change, in portions of bounded size."""
        for rows in _rows_in_portions(texts):
            held = [texts[k] or "" for k in rows]
            base = [base_spans(text) for text in held]
            for k, text, own, more in zip(rows, held, base, _added(held, base, field)):
                if own or more:
                    yield k, mask(text, own + more)

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.names.index(text_column)
            texts = batch.column(at).to_pylist()
            changed = []
            for k, text in new_texts(texts):
                texts[k] = text
                changed.append(k)
            batch = batch.set_column(at, batch.field(at), pa.array(texts, batch.field(at).type))
            if length_column in batch.schema.names and changed:
                at = batch.schema.names.index(length_column)
                lengths = batch.column(at).to_pylist()
                for k in changed:
                    lengths[k] = len(texts[k])
                kind = batch.field(at).type
                batch = batch.set_column(at, batch.field(at), pa.array(lengths, kind))
            yield batch

    return docs.mapInArrow(replace, docs.schema)


def find_personal_data(
    docs: DataFrame,
    field: crf.ChainField | None,
    id_column: str = "doc_id",
    text_column: str = "text",
    masked: bool = False,
) -> DataFrame:
    """Columns doc_id, base and spans (all, base included), sorted by start, then kind.

    Offsets are code points, the end exclusive; with ``masked`` also the text with each
    span replaced by its kind in brackets. A field of None adds nothing.

    One row per input row. A null text is empty and has no spans; null and repeated ids
    are carried through; an empty table gives no rows.
    """
    schema = f"doc_id long, base {SPAN}, spans {SPAN}" + (", masked string" if masked else "")
    mapper = _mapper(field, masked)
    return id_and_text(docs, id_column, text_column).mapInArrow(mapper, schema)


def mask(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Each span replaced by its kind; overlapping spans become one, named by the first."""
    if not spans:
        return text
    parts, at = [], 0
    for start, kind, end in sorted(spans):
        if start >= at:
            parts += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join(parts) + text[at:]


def joined(spans: str) -> F.Column:
    """kind:start:end of each span, joined by commas."""
    return F.concat_ws(
        ",",
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])),
    )


def count_of(spans: str, kind: str) -> F.Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
