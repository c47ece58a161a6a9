"""Binary boundary layers: a shape file, its index and its attribute table.

The index tells where each record of the shape file begins and how long it is. One
expression over both files cuts the records out; they are dealt over all tasks and decoded
there in Arrow batches. Attributes come from the third file, which has records of one
width, and are joined by record number. The format has no splits: a file, 2 GB at most,
is read by one task.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: An index up to this size is broadcast to the task that reads the shapes.
BROADCAST_INDEX_BYTES = 64 * 1024 * 1024
DEFAULT_CHARSET = "ISO-8859-1"
RINGS = "array<array<struct<x:double,y:double>>>"

# Fixed values of the formats: kinds of shapes, sizes of headers and entries.
NO_SHAPE, POLYGONS = 0, (5, 15, 25)
INDEX_HEADER, INDEX_ENTRY, RECORD_HEADER = 100, 8, 8
FIELD_BYTES, FIELDS_END = 32, 0x0D


def sibling(path: str, ending: str) -> str:
    return path.removesuffix(".shp") + ending


def layer_files(path: str) -> list[str]:
    """The files that a layer needs."""
    return [path, sibling(path, ".shx"), sibling(path, ".dbf")]


def _binary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path)


def _big_endian(content: str, at: str) -> str:
    """SQL: the unsigned 32-bit integer of ``content`` at a position from 0."""
    return f"CAST(conv(hex(substring({content}, CAST({at} AS INT) + 1, 4)), 16, 10) AS BIGINT)"


def shape_records(spark: SparkSession, path: str) -> DataFrame:
    """``record`` (from 0) and ``shape``, the bytes of each record, dealt over all tasks."""
    index_path = sibling(path, ".shx")
    size = _binary(spark, index_path).agg(F.sum("length")).first()[0] or 0
    layer = F.regexp_replace("path", r"\.\w+$", "").alias("layer")
    index = _binary(spark, index_path).select(layer, F.col("content").alias("places"))
    if size <= BROADCAST_INDEX_BYTES:
        index = F.broadcast(index)
    both = _binary(spark, path).select(layer, "content").join(index, "layer")
    entry = f"{INDEX_HEADER} + {INDEX_ENTRY} * i"
    begin = f"2 * {_big_endian('places', entry)} + {RECORD_HEADER}"
    length = f"2 * {_big_endian('places', f'{entry} + 4')}"
    shape = f"substring(content, CAST({begin} AS INT) + 1, CAST({length} AS INT))"
    last = f"(length(places) - {INDEX_HEADER}) div {INDEX_ENTRY} - 1"
    records = f"""transform(CASE WHEN {last} >= 0 THEN sequence(0L, {last}) ELSE array() END,
        i -> named_struct('record', i, 'shape', {shape}))"""
    return both.select(F.expr(f"inline({records})")).repartition("record")


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rings of the shapes of a batch."""
    for batch in batches:
        rings_of, points_of, places = [0], [0], [np.empty((0, 2))]
        for shape in batch.column("shape").to_pylist():
            (kind,) = struct.unpack_from("<i", shape)
            if kind in POLYGONS:
                parts, points = struct.unpack_from("<ii", shape, 36)
                starts = np.frombuffer(shape, "<i4", parts, 44)
                before = points_of[-1]
                points_of += [before + n for n in (*starts[1:].tolist(), points)]
                places.append(np.frombuffer(shape, "<f8", 2 * points, 44 + 4 * parts).reshape(-1, 2))
            elif kind != NO_SHAPE:
                raise ValueError(f"shapes of kind {kind} are no areas")
            rings_of.append(len(points_of) - 1)
        x, y = np.concatenate(places).T
        points = pa.StructArray.from_arrays([pa.array(x), pa.array(y)], ["x", "y"])
        rings = pa.ListArray.from_arrays(pa.array(points_of, pa.int32()), points)
        areas = pa.ListArray.from_arrays(pa.array(rings_of, pa.int32()), rings)
        yield pa.RecordBatch.from_arrays([batch.column("record"), areas], ["record", "rings"])


@dataclass(frozen=True)
class _Table:
    records: int
    begin: int
    width: int
    fields: dict[str, tuple[int, int]]
    """Place within a record and width, by name."""


def _table(header: bytes) -> _Table:
    records, begin, width = struct.unpack_from("<IHH", header, 4)
    fields, place = {}, 1  # a record begins with its mark of deletion
    for at in range(FIELD_BYTES, begin - 1, FIELD_BYTES):
        if header[at] == FIELDS_END:
            break
        name = header[at : at + 11].split(b"\0")[0].decode("ascii", "replace")
        fields[name] = (place, header[at + 16])
        place += header[at + 16]
    return _Table(records, begin, width, fields)


def attributes(spark: SparkSession, path: str, names: list[str], charset: str | None = None) -> DataFrame:
    """``record`` and the named attributes as text, blanks at their ends removed; empty is
    NULL. Text is in ``charset``, by default what the layer's own note of it says."""
    file = sibling(path, ".dbf")
    header = _binary(spark, file).select(F.expr("substring(content, 1, 65535)")).first()[0]
    table = _table(bytes(header))
    missing = [name for name in names if name not in table.fields]
    if missing:
        raise ValueError(f"{file} has no {missing}, only {list(table.fields)}")
    if charset is None:
        charset = _noted_charset(spark, path)
    record = f"substring(content, {table.begin} + 1 + CAST(i AS INT) * {table.width}, {table.width})"
    places = f"sequence(0L, {table.records - 1}L)" if table.records else "array()"
    rows = f"inline(transform({places}, i -> named_struct('record', i, 'row', {record})))"

    def text(name: str):
        begin, width = table.fields[name]
        value = F.rtrim(F.decode(F.substring("row", begin + 1, width), charset), F.lit(" \0"))
        return F.nullif(F.ltrim(value), F.lit("")).alias(name)

    return _binary(spark, file).select(F.expr(rows)).select("record", *map(text, names))


def _noted_charset(spark: SparkSession, path: str) -> str:
    try:
        lines = spark.read.text(sibling(path, ".cpg")).collect()
    except AnalysisException:
        lines = []
    return lines[0].value.strip() if lines else DEFAULT_CHARSET


def read_shapes(
    spark: SparkSession,
    path: str,
    level: int,
    name_property: str,
    order_property: str | None = None,
    charset: str | None = None,
) -> DataFrame:
    """One layer as ``level, ord, name, rings``, as from its other form.

    Areas are ordered by ``order_property``, else by record number. A record without a
    shape has no rings; an attribute table that is too short leaves names NULL.
    """
    names = list(dict.fromkeys([name_property, *([order_property] if order_property else [])]))
    shapes = shape_records(spark, path).mapInArrow(_decoded, f"record long, rings {RINGS}")
    rows = shapes.join(attributes(spark, path, names, charset), "record", "left")
    place = F.expr(f"try_cast(`{order_property}` AS BIGINT)") if order_property else F.col("record")
    return rows.select(
        F.lit(level).alias("level"),
        place.alias("ord"),
        F.col(name_property).alias("name"),
        "rings",
    )
