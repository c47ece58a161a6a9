"""Queries for boundaries and the point-in-area lookup.

Areas derive from ``supplier`` on a grid that grows with the table: one small area
per supplier (level 3), one per 16 (level 2), one per 128 (level 1). Points derive
from ``customer`` and spread over the same grid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plugsites.catalog import Query
from plugsites.catalog.frames import STATE_SQL, sentinel_state, table
from plugsites.operators.areas import find_areas, index_areas
from plugsites.operators.missing import fill_text
from plugsites.operators.shape import union_sources
from plugsites.operators.tiles import boundary_edges
from plugsites.schema import LEVEL_COLUMNS, UNKNOWN
from plugsites.sinks.stage import shared_folder
from plugsites.sources.boundaries import NAME_PROPERTIES, read_layer

# Shapes relative to an area's corner.
CITY = [(0.02, 0.03), (0.21, 0.05), (0.24, 0.20), (0.10, 0.24), (0.03, 0.18)]
CITY_HOLE = [(0.08, 0.10), (0.14, 0.10), (0.14, 0.15), (0.08, 0.15)]
CITY_PART = [(0.22, 0.01), (0.30, 0.02), (0.26, 0.12)]
DISTRICT = [(-0.05, 0.0), (4.1, 0.01), (4.05, 0.25), (0.0, 0.26)]
STATE = [(0.0, 0.0), (8.2, -0.02), (8.1, 1.0), (0.1, 1.01)]
STATE_HOLE = [(3.0, 0.3), (3.5, 0.3), (3.5, 0.6)]

NO_RING = "array<struct<x:double,y:double>>"


def _ring(shape: list[tuple[float, float]], x: Column, y: Column) -> Column:
    return F.array(*[F.struct((x + dx).alias("x"), (y + dy).alias("y")) for dx, dy in shape])


def _whole_part(value: Column, divisor: int) -> Column:
    return F.floor(value / divisor)


def cities(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("s_suppkey")
    x = F.lit(6.0) + (k % 32).cast("double") / 4
    y = F.lit(48.0) + _whole_part(k, 32).cast("double") / 4
    rings = F.array_compact(
        F.array(
            _ring(CITY, x, y),
            F.when(k % 3 == 0, _ring(CITY_HOLE, x, y)),
            F.when(k % 4 == 1, _ring(CITY_PART, x, y)),
        )
    )
    return table(spark, folder, "supplier").select(
        F.lit(3).alias("level"), k.alias("ord"), F.concat(F.lit("City "), k).alias("name"), rings.alias("rings")
    )


def districts(spark: SparkSession, folder: str) -> DataFrame:
    groups = table(spark, folder, "supplier").select(_whole_part(F.col("s_suppkey"), 16).alias("g")).distinct()
    g = F.col("g")
    x = F.lit(6.0) + (g % 2).cast("double") * 4
    y = F.lit(48.0) + _whole_part(g, 2).cast("double") / 4
    return groups.select(
        F.lit(2).alias("level"),
        g.alias("ord"),
        F.concat(F.lit("District "), g).alias("name"),
        F.array(_ring(DISTRICT, x, y)).alias("rings"),
    )


def states(spark: SparkSession, folder: str) -> DataFrame:
    groups = table(spark, folder, "supplier").select(_whole_part(F.col("s_suppkey"), 128).alias("g")).distinct()
    g = F.col("g")
    x, y = F.lit(6.0), F.lit(48.0) + g.cast("double")
    return groups.select(
        F.lit(1).alias("level"),
        g.alias("ord"),
        F.concat(F.lit("State "), g).alias("name"),
        F.array(_ring(STATE, x, y), _ring(STATE_HOLE, x, y)).alias("rings"),
    )


def places(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("c_custkey")
    cell = _whole_part(k, 15)
    return table(spark, folder, "customer").select(
        "c_custkey",
        (F.lit(6.0) + (cell % 32).cast("double") / 4 + ((k * 37) % 101).cast("double") / 400).alias("longitude"),
        (F.lit(48.0) + _whole_part(cell, 32).cast("double") / 4 + ((k * 53) % 97).cast("double") / 380).alias(
            "latitude"
        ),
        sentinel_state(k).alias("state"),
    )


def edges_from_layer(spark: SparkSession, folder: str) -> DataFrame:
    """Write the areas as GeoJSON, one feature per line, and read them as a layer."""

    def points(ring: Column) -> Column:
        return F.transform(ring, lambda point: F.array(point["x"], point["y"]))

    areas = cities(spark, folder)
    coordinates = F.transform(F.col("rings"), lambda ring: F.array(points(ring)))
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.col("name").alias(NAME_PROPERTIES[3]), F.col("ord").alias("place")).alias("properties"),
        F.struct(F.lit("MultiPolygon").alias("type"), coordinates.alias("coordinates")).alias("geometry"),
    )
    path = shared_folder(spark, "layer")
    areas.select(F.to_json(feature)).write.text(path)
    return boundary_edges(read_layer(spark, path, 3, order_property="place"))


def _index(*layers: DataFrame):
    return index_areas(union_sources(list(layers)))


def point_in_polygon(spark: SparkSession, folder: str) -> DataFrame:
    found = find_areas(places(spark, folder), _index(cities(spark, folder)), {3: "found"})
    return found.select("c_custkey", F.coalesce("found", F.lit(UNKNOWN)).alias("city"))


def point_in_polygon_levels(spark: SparkSession, folder: str) -> DataFrame:
    index = _index(states(spark, folder), districts(spark, folder), cities(spark, folder))
    found = find_areas(places(spark, folder).drop("state"), index, LEVEL_COLUMNS)
    return found.select(
        "c_custkey",
        *[F.coalesce(name, F.lit(UNKNOWN)).alias(name) for name in LEVEL_COLUMNS.values()],
    )


def enrich_missing_state(spark: SparkSession, folder: str) -> DataFrame:
    index = _index(states(spark, folder))
    rows = places(spark, folder)
    found = find_areas(rows, index, {1: "found"}, F.coalesce(F.col("state") != "Hessen", F.lit(True)))
    return found.select("c_custkey", fill_text(F.col("state"), F.col("found")).alias("state"))


def _edges_values(shape: list[tuple[float, float]], ring: int) -> list[str]:
    return [
        "({}, {})".format(ring, ", ".join(f"CAST({v} AS DOUBLE)" for v in (*start, *end)))
        for start, end in zip(shape, [*shape[1:], shape[0]], strict=True)
    ]


def _shape_sql(*shapes: list[tuple[float, float]]) -> str:
    values = [row for ring, shape in enumerate(shapes) for row in _edges_values(shape, ring)]
    return f"(VALUES {', '.join(values)}) AS e(ring, dx1, dy1, dx2, dy2)"


def _placed_sql(level: int, ord_: str, name: str, x: str, y: str, source: str, where: str) -> str:
    return f"""SELECT {level} AS level, {ord_} AS ord, '{name} ' || {ord_} AS name,
        {x} + dx1 AS x1, {y} + dy1 AS y1, {x} + dx2 AS x2, {y} + dy2 AS y2 FROM {source} WHERE {where}"""


CITIES_SQL = _placed_sql(
    3,
    "s_suppkey",
    "City",
    "(CAST(6.0 AS DOUBLE) + CAST(s_suppkey % 32 AS DOUBLE) / 4)",
    "(CAST(48.0 AS DOUBLE) + CAST(s_suppkey // 32 AS DOUBLE) / 4)",
    f"supplier, {_shape_sql(CITY, CITY_HOLE, CITY_PART)}",
    "ring = 0 OR (ring = 1 AND s_suppkey % 3 = 0) OR (ring = 2 AND s_suppkey % 4 = 1)",
)
DISTRICTS_SQL = _placed_sql(
    2,
    "g",
    "District",
    "(CAST(6.0 AS DOUBLE) + CAST(g % 2 AS DOUBLE) * 4)",
    "(CAST(48.0 AS DOUBLE) + CAST(g // 2 AS DOUBLE) / 4)",
    f"(SELECT DISTINCT s_suppkey // 16 AS g FROM supplier), {_shape_sql(DISTRICT)}",
    "TRUE",
)
STATES_SQL = _placed_sql(
    1,
    "g",
    "State",
    "CAST(6.0 AS DOUBLE)",
    "(CAST(48.0 AS DOUBLE) + CAST(g AS DOUBLE))",
    f"(SELECT DISTINCT s_suppkey // 128 AS g FROM supplier), {_shape_sql(STATE, STATE_HOLE)}",
    "TRUE",
)
PLACES_SQL = f"""SELECT c_custkey AS id,
    CAST(6.0 AS DOUBLE) + CAST((c_custkey // 15) % 32 AS DOUBLE) / 4 + CAST((c_custkey * 37) % 101 AS DOUBLE) / 400 AS px,
    CAST(48.0 AS DOUBLE) + CAST(c_custkey // 15 // 32 AS DOUBLE) / 4 + CAST((c_custkey * 53) % 97 AS DOUBLE) / 380 AS py,
    {STATE_SQL.format(k="c_custkey")} AS state FROM customer"""

# Every place against every edge: places (id, px, py) and edges (level, ord, name, x1, ...).
BRUTE_FORCE_SQL = """inside AS (
    SELECT id, level, ord, name FROM places, edges
    GROUP BY id, level, ord, name
    HAVING count(*) FILTER (WHERE (y1 > py) <> (y2 > py)
            AND px < (x2 - x1) * (py - y1) / nullif(y2 - y1, 0) + x1) % 2 = 1
        AND NOT bool_or((x2 - x1) * (py - y1) - (y2 - y1) * (px - x1) = 0
            AND px BETWEEN least(x1, x2) AND greatest(x1, x2)
            AND py BETWEEN least(y1, y2) AND greatest(y1, y2))),
found AS (SELECT id, arg_min(name, ord) FILTER (WHERE level = 1) AS state,
    arg_min(name, ord) FILTER (WHERE level = 2) AS district_city,
    arg_min(name, ord) FILTER (WHERE level = 3) AS city FROM inside GROUP BY id)"""


def _lookup_sql(edges: str, output: str) -> str:
    return f"""WITH places AS ({PLACES_SQL}), edges AS ({edges}), {BRUTE_FORCE_SQL}
        SELECT id AS c_custkey, {output} FROM places LEFT JOIN found USING (id)"""


QUERIES = {
    "boundary_edges": Query(edges_from_layer, CITIES_SQL),
    "point_in_polygon": Query(
        point_in_polygon, _lookup_sql(CITIES_SQL, "coalesce(found.city, 'UNKNOWN') AS city")
    ),
    "point_in_polygon_levels": Query(
        point_in_polygon_levels,
        _lookup_sql(
            f"{CITIES_SQL} UNION ALL {DISTRICTS_SQL} UNION ALL {STATES_SQL}",
            """coalesce(found.state, 'UNKNOWN') AS state,
            coalesce(found.district_city, 'UNKNOWN') AS district_city, coalesce(found.city, 'UNKNOWN') AS city""",
        ),
    ),
    "enrich_missing_state": Query(
        enrich_missing_state,
        _lookup_sql(
            STATES_SQL,
            """CASE WHEN places.state = 'Hessen' THEN 'Hessen'
            ELSE coalesce(found.state, 'UNKNOWN') END AS state""",
        ),
    ),
}
