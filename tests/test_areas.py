import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plugsites.operators.areas import fill_areas, find_areas, index_areas
from plugsites.operators import tiles as tiling
from plugsites.operators.tiles import boundary_edges, tile_areas
from plugsites.sources.boundaries import read_boundaries, read_layer

LAYER = "tests/data/states.geojsonl"
RINGS = "level int, ord bigint, name string, rings array<array<struct<x:double,y:double>>>"


def inside(x, y, rings):
    """Plain even-odd test with open borders."""
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]], strict=True):
            on_line = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1) == 0
            if on_line and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return False
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


def areas_and_points(seed):
    """Random quadrilaterals with holes, and points on a grid that meets their corners."""
    rng = random.Random(seed)
    areas = []
    for level in (1, 2):
        for ord_ in range(12):
            x, y, w = rng.randrange(-8, 8) / 4, rng.randrange(-8, 8) / 4, rng.choice([0.25, 0.5, 1.75])
            outer = [(x, y), (x + w, y + rng.choice([0, 0.1])), (x + w, y + w), (x, y + w)]
            hole = [(x + w / 4, y + w / 4), (x + w / 2, y + w / 4), (x + w / 2, y + w / 2)]
            areas.append((level, ord_, f"{level}-{ord_}", [outer, hole] if ord_ % 2 else [outer]))
    points = [(i, x / 8, y / 8) for i, (x, y) in enumerate((x, y) for x in range(-24, 32) for y in range(-24, 32))]
    return areas, points


def expected_names(areas, points):
    return {
        i: tuple(
            next((name for level, _, name, rings in areas if level == wanted and inside(x, y, rings)), None)
            for wanted in (1, 2)
        )
        for i, x, y in points
    }


@pytest.mark.parametrize("limit", [1 << 30, 0], ids=["broadcast", "shuffle"])
@pytest.mark.parametrize("edges_per_tile", [1, 3, 32])
def test_lookup_equals_brute_force(spark, limit, edges_per_tile, monkeypatch):
    areas, points = areas_and_points(7)
    monkeypatch.setattr(tiling.tile_areas, "__defaults__", (edges_per_tile, 3))
    index = index_areas(spark.createDataFrame(areas, RINGS))
    rows = spark.createDataFrame(points, "id int, longitude double, latitude double")
    found = find_areas(rows, index, {1: "one", 2: "two"}, broadcast_limit=limit, salts=3)
    result = {row.id: (row.one, row.two) for row in found.collect()}
    assert result == expected_names(areas, points)


@pytest.mark.parametrize("limit", [1 << 30, 0], ids=["broadcast", "shuffle"])
def test_unusable_coordinates_and_unneeded_rows_stay(spark, limit):
    index = index_areas(spark.createDataFrame([(1, 0, "A", [[(-1.0, -1.0), (2.0, -1.0), (2.0, 2.0), (-1.0, 2.0)]])], RINGS))
    rows = spark.createDataFrame(
        [(1, 0.5, 0.5, True), (1, 0.5, 0.5, True), (2, None, 0.5, True), (3, float("nan"), 0.5, True), (4, 1e300, 0.5, True), (5, 0.5, 0.5, False), (6, 0.5, 0.5, None)],
        "id int, longitude double, latitude double, wanted boolean",
    )
    found = find_areas(rows, index, {1: "name"}, F.col("wanted"), broadcast_limit=limit)
    result = sorted((row.id, row.name) for row in found.collect())
    assert result == [(1, "A"), (1, "A"), (2, None), (3, None), (4, None), (5, None), (6, None)]


def test_borders_are_outside(spark):
    square = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]
    index = index_areas(spark.createDataFrame([(1, 0, "S", [square])], RINGS))
    border = [(0.0, 0.5), (1.0, 0.5), (0.5, 0.0), (0.5, 1.0), (0.0, 0.0), (1.0, 1.0)]
    rows = spark.createDataFrame([*border, (0.5, 0.5)], "longitude double, latitude double")
    names = find_areas(rows, index, {1: "name"}).where("name is not null").collect()
    assert [(row.longitude, row.latitude) for row in names] == [(0.5, 0.5)]


def test_covered_tiles_hold_no_edges(spark):
    big = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)]
    tiles = tile_areas(spark.createDataFrame([(1, 0, "S", [big])], RINGS), edges_per_tile=0, steps=2)
    assert tiles.where("whole and size(edges) > 0").isEmpty()
    # The interior in tiles of three sizes, the border in the smallest; no tile twice.
    covered = tiles.selectExpr("sum(pow(16D, -depth)) FILTER (WHERE whole) AS area").first().area
    assert covered == (10 - 2 / 16) ** 2
    assert tiles.where("whole").count() < 4 * tiles.where("not whole").count()
    assert tiles.select("depth", "tile_x", "tile_y").distinct().count() == tiles.count()


def test_layer_forms_agree(spark):
    lines = read_layer(spark, LAYER, 1)
    collection = read_boundaries(spark, {1: "tests/data/boundaries.geojson"}, collection=True)
    assert [row.name for row in lines.orderBy("ord").collect()] == ["Ring", "Two parts", "Below"]
    edges = sorted(tuple(row)[2:] for row in boundary_edges(lines).collect())
    assert edges == sorted(tuple(row)[2:] for row in boundary_edges(collection).collect())
    assert len(edges) == 20


def test_holes_parts_and_layer_order(spark):
    index = index_areas(read_layer(spark, LAYER, 1))
    points = {(13.4, 52.5): "Ring", (13.4, 52.7): "Below", (8.5, 50.5): "Two parts", (10.5, 50.5): "Two parts", (9.5, 50.5): None, (14.5, 53.5): "Below"}
    rows = spark.createDataFrame(list(points), "longitude double, latitude double")
    found = find_areas(rows, index, {1: "name"}).collect()
    assert {(row.longitude, row.latitude): row.name for row in found} == points


def test_only_missing_areas_are_filled(spark):
    index = index_areas(read_layer(spark, LAYER, 1))
    rows = spark.createDataFrame(
        [(13.4, 52.5, "N.A", None, "Ort"), (13.4, 52.5, "Hessen", "UNKOWN", ""), (1.0, 1.0, "", "Kreis", "Ort")],
        "longitude double, latitude double, state string, district_city string, city string",
    )
    result = [tuple(row)[2:] for row in fill_areas(rows, index).collect()]
    assert result == [("Ring", "UNKNOWN", "Ort"), ("Hessen", "UNKNOWN", "UNKNOWN"), ("UNKNOWN", "Kreis", "Ort")]
    without = [tuple(row)[2:] for row in fill_areas(rows, None).collect()]
    assert without[0] == ("UNKNOWN", "UNKNOWN", "Ort")


def star(x, y, radius, corners, teeth):
    """A closed line of many corners around a point."""
    turn = [2 * math.pi * n / corners for n in range(corners)]
    reach = [radius * (1 + 0.2 * math.sin(teeth * t)) for t in turn]
    return [(x + r * math.cos(t), y + r * math.sin(t)) for r, t in zip(reach, turn)]


def inside_many(x, y, ring):
    """As ``inside``, for many points off the border."""
    odd = np.zeros(len(x), bool)
    for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]], strict=True):
        if y1 != y2:
            odd ^= ((y1 > y) != (y2 > y)) & (x < (x2 - x1) * (y - y1) / (y2 - y1) + x1)
    return odd


@pytest.fixture(scope="module")
def mixed(spark):
    """A country of 20,000 corners, a smooth one, and streets a ten-thousandth as wide."""
    streets = [star(10 + n / 100, 50 + n / 70, 0.0005, 40, 5) for n in range(30)]
    rings = [star(10.0, 50.0, 4.0, 20_000, 90), star(2.0, 44.0, 1.5, 12, 3), *streets]
    areas = [(1 if n < 2 else 2, n, f"area {n}", [ring]) for n, ring in enumerate(rings)]
    boundaries = spark.createDataFrame(areas, RINGS).repartition(8, "ord")
    return rings, index_areas(boundaries)


def test_areas_of_very_different_size_in_one_set(spark, mixed):
    rings, index = mixed
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.uniform(0, 16, 3000), *[10 + n / 100 + rng.uniform(-1e-3, 1e-3, 60) for n in range(30)]])
    y = np.concatenate([rng.uniform(42, 56, 3000), *[50 + n / 70 + rng.uniform(-1e-3, 1e-3, 60) for n in range(30)]])
    hits = np.array([inside_many(x, y, ring) for ring in rings])
    expected = [
        tuple(next((f"area {n}" for n in group if hits[n, i]), None) for group in (range(2), range(2, 32)))
        for i in range(len(x))
    ]
    rows = spark.createDataFrame([*zip(range(len(x)), x.tolist(), y.tolist())], "id int, longitude double, latitude double")
    for limit in (1 << 30, 0):
        found = find_areas(rows, index, {1: "one", 2: "two"}, broadcast_limit=limit, salts=3)
        result = {row.id: (row.one, row.two) for row in found.collect()}
        assert [result[i] for i in range(len(x))] == expected
    assert {None, "area 0", "area 1"} == {one for one, _ in expected} and len({two for _, two in expected}) == 31


def test_rows_of_an_area_are_bounded_by_its_border(mixed):
    rings, index = mixed
    rows = {r.ord: r for r in index.tiles.groupBy("ord").agg(
        F.count("*").alias("tiles"), F.max(F.size("edges")).alias("most"), F.max("depth").alias("depth")).collect()}
    for n, ring in enumerate(rings):
        assert rows[n].tiles <= 17**2 + len(ring)
        assert rows[n].most <= tiling.EDGES_PER_TILE
    assert max(rows[n].depth for n in range(2)) < min(rows[n].depth for n in range(2, 32))


def test_edges_of_one_border_are_dealt_over_tasks(spark):
    """The whole border is one row; its tiles are made and cut by several tasks."""
    boundaries = spark.createDataFrame([(1, 0, "A", [star(10.0, 50.0, 4.0, 20_000, 90)])], RINGS)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small as it is
    try:
        for tiles in (tiling._first_tiles(boundaries), tile_areas(boundaries)):
            tasks = tiles.withColumn("task", F.spark_partition_id()).groupBy("task").agg(F.sum(F.size("edges")).alias("n"))
            shares = [row.n for row in tasks.collect() if row.n]
            assert len(shares) > 2 and max(shares) < 0.6 * sum(shares)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
