"""Binary layers against the same areas as GeoJSON and as SQL."""

import struct

import pytest

from plugsites.catalog.areas import CITIES_SQL, cities
from plugsites.operators.areas import find_areas, index_areas
from plugsites.operators.tiles import boundary_edges
from plugsites.sources.boundaries import read_boundaries, read_layer
from plugsites.sources.shapefiles import attributes, shape_records
from tests.oracle import connect

LAYER = "tests/data/states.geojsonl"


def write_layer(path, areas, charset="utf-8", note=True, kind=5):
    """areas: (attributes, rings); a shape without rings is a null shape."""
    shapes, index, place = [], [], 50
    for number, (_, rings) in enumerate(areas, 1):
        points = [point for ring in rings for point in ring]
        body = struct.pack("<i", kind if rings else 0)
        if rings:
            starts = [sum(map(len, rings[:n])) for n in range(len(rings))]
            box = [f(point[axis] for point in points) for f in (min, max) for axis in (0, 1)]
            body += struct.pack("<4d2i", *box, len(rings), len(points)) + struct.pack(f"<{len(rings)}i", *starts)
            body += b"".join(struct.pack("<2d", *point) for point in points)
        shapes.append(struct.pack(">2i", number, len(body) // 2) + body)
        index.append(struct.pack(">2i", place, len(body) // 2))
        place += 4 + len(body) // 2
    header = struct.pack(">7i", 9994, 0, 0, 0, 0, 0, place) + struct.pack("<2i8d", 1000, kind, *[0.0] * 8)
    path.with_suffix(".shp").write_bytes(header + b"".join(shapes))
    path.with_suffix(".shx").write_bytes(header + b"".join(index))
    names = list(areas[0][0]) if areas else ["NAME_1"]
    fields = b"".join(struct.pack("<11sc4xBB14x", name.encode(), b"C", 40, 0) for name in names)
    rows = b"".join(
        b" " + b"".join(str(values[name]).encode(charset).ljust(40)[:40] for name in names) for values, _ in areas
    )
    sizes = struct.pack("<B3BIHH20x", 3, 126, 1, 1, len(areas), 33 + len(fields), 1 + 40 * len(names))
    path.with_suffix(".dbf").write_bytes(sizes + fields + b"\r" + rows + b"\x1a")
    if note:
        path.with_suffix(".cpg").write_text(charset.upper())
    return str(path.with_suffix(".shp"))


def rings_of(row):
    return [[(point.x, point.y) for point in ring] for ring in row.rings]


def test_edges_equal_the_sql_of_the_other_form(spark, folder, tmp_path):
    rows = cities(spark, folder).collect()
    path = write_layer(tmp_path / "cities", [({"NAME_3": r.name, "place": r.ord}, rings_of(r)) for r in rows])
    layer = read_layer(spark, path, 3, order_property="place")
    expected = sorted(connect(folder).sql(CITIES_SQL).fetchall())
    assert sorted(tuple(row) for row in boundary_edges(layer).collect()) == expected


def test_holes_and_parts(spark, tmp_path):
    other = read_layer(spark, LAYER, 1)
    areas = [({"NAME_1": row.name}, rings_of(row)) for row in other.orderBy("ord").collect()]
    path = write_layer(tmp_path / "states", areas)
    layer = read_boundaries(spark, {1: path})
    assert [row.name for row in layer.orderBy("ord").collect()] == [values["NAME_1"] for values, _ in areas]
    points = [(13.4, 52.5), (13.4, 52.7), (8.5, 50.5), (10.5, 50.5), (9.5, 50.5), (14.5, 53.5)]
    rows = spark.createDataFrame(points, "longitude double, latitude double")
    found = [sorted(map(str, find_areas(rows, index_areas(one), {1: "name"}).collect())) for one in (layer, other)]
    assert found[0] == found[1]


@pytest.mark.parametrize(("charset", "note"), [("utf-8", True), ("iso-8859-1", True), ("iso-8859-1", False)])
def test_attributes_and_empty_shapes(spark, tmp_path, charset, note):
    square = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]
    areas = [({"NAME_1": "Thüringen", "x": 1}, [square]), ({"NAME_1": "", "x": "-"}, []), ({"NAME_1": "B", "x": 7}, [square])]
    path = write_layer(tmp_path / "layer", areas, charset, note, kind=15)
    rows = read_layer(spark, path, 1, order_property="x").collect()
    found = sorted((row.name or "", row.ord, rings_of(row)) for row in rows)
    assert found == [("", None, []), ("B", 7, [square]), ("Thüringen", 1, [square])]
    with pytest.raises(ValueError, match="NAME_2"):
        attributes(spark, path, ["NAME_2"])


def test_records_are_dealt_over_tasks(spark, tmp_path):
    ring = [(n / 500, (n % 7) / 3) for n in range(500)]
    path = write_layer(tmp_path / "many", [({"NAME_1": n}, [ring]) for n in range(400)])
    plan = shape_records(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(record" in plan
    assert read_layer(spark, path, 1).count() == 400


def test_a_layer_without_records_and_other_kinds(spark, tmp_path):
    assert read_layer(spark, write_layer(tmp_path / "none", []), 1).collect() == []
    path = write_layer(tmp_path / "points", [({"NAME_1": "a"}, [[(0.0, 0.0)] * 3])], kind=3)
    with pytest.raises(Exception, match="kind 3"):
        read_layer(spark, path, 1).collect()
