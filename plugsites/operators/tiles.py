"""Quad-tree tiles of areas: as small as a border needs, as large as its interior allows.

Tiles are squares with sides of 4 ** -depth, aligned at the origin, so those of one depth
nest in those of every lower one. An area begins with a few tiles of its own extent: a
country large ones, a street small ones. A tile with more than ``EDGES_PER_TILE`` edges is
cut into sixteen, up to ``STEPS`` times; what is cut is each tile's own list of edges, so
the steps after the first need no shuffle. Rows of an area are thus bounded by its border;
its interior is covered by as few large tiles as the border leaves.

A tile keeps, for each area, the edges that touch it and what the edges to its right add
to a ray from inside it: for each of those only the heights of its ends matter, and where
edges follow one another these cancel out. An area that covers the whole tile keeps
nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

EDGES_PER_TILE = 32
#: How often a tile may be cut; each time its side becomes a quarter.
STEPS = 6
#: An area's extent is at most so many of its first tiles.
FIRST_TILES = 16
#: Depths of first tiles: sides from 4 ** 20 down to 4 ** -14.
DEPTHS = (-20, 14)

AREA = ["level", "ord", "name"]
TILE = ["depth", "tile_x", "tile_y"]


def _usable(areas: DataFrame) -> DataFrame:
    """Rings without points that have no finite coordinates, each closed by its first."""
    finite = "abs(point.{0}) < double('infinity')"
    points = f"filter(ring, point -> {finite.format('x')} AND {finite.format('y')})"
    rings = f"filter(transform(rings, ring -> {points}), ring -> size(ring) >= 3)"
    return areas.withColumn("rings", F.expr(rings))


def _corners(boundaries: DataFrame) -> DataFrame:
    """One row per edge: its ends ``b`` and ``c``, with the points before and after it."""
    kept = [name for name in boundaries.columns if name != "rings"]
    rings = _usable(boundaries).select(*kept, F.explode("rings").alias("ring"))

    def turned(by: int) -> str:
        cut = f"({by} + size(ring)) % size(ring)"
        return f"concat(slice(ring, 1 + {cut}, size(ring)), slice(ring, 1, {cut}))"

    turns = rings.selectExpr(*kept, f"{turned(-1)} AS a", "ring AS b", f"{turned(1)} AS c", f"{turned(2)} AS d")
    return turns.selectExpr(*kept, "inline(arrays_zip(a, b, c, d))")


def boundary_edges(boundaries: DataFrame) -> DataFrame:
    """Boundary rows to one row per edge."""
    edges = _corners(boundaries).where("b.x <> c.x OR b.y <> c.y")
    return edges.selectExpr(*AREA, "b.x AS x1", "b.y AS y1", "c.x AS x2", "c.y AS y2")


def _span(p: tuple[str, str], q: tuple[str, str], bottom: str, top: str, side: str) -> tuple[str, str]:
    """SQL: the least and the greatest x of the edge from ``p`` to ``q`` within a band."""
    (px, py), (qx, qy) = p, q

    def at(height: str) -> str:
        x = f"{px} + ({qx} - {px}) * (({height}) - {py}) / nullif({qy} - {py}, 0D)"
        return f"least(greatest({x}, least({px}, {qx})), greatest({px}, {qx}))"

    low, high = at(f"greatest(least({py}, {qy}), {bottom})"), at(f"least(greatest({py}, {qy}), {top})")
    # Flatter edges are not cut to the band: where they leave it is not precise.
    steep = f"abs({qy} - {py}) > {side} * 1e-3D"
    left = f"CASE WHEN {steep} THEN least({low}, {high}) ELSE least({px}, {qx}) END"
    right = f"CASE WHEN {steep} THEN greatest({low}, {high}) ELSE greatest({px}, {qx}) END"
    return left, right


def _pad(side: str, *places: str) -> str:
    """SQL: edges this far beyond a tile's border still count for it, against rounding."""
    return f"({side} * 1e-6D + 1e-14D * greatest({side}, {', '.join(f'abs({place})' for place in places)}))"


def tile_areas(
    boundaries: DataFrame, edges_per_tile: int = EDGES_PER_TILE, steps: int = STEPS
) -> DataFrame:
    """``level, ord, name, depth, tile_x, tile_y, whole, beyond, edges, ends``: one row per
    area and tile. Right of the tile, ``beyond`` (0 or 1) edges cross it at every height,
    and those that end at ``ends`` cross it below that height.

    Points without finite coordinates are left out; open rings are closed; repeated rows
    count once; an area without a ring of three points has no tiles.
    """
    # Cutting a tile is work on its own edges, so the first tiles are dealt one by one.
    tiles = _first_tiles(boundaries).repartition(*AREA, *TILE)
    for _ in range(steps):
        tiles = _cut(tiles, edges_per_tile)
    return tiles.selectExpr(*AREA, *TILE, "whole", "beyond", "edges", "ends")


def _first_tiles(boundaries: DataFrame) -> DataFrame:
    """Tiles of each area's own size; edges go to the tiles they pass, and only the edges
    of one area in one tile ever come together."""
    area = [*AREA, "shape", "depth"]
    areas = _usable(boundaries.select(*AREA, "rings")).where("size(rings) > 0")
    areas = areas.withColumn("shape", F.xxhash64("rings")).dropDuplicates([*AREA, "shape"])
    places = {axis: f"transform(flatten(rings), point -> point.{axis})" for axis in "xy"}
    extent = "greatest({}, 1e-9D)".format(
        ", ".join(f"array_max({values}) - array_min({values})" for values in places.values())
    )
    depth = f"floor(log(4D, {FIRST_TILES}D / {extent}))"
    areas = areas.withColumn("depth", F.expr(f"CAST(greatest(least({depth}, {DEPTHS[1]}), {DEPTHS[0]}) AS INT)"))

    edges = _corners(areas).withColumn("side", F.expr("pow(4D, -depth)"))
    edges = edges.withColumn("pad", F.expr(_pad("side", "b.x", "c.x", "b.y", "c.y")))
    bottom, top = "(tile_y * side - pad)", "((tile_y + 1) * side + pad)"
    bands = edges.selectExpr(
        "*",
        """explode(sequence(floor((least(b.y, c.y) - pad) / side),
            floor((greatest(b.y, c.y) + pad) / side))) AS tile_y""",
    )

    def columns_of(p: str, q: str) -> tuple[str, str]:
        """First and last column that an edge touches within a band."""
        left, right = _span((f"{p}.x", f"{p}.y"), (f"{q}.x", f"{q}.y"), bottom, top, "side")
        return f"floor(({left} - pad) / side)", f"floor(({right} + pad) / side)"

    def end_beyond(point: str, neighbour: str) -> str:
        """Height of an edge's end whose other edge lies right of the tile."""
        return f"CASE WHEN {point}.y BETWEEN {bottom} AND {top} AND {neighbour} > tile_x THEN {point}.y END"

    first, last = columns_of("b", "c")
    bands = bands.selectExpr(
        "*",
        f"{first} AS first",
        f"{last} AS last",
        f"{columns_of('a', 'b')[0]} AS first_before",
        f"{columns_of('c', 'd')[0]} AS first_after",
        f"(b.y > {top}) <> (c.y > {top}) AS leaves",
    )
    touched = bands.selectExpr("*", "explode(sequence(first, last)) AS tile_x").selectExpr(
        *area,
        "tile_x",
        "tile_y",
        "CASE WHEN b.x <> c.x OR b.y <> c.y THEN struct(b.x AS x1, b.y AS y1, c.x AS x2, c.y AS y2) END AS edge",
        f"{end_beyond('b', 'first_before')} AS end1",
        f"{end_beyond('c', 'first_after')} AS end2",
        "CAST(leaves AND tile_x = first AS INT) AS crossing",
    )
    # Copies of an area were gathered by area; from here on its edges are dealt by band, and
    # this one exchange serves the grouping and the window after it.
    dealt = touched.repartition(*area, "tile_y")
    tiles = dealt.groupBy(*area, "tile_x", "tile_y").agg(
        F.collect_list("edge").alias("edges"),
        F.concat(F.collect_list("end1"), F.collect_list("end2")).alias("ends"),
        F.sum("crossing").alias("crossing"),
    )
    # Borders of one area in one band, from right to left: what lies beyond each tile, and
    # the tiles between it and the next, which have no border in them.
    row = Window.partitionBy(*area, "tile_y").orderBy(F.desc("tile_x"))
    beyond = F.sum("crossing").over(row.rowsBetween(Window.unboundedPreceding, -1))
    tiles = tiles.withColumns(
        {
            "beyond": (F.coalesce(beyond, F.lit(0)) % 2).cast("int"),
            "next_x": F.lag("tile_x").over(row),
        }
    )
    inner = "CASE WHEN beyond = 1 AND next_x > tile_x + 1 THEN sequence(tile_x + 1, next_x - 1) END"
    every = f"concat(array(tile_x), coalesce({inner}, array()))"
    spread = tiles.selectExpr("*", f"posexplode({every}) AS (place, x)")
    return spread.selectExpr(
        *AREA,
        "depth",
        "x AS tile_x",
        "tile_y",
        "place > 0 AS whole",
        "CASE WHEN place = 0 THEN beyond ELSE 0 END AS beyond",
        "CASE WHEN place = 0 THEN edges ELSE slice(edges, 1, 0) END AS edges",
        "CASE WHEN place = 0 THEN ends ELSE slice(ends, 1, 0) END AS ends",
    )


#: SQL: the values of a list that it holds an odd number of times.
ODD = """aggregate(array_sort({0}), CAST(array() AS ARRAY<DOUBLE>), (odd, v) ->
    CASE WHEN try_element_at(odd, -1) = v THEN slice(odd, 1, size(odd) - 1) ELSE concat(odd, array(v)) END)"""


def _cut(tiles: DataFrame, edges_per_tile: int) -> DataFrame:
    """Cut the tiles that have too many edges: into four bands, these into four tiles.

    Right of a new tile lie the edges right of the old one and some of its own. What they
    add is told at the new tile's upper border; below it, every end of such an edge changes
    it, and the ends that two of them share cancel out. A new tile without an edge in it is
    covered whole or not at all.
    """
    tiles = tiles.withColumn("cut", F.expr(f"NOT whole AND size(edges) > {edges_per_tile}"))
    side, p, q = "band.side", ("e.x1", "e.y1"), ("e.x2", "e.y2")
    bands = tiles.withColumn(
        "band",
        F.expr(
            """explode(CASE WHEN cut THEN transform(sequence(0L, 3L), i -> named_struct(
                'y', tile_y * 4 + i, 'side', pow(4D, -depth - 1),
                'bottom', (tile_y * 4 + i) * pow(4D, -depth - 1),
                'top', (tile_y * 4 + i + 1) * pow(4D, -depth - 1)))
            ELSE array(named_struct('y', tile_y, 'side', 0D, 'bottom', 0D, 'top', 0D)) END)"""
        ),
    )
    bands = bands.withColumn("pad", F.expr(_pad(side, f"tile_x * {side} * 4", "band.bottom")))
    bottom, top = "(band.bottom - pad)", "(band.top + pad)"
    left, right = _span(p, q, bottom, top, side)
    within = f"greatest(e.y1, e.y2) >= {bottom} AND least(e.y1, e.y2) <= {top}"
    crossed = f"""transform(filter(edges, e -> {within}), e -> named_struct('e', e, 'first', {left}, 'last', {right},
        'ends', filter(array(e.y1, e.y2), v -> v > band.bottom AND v <= band.top),
        'leaves', CAST((e.y1 > band.top) <> (e.y2 > band.top) AS INT)))"""
    bands = bands.selectExpr(
        *AREA, *TILE, "whole", "beyond", "edges", "ends", "cut", "band", "pad",
        f"CASE WHEN cut THEN {crossed} END AS crossed",
        "CASE WHEN cut THEN filter(ends, v -> v > band.bottom AND v <= band.top) END AS near",
        "CASE WHEN cut THEN beyond + size(filter(ends, v -> v > band.top)) END AS above",
    )
    begin = "((tile_x * 4 + i) * band.side - pad)"
    end = "((tile_x * 4 + i + 1) * band.side + pad)"
    new = f"""transform(sequence(0L, 3L), i -> named_struct('x', tile_x * 4 + i,
        'local', transform(filter(crossed, c -> c.last >= {begin} AND c.first <= {end}), c -> c.e),
        'far', filter(crossed, c -> c.first > {end})))"""
    old = "array(named_struct('x', tile_x, 'local', edges, 'far', slice(crossed, 1, 0)))"
    parts = bands.withColumn("part", F.expr(f"explode(CASE WHEN cut THEN {new} ELSE {old} END)"))
    ends = ODD.format("concat(near, flatten(transform(part.far, c -> c.ends)))")
    beyond = "(above + aggregate(part.far, 0, (n, c) -> n + c.leaves)) % 2"
    cut = parts.selectExpr(
        *AREA,
        "depth + CAST(cut AS INT) AS depth",
        "part.x AS tile_x",
        "band.y AS tile_y",
        "whole OR (cut AND size(part.local) = 0) AS whole",
        f"CASE WHEN cut THEN {beyond} ELSE beyond END AS beyond",
        "part.local AS edges",
        f"CASE WHEN cut THEN {ends} ELSE ends END AS ends",
        "cut",
    )
    kept = cut.where("NOT cut OR size(edges) > 0 OR beyond = 1")
    return kept.drop("cut")
