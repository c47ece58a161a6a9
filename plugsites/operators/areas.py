"""Point-in-area lookup for administrative boundaries.

Boundaries are cut into square tiles once (see ``tiles``), as small as their borders need.
A point then needs one equality match for each size of tile and a few edge tests, whatever
the size of the boundary set.

Two join strategies give the same rows. A tile table below a measured size bound
is broadcast, one row per tile, and the points are never shuffled. Beyond the
bound the distinct points are joined by a shuffle on the tile.

An area is a set of rings. A point is inside if a ray to the right meets an odd
number of edges (so holes and separate parts need no care) and it lies on none.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plugsites.operators.missing import fill_text
from plugsites.operators.tiles import TILE, tile_areas
from plugsites.schema import LEVEL_COLUMNS, MISSING_TEXT, UNKNOWN
from plugsites.sinks.stage import shared_folder, write_stage

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024

# Widths in Spark's row format: one edge in a list, one end, one area without its lists.
EDGE_BYTES = 48
END_BYTES = 8
AREA_BYTES = 112

RESERVED = ("depth", "tile", "tile_x", "tile_y", "place_x", "place_y", "salt", "hot")

# Predicates over an edge ``e`` and a point, as SQL text: they stand inside lambdas.
CROSSES = """(e.y1 > {y}) <> (e.y2 > {y})
    AND {x} < (e.x2 - e.x1) * ({y} - e.y1) / nullif(e.y2 - e.y1, 0D) + e.x1"""
LIES_ON = """{y} BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2)
    AND {x} BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2)
    AND (e.x2 - e.x1) * ({y} - e.y1) - (e.y2 - e.y1) * ({x} - e.x1) = 0D"""


def contains(x: str, y: str, tile: str = "") -> str:
    """SQL condition: the point lies strictly inside the tile's area."""
    crosses, lies_on = CROSSES.format(x=x, y=y), LIES_ON.format(x=x, y=y)
    met = f"size(filter({tile}edges, e -> {crosses})) + size(filter({tile}ends, end -> end > {y}))"
    return f"""({tile}whole OR (({met} + {tile}beyond) % 2 = 1
        AND NOT exists({tile}edges, e -> {lies_on})))"""


@dataclass(frozen=True)
class AreaIndex:
    tiles: DataFrame
    """What ``tile_areas`` gives, stored."""
    depths: tuple[int, ...]
    """Depths of the tiles; a point has one tile at each."""
    byte_size: int
    """Measured size of ``tiles`` in memory."""


def index_areas(boundaries: DataFrame, path: str | None = None) -> AreaIndex:
    """Tile the boundaries into a stage, and measure it: its depths, and its size for the
    join choice. The stage lies at ``path``, by default below the shared folder."""
    spark = boundaries.sparkSession
    path = path or shared_folder(spark, "tiles")
    write_stage(tile_areas(boundaries), path)
    return stored_index(spark, path)


def stored_index(spark: SparkSession, path: str) -> AreaIndex:
    """The index that ``index_areas`` left at ``path``."""
    tiles = spark.read.parquet(path)
    lists = F.size("edges").cast("bigint") * EDGE_BYTES + F.size("ends").cast("bigint") * END_BYTES
    measured = tiles.agg(
        F.sum(lists + F.octet_length("name") + AREA_BYTES).alias("bytes"),
        F.sort_array(F.collect_set("depth")).alias("depths"),
    ).first()
    return AreaIndex(tiles, tuple(measured["depths"]), int(measured["bytes"] or 0))


def find_areas(
    df: DataFrame,
    index: AreaIndex,
    columns: dict[int, str],
    needed: Column | None = None,
    longitude: str = "longitude",
    latitude: str = "latitude",
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
    salts: int | None = None,
) -> DataFrame:
    """Add one column per level: the first area, by ``ord``, that holds the point.

    NULL where no area does, where the coordinates are unusable, or where
    ``needed`` is not true. ``salts``: tasks that share a hot tile or place, by default
    as many as a shuffle has partitions.
    """
    taken = set(df.columns) & {*RESERVED, *columns.values()}
    if taken:
        raise ValueError(f"rename these columns before the lookup: {sorted(taken)}")
    x, y = F.col(longitude), F.col(latitude)
    usable = ~F.isnan(x) & ~F.isnan(y)
    needed = F.coalesce(usable if needed is None else usable & needed, F.lit(False))
    if index.byte_size <= broadcast_limit:
        return _find_by_broadcast(df, index, columns, needed, longitude, latitude)
    return _find_by_shuffle(df, index, columns, needed, longitude, latitude, salts)


def _tile_at(depth: int, longitude: str, latitude: str) -> Column:
    """The tile of a depth that holds the point; sides are powers of two, so this is exact."""
    return F.struct(
        F.lit(depth).alias("depth"),
        *[
            F.floor(F.col(place) * F.lit(4.0**depth)).alias(name)
            for name, place in (("tile_x", longitude), ("tile_y", latitude))
        ],
    )


def _find_by_broadcast(
    df: DataFrame,
    index: AreaIndex,
    columns: dict[int, str],
    needed: Column,
    longitude: str,
    latitude: str,
) -> DataFrame:
    """One equality per depth, all against one broadcast table of a row per tile."""
    per_tile = index.tiles.groupBy(*TILE).agg(
        *[
            F.expr(
                f"array_sort(collect_list(struct(ord, name, whole, beyond, edges, ends)) FILTER (WHERE level = {level}))"
            ).alias(f"areas_{level}")
            for level in columns
        ],
    )
    inside = contains(longitude, latitude, "area.")
    found = df
    for n, depth in enumerate(index.depths):
        tiles = per_tile.select(
            F.struct(*TILE).alias("tile"),
            *[F.col(f"areas_{level}").alias(f"areas_{level}_{n}") for level in columns],
        )
        # Rows that need no lookup get a NULL tile and so skip the match.
        keyed = found.withColumn("tile", F.when(needed, _tile_at(depth, longitude, latitude)))
        found = keyed.join(F.broadcast(tiles), "tile", "left").drop("tile")
    first = {
        level: [
            f"transform(slice(filter(areas_{level}_{n}, area -> {inside}), 1, 1), area -> struct(area.ord, area.name))"
            for n in range(len(index.depths))
        ]
        for level in columns
    }
    names = {
        name: "array_min(flatten(array_compact(array({})))).name".format(", ".join(first[level]))
        if index.depths
        else "CAST(NULL AS STRING)"
        for level, name in columns.items()
    }
    return found.select(*df.columns, *[F.expr(sql).alias(name) for name, sql in names.items()])


def _find_by_shuffle(
    df: DataFrame,
    index: AreaIndex,
    columns: dict[int, str],
    needed: Column,
    longitude: str,
    latitude: str,
    salts: int | None,
) -> DataFrame:
    spark, key, tile = df.sparkSession, ["place_x", "place_y"], TILE
    # The rows are needed twice, once for their places alone; they are made once.
    path = shared_folder(spark, "lookup")
    place = {"place_x": F.when(needed, F.col(longitude)), "place_y": F.when(needed, F.col(latitude))}
    metrics = {"rows": F.count(F.lit(1))}
    n = write_stage(df.withColumns(place), path, metrics)["rows"]
    rows = spark.read.parquet(path)
    salts = salts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Of keys with more rows than this there are fewer than ``salts``.
    many = n // salts

    # A place that holds very many rows is looked up once.
    places = rows.where("place_x IS NOT NULL").groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    tiles_of = F.array(*[_tile_at(depth, *key) for depth in index.depths])
    points = places.select("*", F.inline(tiles_of)) if index.depths else None
    if points is None:
        return df.select("*", *[F.lit(None).cast("string").alias(name) for name in columns.values()])
    hot_tiles = points.groupBy(*tile).count().where(F.col("count") > many).select(*tile)
    tiles = index.tiles.where(F.col("level").isin(*columns))
    hits = (
        _salted(points, hot_tiles, salts)
        .join(_on_every_salt(tiles, hot_tiles, salts), [*tile, "salt"])
        .where(contains(*key))
        .groupBy(*key)
        .agg(
            *[
                F.min(F.when(F.col("level") == level, F.struct("ord", "name")))["name"].alias(name)
                for level, name in columns.items()
            ]
        )
    )
    hot = places.where(F.col("n") > many).select(*key)
    # Rows that ask for nothing have no place; they spread over salts of their own.
    salt = F.when(F.col("place_x").isNull(), _any_salt(rows, 1 << 30)).otherwise(F.col("salt"))
    salted = _salted(rows, hot, salts).withColumn("salt", salt)
    answered = salted.join(_on_every_salt(hits, hot, salts), [*key, "salt"], "left")
    return answered.select(*df.columns, *columns.values())


def _any_salt(df: DataFrame, salts: int) -> Column:
    """Follows from the row and its task, so a rerun task routes its rows as before, and
    equal rows from different tasks still spread."""
    return F.pmod(F.xxhash64(*df.columns) + F.spark_partition_id(), F.lit(salts)).cast("bigint")


def _marked(df: DataFrame, hot: DataFrame) -> DataFrame:
    """``hot`` keys are fewer than the salts, hence broadcast."""
    return df.join(F.broadcast(hot.withColumn("hot", F.lit(True))), hot.columns, "left")


def _salted(df: DataFrame, hot: DataFrame, salts: int) -> DataFrame:
    salt = F.when(F.col("hot"), _any_salt(df, salts)).otherwise(F.lit(0).cast("bigint"))
    return _marked(df, hot).withColumn("salt", salt).drop("hot")


def _on_every_salt(df: DataFrame, hot: DataFrame, salts: int) -> DataFrame:
    last = F.when(F.col("hot"), F.lit(salts - 1)).otherwise(F.lit(0)).cast("bigint")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), last))
    return _marked(df, hot).withColumn("salt", every).drop("hot")


def fill_areas(
    df: DataFrame,
    index: AreaIndex | None,
    columns: dict[int, str] = LEVEL_COLUMNS,
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Fill missing area names from the coordinates, all levels in one join."""
    if index is None:
        return df.withColumns({name: fill_text(F.col(name)) for name in columns.values()})
    markers = ", ".join(f"'{marker}'" for marker in MISSING_TEXT)
    missing = {name: f"({name} IS NULL OR {name} IN ({markers}))" for name in columns.values()}
    lookups = {level: f"found_{name}" for level, name in columns.items()}
    needed = F.expr(" OR ".join(missing.values()))
    found = find_areas(df, index, lookups, needed, broadcast_limit=broadcast_limit)
    filled = {
        name: f"CASE WHEN {missing[name]} THEN coalesce({lookups[level]}, '{UNKNOWN}') ELSE {name} END"
        for level, name in columns.items()
    }
    return found.select(
        *[F.expr(filled[name]).alias(name) if name in filled else name for name in df.columns]
    )
